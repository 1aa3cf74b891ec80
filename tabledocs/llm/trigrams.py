"""Boolean trigram queries of regular expressions.

A query is a set of clauses, each a set of trigrams: a text can match the
expression only if it holds, in some case, all trigrams of some clause. An
empty clause means that nothing is mandatory. Derived when the plan is built.
"""

from __future__ import annotations

from re import _constants as kind
from re import _parser as parser

#: more variants than this are no longer told apart, which only makes the query weaker
VARIANTS = 256
#: a class of at most so many characters is spelt out
CLASS = 8

# a variant is a tuple of literal runs; the last run is open and may grow
_Variants = set[tuple[str, ...]]


def _class_characters(items: list) -> list[str] | None:
    found: list[str] = []
    for what, value in items:
        if what is kind.LITERAL:
            found.append(chr(value))
        elif what is kind.RANGE and value[1] - value[0] < CLASS:
            found += map(chr, range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= CLASS else None


def _grow(variants: _Variants, texts: list[str]) -> _Variants:
    if len(variants) * len(texts) > VARIANTS:
        return _closed(variants)
    return {(*v[:-1], v[-1] + t) for v in variants for t in texts}


def _closed(variants: _Variants) -> _Variants:
    """Ends the open run: something unknown follows."""
    return {v if v[-1] == "" else (*v, "") for v in variants}


def _walk(tree: parser.SubPattern, variants: _Variants) -> _Variants:
    for what, value in tree:
        if what is kind.LITERAL:
            variants = _grow(variants, [chr(value)])
        elif what is kind.IN and (texts := _class_characters(value)) is not None:
            variants = _grow(variants, texts)
        elif what is kind.SUBPATTERN:
            variants = _walk(value[3], variants)
        elif what is kind.BRANCH:
            variants = set().union(*(_walk(x, variants) for x in value[1]))
        elif what in (kind.MAX_REPEAT, kind.MIN_REPEAT, kind.POSSESSIVE_REPEAT):
            least, most, body = value
            if (least, most) == (0, 1):
                variants = variants | _walk(body, variants)
            else:
                for _ in range(min(least, 3)):
                    variants = _walk(body, variants)
                if most != least or least > 3:
                    variants = _closed(variants)
        elif what is not kind.AT:
            variants = _closed(variants)
        if len(variants) > VARIANTS:
            variants = {("",)}
    return variants


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The clauses, without those that a weaker one makes superfluous; trigrams are in lower case."""
    clauses = set()
    for runs in _walk(parser.parse(pattern), {("",)}):
        clauses.add(frozenset(run[i : i + 3].lower() for run in runs for i in range(len(run) - 2)))
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)
