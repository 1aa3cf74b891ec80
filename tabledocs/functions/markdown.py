"""Inline HTML to Markdown, as string expressions.

Most tags map to a marker by one replacement over the whole page; links, images
and code need their own attributes or text, so the page is cut at those tags
only.  List items are numbered per cell, where nesting can be resolved.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F

from tabledocs.functions.text import ATTRIBUTE, let, running_count, trim_short, trim_text

INLINE_TAGS = (
    "strong|b|em|i|code|a|br|p|ul|ol|li|h1|h2|h3|h4|h5|h6|blockquote|hr|del|s|strike|sub|sup|img"
)

_ATTRS = "(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_END = "(?=[\\s/>])"
_SPACE = "\\s\\u00A0\\uFEFF\\p{Z}"

# Separators for list structure and for the trimming of item and quote text.
UL, OL, LIST_END, ITEM, ITEM_END = "\ufde0", "\ufde1", "\ufde2", "\ufde3", "\ufde4"
TRIM_START, TRIM_END = "\ufde5", "\ufde6"
_LIST_MARKS = "\ufde0-\ufde4"
_ALL_MARKS = "\ufde0-\ufde6"

# The Markdown written for a pair of tags (before, after).
PAIRS = {
    "strong|b": ("**", "**"),
    "em|i": ("*", "*"),
    "del|s|strike": ("~~", "~~"),
    "sub": ("~", "~"),
    "sup": ("^", "^"),
    "blockquote": ("> " + TRIM_START, TRIM_END + "\n"),
    "h1": ("# ", "\n"),
    "h2": ("## ", "\n"),
    "h3": ("### ", "\n"),
    "h4": ("#### ", "\n"),
    "h5": ("##### ", "\n"),
    "h6": ("###### ", "\n"),
    "ul": (UL, LIST_END),
    "ol": (OL, LIST_END),
    "li": (ITEM, ITEM_END),
}
# The Markdown written for a tag without content.
SINGLES = {"br": "\n", "hr": "\n---\n"}


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag; empty when absent."""
    pattern = f"(?is)^<[a-z][^\\s/>]*+(?:{ATTRIBUTE})*?[\\s/]+{name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s>\"']+))"
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def _at_each(text: Column, tag: str, rewrite) -> Column:
    """Apply ``rewrite(head, rest)`` to every stretch that begins with ``tag``."""
    start = f"(?is)^<{tag}{_END}{_ATTRS}"

    def piece(p: Column) -> Column:
        return let(
            F.regexp_extract(p, start, 0),
            lambda head: F.when(head == "", p).otherwise(
                let(F.substr(p, F.length(head) + F.lit(1)), lambda rest: rewrite(head, rest))
            ),
        )

    return let(
        text,
        lambda t: F.when(
            F.rlike(t, F.lit(f"(?i)<{tag}[\\s/>]")),
            F.array_join(F.transform(F.split(t, f"(?i)(?=<{tag}[\\s/>])"), piece), ""),
        ).otherwise(t),
    )


def _enclosed(rest: Column, tag: str, marks: str, write) -> Column:
    """Split ``rest`` into the text of the element and what follows it."""
    inside = F.regexp_extract(rest, f"(?is)^((?:(?!</{tag}\\s*>)[^{marks}])*+)", 1)
    return let(
        inside,
        lambda text: F.concat(
            write(text),
            F.regexp_replace(F.substr(rest, F.length(text) + F.lit(1)), f"(?i)^</{tag}\\s*>", ""),
        ),
    )


# Pairs that tend to occur together; a group is skipped on pages that have none.
_GROUPS = (
    ("strong|b", "em|i"),
    ("ul", "ol", "li"),
    ("del|s|strike", "sub", "sup", "blockquote"),
    ("h1", "h2", "h3", "h4", "h5", "h6"),
)


def _pairs_of(group: tuple[str, ...]):
    def replace(text: Column) -> Column:
        out = text
        for tags in group:
            before, after = PAIRS[tags]
            out = F.regexp_replace(out, f"(?is)<(?:{tags}){_END}{_ATTRS}", before)
            out = F.regexp_replace(out, f"(?i)</(?:{tags})\\s*>", after)
        return F.when(F.rlike(text, F.lit(f"(?i)</?(?:{'|'.join(group)})[\\s/>]")), out).otherwise(text)

    return replace


def inline_to_markdown(text: Column, marks: str) -> Column:
    """Markdown for inline tags; ``marks`` is the class of structure separators."""
    any_tag = "(?s)</?[a-zA-Z]" + _ATTRS
    text = _at_each(
        text, "code",
        lambda head, rest: _enclosed(
            rest, "code", marks, lambda t: F.concat(F.lit("`"), F.regexp_replace(t, any_tag, ""), F.lit("`"))
        ),
    )
    text = _at_each(
        text, "img",
        lambda head, rest: F.concat(
            F.lit("!["), attribute(head, "alt"), F.lit("]("), attribute(head, "src"), F.lit(")"), rest
        ),
    )

    def link(head: Column, rest: Column) -> Column:
        return let(
            attribute(head, "href"),
            lambda href: _enclosed(
                rest, "a", marks,
                lambda t: F.when(href == "", t).otherwise(
                    F.concat(F.lit("["), t, F.lit("]("), href, F.lit(")"))
                ),
            ),
        )

    text = _at_each(text, "a", link)
    paragraph = f"(?is)<p{_END}{_ATTRS}((?:(?!</?p[\\s>])[^{marks}])*+)(?:</p\\s*>)?+"
    text = F.regexp_replace(text, paragraph, "$1\n\n")
    for tag, output in SINGLES.items():
        text = F.regexp_replace(text, f"(?is)<{tag}{_END}{_ATTRS}", output)
    for group in _GROUPS:
        text = let(text, _pairs_of(group))
    return F.regexp_replace(text, any_tag, "")


# Begins what is left of a list's start: u or o follows.
LIST_START = "\ufde7"
# Elements that leave nothing but their content.
_UNMARKED = (
    "span", "div", "u", "small", "big", "font", "label", "abbr", "cite", "q", "mark", "time", "var", "kbd", "samp", "section", "article",
    "header", "footer", "main", "figure", "figcaption", "center", "html", "body",
)
_PLAIN_ATTRIBUTE = "\\s++(?!(?i:href)[\\s=])[a-zA-Z\\-]++=(?:\"[^\"<>{m}]*+\"|'[^'<>{m}]*+')"
_PLAIN_LINK = (
    "<a(?:{a})*+\\s++href=(?:\"([^\"<>{m}]++)\"|'([^'<>{m}]++)')(?:{a})*+\\s*+>([^<{m}]*+)</a\\s*+>"
)


def _known_tags(structure: dict[str, str]) -> Column:
    """What is written for a tag without attributes, by its text up to the bracket: a map for every length of such texts."""
    known = {}
    lists = {"ul": LIST_START + "u", "ol": LIST_START + "o"}
    for tags, (before, after) in PAIRS.items():
        for tag in tags.split("|"):
            known |= {tag: lists.get(tag, before), "/" + tag: after}
    for tag, output in SINGLES.items():
        known |= {tag: output, tag + "/": output, tag + " /": output}
    known |= structure | {end + tag: "" for tag in _UNMARKED for end in ("", "/")}
    # a map is searched from its beginning
    often = [end + tag for tag in ("td", "tr", "li", "b", "em", "br", "i", "ul", "ol", "span") for end in ("", "/") if end + tag in known]
    by_length = [{} for _ in range(max(map(len, known)) + 2)]
    for tag in dict.fromkeys([*often, *known]):
        by_length[len(tag) + 1][tag + ">"] = known[tag]
    return F.from_json(F.lit(json.dumps(by_length)), "array<map<string,string>>")


def known_to_markdown(page: Column, structure: dict[str, str], marks: str) -> Column:
    """Markdown of a page's tags without attributes and of its plain links; other tags stay.

    ``structure`` has what is written for structural tags. The page is cut at every tag, and each is looked up whole. Links have quoted
    attributes and no tags left in their text. List items are left as marks, and list starts as ``LIST_START`` and a letter.
    """
    known = _known_tags(structure)

    def one(piece: Column, i: Column) -> Column:
        end = F.instr(piece, ">")
        written = F.concat(F.try_element_at(F.get(known, end), F.substr(piece, F.lit(1), end)), F.substr(piece, end + 1))
        return F.when(i == 0, piece).otherwise(F.coalesce(written, F.concat(F.lit("<"), piece)))

    text = F.array_join(F.transform(F.split(page, "<"), one), "")
    return F.regexp_replace(text, _PLAIN_LINK.format(a=_PLAIN_ATTRIBUTE.format(m=marks), m=marks), "[$3]($1$2)")


def write_lists(text: Column, marks: str) -> Column:
    """The lists that ``known_to_markdown`` left, written; where one is not closed in its cell, or might be in a caption, all are left to ``number_lists``."""

    def body(piece: Column) -> Column:
        return F.substring_index(piece, LIST_END, 1)

    def written(piece: Column, i: Column) -> Column:
        items = F.transform(
            F.split(body(piece), ITEM),
            lambda x, n: F.when(n == 0, F.lit("")).otherwise(F.concat(
                F.when(piece.startswith("o"), F.concat(n.cast("string"), F.lit(". "))).otherwise(F.lit("- ")),
                trim_short(F.substring_index(x, ITEM_END, 1)), F.lit("\n"),
            )),
        )
        return F.when(i == 0, piece).otherwise(F.concat(F.array_join(items, ""), F.substr(piece, F.instr(piece, LIST_END) + 1)))

    def lists(t: Column) -> Column:
        def flat(pieces: Column) -> Column:
            whole = F.forall(
                F.transform(pieces, lambda p, i: (i == 0) | (F.contains(p, F.lit(LIST_END)) & ~F.contains(body(p), F.lit(marks)))), lambda x: x
            )
            later = F.replace(F.replace(t, F.lit(LIST_START + "u"), F.lit(UL)), F.lit(LIST_START + "o"), F.lit(OL))
            return F.when(whole & ~F.contains(t, F.lit(marks + "caption")), F.array_join(F.transform(pieces, written), "")).otherwise(later)

        return F.when(F.contains(t, F.lit(LIST_START)), let(F.split(t, LIST_START), flat)).otherwise(t)

    return let(text, lists)


def _trim_marked(text: Column) -> Column:
    text = F.regexp_replace(text, f"{TRIM_START}[{_SPACE}{TRIM_START}]*+", "")
    return F.regexp_replace(
        text, f"(?<![{_SPACE}{TRIM_END}])[{_SPACE}{TRIM_END}]*{TRIM_END}", ""
    )


def _number(cell: Column) -> Column:
    from tabledocs.functions.markup import balanced_levels

    units = F.regexp_extract_all(cell, F.lit(f"[{_LIST_MARKS}][^{_LIST_MARKS}]*|^[^{_LIST_MARKS}]+"), F.lit(0))
    symbols = F.translate(F.regexp_replace(F.regexp_replace(
        cell, f"^[^{_LIST_MARKS}]+", "."), f"([{_LIST_MARKS}])[^{_LIST_MARKS}]*", "$1"),
        UL + OL + LIST_END + ITEM + ITEM_END, "UVcli")

    def place(parts: Column, kinds: Column) -> Column:
        levels = balanced_levels(F.translate(kinds, "UVli.", "OOxxx"))
        entries = F.sort_array(
            F.transform(
                F.arrays_zip(
                    levels.alias("level"),
                    F.regexp_extract_all(kinds, F.lit("."), F.lit(0)).alias("kind"),
                    parts.alias("part"),
                ),
                lambda e, i: F.struct(e["level"].alias("level"), i.alias("pos"), e["kind"].alias("kind"), e["part"].alias("part")),
            )
        )
        return let(entries, lambda es: let(order_of(es), lambda o: render(es, o)))

    def order_of(es: Column) -> Column:
        sig = F.array_join(F.transform(es, lambda e: F.translate(e["kind"], "UV", "OO")), "")
        return let(
            sig,
            lambda s: F.struct(
                running_count(s, "O").alias("list_no"),
                running_count(s, "l").alias("item_no"),
                F.filter(
                    F.zip_with(es, running_count(s, "l"), lambda e, n: F.when(e["kind"].isin("U", "V"), F.struct(n.alias("before"), e["kind"].alias("kind")))),
                    lambda x: x.isNotNull(),
                ).alias("lists"),
            ),
        )

    def render(es: Column, o: Column) -> Column:
        located = F.arrays_zip(es.alias("e"), o["list_no"].alias("list_no"), o["item_no"].alias("item_no"))

        def write(x: Column) -> Column:
            e, owner = x["e"], F.get(o["lists"], x["list_no"] - 1)
            nth = x["item_no"] - owner["before"]
            text = F.substr(e["part"], F.lit(2))
            item = F.concat(
                F.when(nth > 1, F.lit(TRIM_END + "\n")).otherwise(F.lit("")),
                F.when(owner["kind"] == "V", F.concat(nth.cast("string"), F.lit(". "))).otherwise(F.lit("- ")),
                F.lit(TRIM_START), text,
            )
            return F.struct(
                e["pos"].alias("pos"),
                F.when(e["kind"] == ".", e["part"])
                .when((e["kind"] == "l") & (e["level"] == 0), text)
                .when(e["kind"] == "l", item)
                .when((e["kind"] == "i") & (e["level"] > 0), F.lit(""))
                .when(e["kind"] == "c", F.concat(F.lit(LIST_END), text))
                .when(e["kind"].isin("U", "V"), F.lit(UL))
                .otherwise(text).alias("text"),
            )

        joined = F.array_join(
            F.transform(F.sort_array(F.transform(located, write)), lambda w: w["text"]), ""
        )
        # a list that had items closes its last one; an empty list leaves nothing
        return F.replace(
            F.replace(F.replace(joined, F.lit(UL + LIST_END), F.lit("")), F.lit(UL), F.lit("")),
            F.lit(LIST_END), F.lit(TRIM_END + "\n"),
        )

    return let(units, lambda parts: let(symbols, lambda kinds: place(parts, kinds)))


def _number_flat(cell: Column) -> Column:
    """Lists that do not stand inside one another: cut at lists, then at items."""

    def one(piece: Column) -> Column:
        items = F.transform(
            F.slice(F.split(F.substring_index(piece, LIST_END, 1), ITEM), F.lit(2), F.length(piece)),
            lambda x, i: F.concat(
                F.when(piece.startswith(OL), F.concat((i + 1).cast("string"), F.lit(". "))).otherwise(F.lit("- ")),
                trim_text(F.substring_index(x, ITEM_END, 1)), F.lit("\n"),
            ),
        )
        after = F.when(
            F.contains(piece, F.lit(LIST_END)), F.substr(piece, F.instr(piece, LIST_END) + 1)
        ).otherwise(F.lit(""))
        return F.when(
            piece.startswith(UL) | piece.startswith(OL), F.concat(F.array_join(items, ""), after)
        ).otherwise(piece)

    text = F.array_join(F.transform(F.split(cell, f"(?=[{UL}{OL}])"), one), "")
    return F.regexp_replace(text, f"[{_LIST_MARKS}]", "")


def number_lists(cell: Column) -> Column:
    """Write list items of one cell and trim item and quote text."""

    def finish(text: Column) -> Column:
        nested = F.rlike(text, F.lit(f"[{UL}{OL}][^{LIST_END}{UL}{OL}]*+[{UL}{OL}]"))
        listed = (
            F.when(~F.rlike(text, F.lit(f"[{_LIST_MARKS}]")), text)
            .when(nested, _number(text))
            .otherwise(_number_flat(text))
        )
        # a cell of ASCII has no marks
        marked = (F.octet_length(text) != F.length(text)) & F.rlike(text, F.lit(f"[{_ALL_MARKS}]"))
        return F.when(marked, let(listed, _trim_marked)).otherwise(text)

    return let(cell, finish)
