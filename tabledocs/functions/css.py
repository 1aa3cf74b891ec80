"""CSS selectors over the element tree of a page.

A selector is compiled when the plan is built. Its steps are evaluated one after the other for all elements of a page at once, as arrays
of flags: what a step needs of ancestors and siblings are look-ups and counts along sorted arrays (see ``tree``),
so a page costs n log n per step and no join between elements is needed.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from tabledocs.functions.markup import ATTRS
from tabledocs.functions.text import ATTRIBUTE, let, running_count
from tabledocs.functions.tree import ORDINALS, PLACED, counted_before, element_text, elements_of, numbered, page_units

_NAME = r"(?:[\w-]|[^\x00-\x7f])+"
_TOKEN = re.compile(
    rf"""(?P<tag>\*|{_NAME})
    |\#(?P<id>{_NAME})
    |\.(?P<cls>{_NAME})
    |\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~^$*|]?=)\s*(?P<val>"[^"]*"|'[^']*'|[^\]\s]+)\s*)?\]
    |:(?P<pseudo>[a-z-]+)""",
    re.X,
)

# Pseudo-classes without arguments, as a place (from the front, from the end) among all siblings or those of the same name.
_PLACES = {
    "first-child": [("child", "front")], "last-child": [("child", "end")], "only-child": [("child", "front"), ("child", "end")],
    "first-of-type": [("type", "front")], "last-of-type": [("type", "end")], "only-of-type": [("type", "front"), ("type", "end")],
}
# Pseudo-classes that take a formula.
_FORMULAS = {
    "nth-child": ("child", "front"), "nth-last-child": ("child", "end"), "nth-of-type": ("type", "front"), "nth-last-of-type": ("type", "end"),
}


@dataclass(frozen=True)
class Compound:
    """Tests of one element: a tag name, patterns for its attributes, places (kind, side, a, b) for an + b, and alternatives, wanted or not."""

    tag: str = ""
    attributes: tuple[str, ...] = ()
    places: tuple[tuple[str, str, int, int], ...] = ()
    nested: tuple[tuple[bool, tuple[Compound, ...]], ...] = ()
    empty: bool = False
    root: bool = False


@dataclass(frozen=True)
class Selector:
    """A compiled selector list: each alternative is its steps, (combinator, compound); the first combinator is empty."""

    source: str
    alternatives: tuple[tuple[tuple[str, Compound], ...], ...]


def _attribute_pattern(name: str, op: str | None, value: str) -> str:
    """Matches the attribute part of a tag, from its start."""
    head = f"(?s)^(?:{ATTRIBUTE})*?[\\s/]+(?i:{re.escape(name)})"
    if op is None:
        return head + "(?:[\\s=/>])"
    v = re.escape(value)
    shapes = {
        "=": "{v}",
        "~=": "(?:[^{q}]*\\s)?{v}(?:\\s[^{q}]*)?",
        "^=": "{v}[^{q}]*",
        "$=": "[^{q}]*{v}",
        "*=": "[^{q}]*{v}[^{q}]*",
        "|=": "{v}(?:-[^{q}]*)?",
    }
    quoted = shapes[op]
    options = [f'"{quoted.format(q=chr(34), v=v)}"', f"'{quoted.format(q=chr(39), v=v)}'"]
    bare = quoted.replace("\\s", "\\x00").format(q="\\s/>", v=v)
    options.append(f"{bare}(?=[\\s/>])")
    return head + "\\s*=\\s*(?:" + "|".join(options) + ")"


def _formula(text: str) -> tuple[int, int]:
    """(a, b) of an + b."""
    plain = re.sub(r"\s+", "", text.lower())
    if plain in ("odd", "even"):
        return 2, int(plain == "odd")
    found = re.fullmatch(r"(?:([+-]?\d*)n)?([+-]?\d+)?", plain)
    if not plain or not found:
        raise ValueError(f"unsupported formula: {text!r}")
    a, b = found.groups()
    step = 0 if a is None else int(a + "1") if a in ("", "+", "-") else int(a)
    return step, int(b or 0)


def _argument(text: str, at: int) -> tuple[str, int]:
    """What stands in the brackets that open at ``at``, and the place after them."""
    depth = 0
    for token in re.finditer(r"\[[^\]]*\]|[()]", text[at:]):
        depth += {"(": 1, ")": -1}.get(token[0], 0)
        if depth == 0:
            return text[at + 1 : at + token.start()], at + token.end()
    raise ValueError(f"unsupported selector: {text!r}")


def _compound(text: str) -> Compound:
    tag, attributes, places, nested, empty, root, at = "", [], [], [], False, False, 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m or (m["tag"] and at):
            raise ValueError(f"unsupported selector: {text!r}")
        at = m.end()
        if m["tag"]:
            tag = "" if m["tag"] == "*" else m["tag"].lower()
        elif m["id"]:
            attributes.append(_attribute_pattern("id", "=", m["id"]))
        elif m["cls"]:
            attributes.append(_attribute_pattern("class", "~=", m["cls"]))
        elif m["attr"]:
            attributes.append(_attribute_pattern(m["attr"], m["op"], (m["val"] or "").strip("\"'")))
        elif m["pseudo"] in _PLACES:
            places += [(kind, side, 0, 1) for kind, side in _PLACES[m["pseudo"]]]
        elif m["pseudo"] in ("empty", "root"):
            empty, root = empty or m["pseudo"] == "empty", root or m["pseudo"] == "root"
        elif m["pseudo"] in (*_FORMULAS, "not", "is", "where") and text[at : at + 1] == "(":
            inside, at = _argument(text, at)
            if m["pseudo"] in _FORMULAS:
                places.append((*_FORMULAS[m["pseudo"]], *_formula(inside)))
            else:
                nested.append((m["pseudo"] != "not", tuple(_compound(x) for x in _split_top(inside, ","))))
        else:
            raise ValueError(f"unsupported selector: {text!r}")
    if not text:
        raise ValueError("selector is empty")
    return Compound(tag, tuple(attributes), tuple(places), tuple(nested), empty, root)


def _split_top(text: str, separator: str) -> list[str]:
    """Split outside brackets and quotes; no part may be empty."""
    parts, depth, quote, part = [], 0, "", ""
    for c in text:
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'" and depth:
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        if depth < 0:
            raise ValueError(f"unsupported selector: {text!r}")
        if c == separator and not depth and not quote:
            parts.append(part)
            part = ""
        else:
            part += c
    if depth or quote or not all(p.strip() for p in (*parts, part)):
        raise ValueError(f"unsupported selector: {text!r}")
    return [p.strip() for p in (*parts, part)]


def _steps(text: str) -> tuple[tuple[str, Compound], ...]:
    steps, combinator, part, depth = [], "", "", 0
    for c in text + " ":
        depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(c, 0)
        if depth or not (c.isspace() or c in ">+~"):
            part += c
            continue
        if part:
            steps.append((combinator if steps else "", _compound(part)))
            part, combinator = "", " "
        if not c.isspace():
            if not steps or combinator != " ":
                raise ValueError(f"unsupported selector: {text!r}")
            combinator = c
    if not steps or combinator != " ":
        raise ValueError(f"unsupported selector: {text!r}")
    return tuple(steps)


def compile_selector(selector: str) -> Selector:
    """Compile a selector list; raises ValueError for what is not supported."""
    if not selector or not selector.strip():
        raise ValueError("selector is empty")
    return Selector(selector, tuple(_steps(x) for x in _split_top(selector, ",")))


def _needs(compound: Compound, what: str) -> bool:
    return bool(getattr(compound, what)) or any(_needs(c, what) for _, cs in compound.nested for c in cs)


def needs_ordinals(selectors: list[Selector]) -> bool:
    """Whether places among siblings, or the sibling before, are looked at."""
    steps = [x for s in selectors for steps in s.alternatives for x in steps]
    return any(combinator == "+" or _needs(compound, "places") for combinator, compound in steps)


def _test(e: Column, compound: Compound) -> Column:
    """Whether an element passes; ``e`` also has ``head``, its attributes, and ``blank``, where these are needed."""
    tests = [e["name"] == compound.tag] if compound.tag else []
    tests += [F.rlike(e["head"], F.lit(p)) for p in compound.attributes]
    for kind, side, a, b in compound.places:
        rank, size = (e["child_no"], e["children"]) if kind == "child" else (e["type_no"], e["types"])
        off = (rank if side == "front" else size - rank + 1) - b
        tests.append(off == 0 if a == 0 else (F.pmod(off, F.lit(abs(a))) == 0) & (off * (1 if a > 0 else -1) >= 0))
    for wanted, alternatives in compound.nested:
        any_of = _any([_test(e, c) for c in alternatives])
        tests.append(any_of if wanted else ~any_of)
    if compound.empty:
        tests.append(e["blank"])
    if compound.root:
        tests.append(e["parent"].isNull() & (e["name"] == "html"))
    result = F.lit(True)
    for t in tests:
        result = result & t
    return result


def _any(tests: list[Column]) -> Column:
    result = tests[0]
    for t in tests[1:]:
        result = result | t
    return result


def _inside(elements: Column, flags: Column) -> Column:
    """For each element: whether it lies inside a flagged one."""
    marked = F.filter(F.arrays_zip(elements.alias("e"), flags.alias("f")), lambda z: z["f"])

    def count(ms: Column) -> Column:
        found = counted_before(
            elements, F.transform(ms, lambda z: z["e"]["pos"]), F.transform(ms, lambda z: z["e"]["end"]), lambda _, opened, closed: opened > closed
        )
        # the implied elements, last in the array, are first by position
        implied = F.exists(F.slice(flags, -2, 2), lambda f: f)
        return let(
            F.struct(found.alias("found"), implied.alias("implied")),
            lambda k: F.zip_with(
                elements, F.concat(F.slice(k["found"], F.lit(3), F.size(k["found"]) - 2), F.slice(k["found"], 1, 2)),
                lambda e, f: f | (e["implied"] & k["implied"]),
            ),
        )

    return let(marked, count)


def _after_sibling(elements: Column, flags: Column) -> Column:
    """For each element: whether a sibling before it is flagged."""
    ordered = F.sort_array(
        F.zip_with(elements, flags, lambda e, f: F.struct(F.coalesce(e["parent"], F.lit(0)).alias("p"), e["no"].alias("no"), f.alias("f")))
    )

    def count(items: Column) -> Column:
        signature = F.array_join(F.transform(items, lambda x: F.when(x["f"], "f").otherwise(".")), "")

        def look(seen: Column) -> Column:
            # flagged ones up to the element, less itself, against those up to the end of the family before
            found = numbered(
                F.transform(items, lambda x, i: F.struct(x["p"].alias("p"), x["no"].alias("no"), x["f"].alias("f"), i.alias("i"))),
                lambda a, b: a["p"] != b["p"],
                lambda x, rank, _: F.struct(
                    x["no"].alias("no"),
                    (F.get(seen, x["i"]) - x["f"].cast("int") - F.coalesce(F.get(seen, x["i"] - rank), F.lit(0)) > 0).alias("after"),
                ),
            )
            return F.transform(F.sort_array(found), lambda x: x["after"])

        return let(running_count(signature, "f"), look)

    return let(ordered, count)


def _flags(elements: Column, selector: Selector) -> Column:
    """For each element: whether the selector picks it.

    What stands outside ``html`` is read as if it stood in ``html`` and ``body``: two elements at the end of the array
    take their places (see ``_prepared``).
    """

    def of_step(before: Column | None, combinator: str, compound: Compound) -> Column:
        if before is None:
            return F.transform(elements, lambda e: _test(e, compound))
        if combinator == " ":
            candidates = _inside(elements, before)
        elif combinator == "~":
            candidates = _after_sibling(elements, before)
        else:
            field = "parent" if combinator == ">" else "before"
            candidates = F.transform(elements, lambda e: F.coalesce(F.get(before, e[field] - 1), F.lit(False)))
        return F.zip_with(elements, candidates, lambda e, c: c & _test(e, compound))

    def of_steps(before: Column | None, rest: tuple) -> Column:
        flags = of_step(before, *rest[0])
        return let(flags, lambda f: of_steps(f, rest[1:])) if len(rest) > 1 else flags

    found = of_steps(None, selector.alternatives[0])
    for steps in selector.alternatives[1:]:
        found = F.zip_with(found, of_steps(None, steps), lambda a, b: a | b)
    return found


def _prepared(units: Column, elements: Column, selectors: list[Selector]) -> Column:
    """The elements with what the selectors test, and after them an ``html`` and a ``body`` for pages without."""
    compounds = [c for s in selectors for steps in s.alternatives for _, c in steps]
    head = F.lit(" >")
    if any(_needs(c, "attributes") for c in compounds):
        head = None
    blank = any(_needs(c, "empty") for c in compounds)
    others = [f for f in (*PLACED, *(ORDINALS if needs_ordinals(selectors) else ())) if f != "parent"]

    def build(known: Column) -> Column:
        def one(e: Column, rooted: Column) -> Column:
            own = F.concat(F.lit(" "), F.regexp_extract(F.get(units, e["pos"]), "(?is)^<[a-z][^\\s/>]*(" + ATTRS + ")", 1)) if head is None else head
            no_text = F.length(F.regexp_replace(F.get(units, e["pos"]), "(?is)^<[a-z]" + ATTRS, "")) == 0
            # nothing but its own tags
            is_blank = ((e["end"] == e["pos"]) | ((e["end"] == e["pos"] + 1) & no_text)) if blank else F.lit(False)
            return F.struct(
                *[e[f].alias(f) for f in others],
                F.when(e["parent"].isNull() & (e["name"] != "html"), known["n"] + 2).otherwise(e["parent"]).alias("parent"),
                own.alias("head"), is_blank.alias("blank"), (~rooted).alias("implied"),
            )

        def stand_in(no: int, name: str, parent: Column) -> Column:
            at = {"no": known["n"] + no, "pos": F.lit(no - 3), "end": F.lit(no - 3), "name": F.lit(name), "depth": F.lit(0), "before": F.lit(None).cast("int")}
            values = at | {f: F.lit(1) for f in ("child_no", "children", "type_no", "types")}
            return F.struct(
                *[values[f].alias(f) for f in others], parent.cast("int").alias("parent"),
                F.lit(" >").alias("head"), F.lit(False).alias("blank"), F.lit(name == "body").alias("implied"),
            )

        rooted = counted_before(
            elements, F.transform(known["roots"], lambda e: e["pos"]), F.transform(known["roots"], lambda e: e["end"]),
            lambda e, opened, closed: (opened > closed) | (e["parent"].isNull() & (e["name"] == "html")),
        )
        return F.concat(
            F.zip_with(elements, rooted, one),
            F.array(stand_in(1, "html", F.lit(None)), stand_in(2, "body", known["n"] + 1)),
        )

    roots = F.filter(elements, lambda e: e["parent"].isNull() & (e["name"] == "html"))
    return let(F.struct(F.size(elements).alias("n"), roots.alias("roots")), build)


def _chosen(units: Column, elements: Column, selector: Selector, within: Selector | None, body) -> Column:
    """body(elements, flags): the elements of the page, and whether each is picked inside the scope."""
    real = lambda xs: F.slice(xs, F.lit(1), F.size(elements))

    def look(prepared: Column) -> Column:
        flags = _flags(prepared, selector)
        if within is not None:
            scoped = let(_flags(prepared, within), lambda f: _inside(prepared, f))
            flags = F.zip_with(flags, scoped, lambda a, b: a & b)
        return let(flags, lambda f: body(real(prepared), real(f)))

    return let(_prepared(units, elements, [selector] + ([within] if within else [])), look)


#: the units and elements of a page, where they stand in columns already
Tree = tuple[Column, Column]


def _over_tree(html: Column, tree: Tree | None, selectors: list[Selector], body: Callable[[Column, Column], Column]) -> Column:
    return body(*tree) if tree else let(page_units(html), lambda u: let(elements_of(u, needs_ordinals(selectors)), lambda els: body(u, els)))


def select_table_numbers(html: Column, table_selector: str, scope_selector: str | None = None, tree: Tree | None = None) -> Column:
    """Numbers (document order, 1-based) of the tables a selector picks."""
    tables = compile_selector(table_selector)
    scope = compile_selector(scope_selector) if scope_selector else None

    def number(elements: Column, flags: Column) -> Column:
        every = F.filter(F.zip_with(elements, flags, lambda e, f: F.struct(e["name"].alias("name"), f.alias("f"))), lambda x: x["name"] == "table")
        return F.filter(F.transform(every, lambda x, i: F.when(x["f"], i + 1)), lambda n: n.isNotNull())

    return _over_tree(html, tree, [tables] + ([scope] if scope else []), lambda units, elements: _chosen(units, elements, tables, scope, number))


def nearest_preceding_text(html: Column, selector: str, tree: Tree | None = None) -> Column:
    """Per table: text of the last matching element that starts before it."""
    wanted = compile_selector(selector)

    def look_up(units: Column, elements: Column, flags: Column) -> Column:
        found = F.transform(F.filter(F.arrays_zip(elements.alias("e"), flags.alias("f")), lambda z: z["f"]), lambda z: z["e"])

        def merge(known: Column) -> Column:
            # a table that matches the selector itself is not its own heading
            last = counted_before(known["tables"], F.transform(known["hits"], lambda e: e["pos"]), F.array().cast("array<int>"), lambda _, n, __: n)
            return F.transform(last, lambda n: F.get(known["texts"], n - 1))

        # the text of a heading is read once, however many tables stand under it
        texts = F.transform(found, lambda e: element_text(units, e))
        tables = F.transform(F.filter(elements, lambda e: e["name"] == "table"), lambda e: F.struct(e["pos"].alias("pos")))
        return let(F.struct(tables.alias("tables"), F.transform(found, lambda e: F.struct(e["pos"].alias("pos"))).alias("hits"), texts.alias("texts")), merge)

    return _over_tree(html, tree, [wanted], lambda units, elements: _chosen(units, elements, wanted, None, lambda els, flags: look_up(units, els, flags)))


def under_heading_in_parent(html: Column, level: int, text: str, index: int, tree: Tree | None = None) -> Column:
    """Number of the ``index``-th table after a matching heading inside the
    heading's parent element; later headings are tried in turn."""
    wanted = (text or "").strip().lower()

    def body(units: Column, elements: Column) -> Column:
        tables = F.transform(F.filter(elements, lambda e: e["name"] == "table"), lambda e: e["pos"])
        # where each heading begins, and where its parent ends
        headings = F.filter(
            elements,
            lambda e: (e["name"] == f"h{level}")
            & (F.contains(F.lower(element_text(units, e)), F.lit(wanted)) if wanted else F.lit(True)),
        )

        spans = F.transform(
            headings, lambda h: F.struct(h["pos"].alias("pos"), F.coalesce(F.get(elements, h["parent"] - 1)["end"], F.lit(2147483647)).alias("stop"))
        )

        def choose(known: Column) -> Column:
            hits = counted_before(
                known["headings"], known["tables"], F.array().cast("array<int>"),
                lambda h, before, _: F.when(F.get(known["tables"], before + F.lit(index - 1)) <= h["stop"], before + F.lit(index)),
            )
            return F.get(F.filter(hits, lambda n: n.isNotNull()), F.lit(0))

        return let(F.struct(tables.alias("tables"), spans.alias("headings")), choose)

    return _over_tree(html, tree, [], body)
