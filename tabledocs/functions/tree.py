"""Element tree of a page as a nested column.

Elements are an array in document order. Everything that one element has to know of others — its parent, its place among its
siblings, what it lies inside — comes from sorting that array and counting along it, so the work of a
page grows by n log n with its elements, and no element looks at all others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from tabledocs.functions.markup import ANY_TAG, ATTRS, RAW, balanced_levels, drop_noncharacters
from tabledocs.functions.text import decode_entities, let, running_count, trim_text

# Elements that never have content.
VOID = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
)

PLACED = ("no", "pos", "end", "name", "depth", "parent")
ORDINALS = ("child_no", "children", "type_no", "types", "before")


def page_units(html: Column) -> Column:
    """Every tag together with the text that follows it."""
    clean = F.regexp_replace(drop_noncharacters(html), "(?is)" + RAW + "|<[!?]" + ATTRS, "")
    return F.regexp_extract_all(
        clean, F.lit("(?is)</?[a-z]" + ATTRS + "[^<]*+(?:<(?![/a-z])[^<]*+)*+"), F.lit(0)
    )


def numbered(ordered: Column, differs: Callable[[Column, Column], Column], body: Callable[[Column, Column, Column], Column]) -> Column:
    """body(item, rank, size) for each item of an ordered array, by its place in the stretch of items that do not differ from the one before."""

    def with_starts(signature: Column) -> Column:
        starts = F.filter(
            F.transform(F.regexp_extract_all(signature, F.lit("."), F.lit(0)), lambda s, i: F.when(s == "S", i)), lambda i: i.isNotNull()
        )
        known = F.struct(running_count(signature, "S").alias("group"), starts.alias("starts"), F.length(signature).alias("n"))

        def place(k: Column) -> Column:
            def one(item: Column, i: Column) -> Column:
                group = F.get(k["group"], i)
                start = F.get(k["starts"], group - 1)
                return body(item, i - start + 1, F.coalesce(F.get(k["starts"], group), k["n"]) - start)

            return F.transform(ordered, one)

        return let(known, place)

    signature = F.array_join(
        F.transform(ordered, lambda x, i: F.when((i == 0) | F.coalesce(differs(x, F.get(ordered, i - 1)), F.lit(True)), "S").otherwise(".")), ""
    )
    return let(signature, with_starts)


def counted_before(queries: Column, starts: Column, ends: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    """body(query, starts before it, ends before it) for each query (a struct that begins with a position), in order of position.

    `starts` and `ends` are arrays of positions; one at the position of a query is not before it. `queries` is read more than
    once: bind it with ``let`` unless it is a column or bound already.
    """
    # a null of the queries' type
    nothing = F.get(queries, F.lit(-1))

    def events(positions: Column, kind: int) -> Column:
        return F.transform(positions, lambda p: F.struct(p.cast("int").alias("at"), F.lit(kind).alias("kind"), nothing.alias("query")))

    asked = F.transform(queries, lambda q: F.struct(q["pos"].cast("int").alias("at"), F.lit(0).alias("kind"), q.alias("query")))
    merged = F.sort_array(F.concat(asked, events(starts, 1), events(ends, 2)))

    def count(ms: Column) -> Column:
        signature = F.array_join(F.transform(ms, lambda m: F.get(F.array(F.lit("q"), F.lit("O"), F.lit("c")), m["kind"])), "")
        return let(
            signature,
            lambda s: F.transform(
                F.filter(
                    F.arrays_zip(ms.alias("m"), running_count(s, "O").alias("opened"), running_count(s, "c").alias("closed")),
                    lambda z: z["m"]["kind"] == 0,
                ),
                lambda z: body(z["m"]["query"], z["opened"], z["closed"]),
            ),
        )

    return let(merged, count)


def _pairs(tags: Column) -> Column:
    """(pos, end, name) of every opening tag, by position; ``end`` is NULL where no closing tag belongs to it.

    Tags are sorted by name, so all names are matched by one pass over one text of opening and closing signs.
    """
    by_name = F.sort_array(
        F.transform(
            tags,
            lambda t: F.struct(
                t["name"].alias("name"), t["pos"].alias("pos"), t["close"].alias("close"),
                F.when(t["name"].isin(*VOID), F.lit("v")).when(t["close"], F.lit("c")).otherwise(F.lit("O")).alias("sign"),
            ),
        )
    )

    def match(ts: Column) -> Column:
        # a sign of its own between two names
        spaced = F.flatten(
            F.transform(
                ts,
                lambda t, i: F.when(
                    (i > 0) & (F.get(ts, i - 1)["name"] != t["name"]),
                    F.array(F.struct(F.lit("|").alias("sign"), t.alias("tag")), F.struct(t["sign"].alias("sign"), t.alias("tag"))),
                ).otherwise(F.array(F.struct(t["sign"].alias("sign"), t.alias("tag")))),
            )
        )

        def level(marks: Column) -> Column:
            levels = balanced_levels(F.array_join(F.transform(marks, lambda m: m["sign"]), ""))
            keyed = F.sort_array(
                F.filter(
                    F.zip_with(
                        marks, levels,
                        lambda m, up: F.when(
                            m["sign"].isin("O", "c"),
                            F.struct(
                                m["tag"]["name"].alias("name"), (up + (m["sign"] == "c").cast("int")).alias("level"),
                                m["tag"]["pos"].alias("pos"), m["tag"]["close"].alias("close"),
                            ),
                        ),
                    ),
                    lambda k: k.isNotNull(),
                )
            )
            void = F.transform(
                F.filter(ts, lambda t: t["name"].isin(*VOID) & ~t["close"]),
                lambda t: F.struct(t["pos"].alias("pos"), F.lit(None).cast("int").alias("end"), t["name"].alias("name")),
            )
            return let(
                keyed,
                lambda ks: F.sort_array(
                    F.concat(
                        void,
                        F.filter(
                            F.transform(
                                ks,
                                lambda k, i: F.when(
                                    ~k["close"],
                                    F.struct(
                                        k["pos"].alias("pos"),
                                        let(
                                            F.get(ks, i + 1),
                                            lambda n: F.when(n["close"] & (n["level"] == k["level"]) & (n["name"] == k["name"]), n["pos"]),
                                        ).alias("end"),
                                        k["name"].alias("name"),
                                    ),
                                ),
                            ),
                            lambda p: p.isNotNull(),
                        ),
                    )
                ),
            )

        return let(spaced, level)

    return let(by_name, match)


def _depths(elements: Column) -> Column:
    """How many elements are open at each one, itself included; one without an end holds nothing."""
    closed = F.filter(elements, lambda e: e["end"].isNotNull())
    return let(
        closed,
        lambda cs: counted_before(
            elements, F.transform(cs, lambda e: e["pos"]), F.transform(cs, lambda e: e["end"]), lambda e, opened, done: opened - done + 1
        ),
    )


def _with_parents(elements: Column, depths: Column) -> Column:
    """`no, pos, end, name, depth, parent`: the parent is the last element before one level up that has an end."""
    known = F.transform(
        F.arrays_zip(elements.alias("e"), depths.alias("d")),
        lambda z, i: F.struct((i + 1).alias("no"), z["e"].alias("e"), z["d"].alias("d")),
    )

    def attach(ks: Column) -> Column:
        # sorted by level: those who look for a parent, and those who can be one, by the level they are looked for on
        entries = F.sort_array(
            F.concat(
                F.transform(ks, lambda k: F.struct((k["d"] - 1).alias("key"), k["e"]["pos"].alias("pos"), F.lit("K").alias("s"), k["no"].alias("no"))),
                F.transform(
                    F.filter(ks, lambda k: k["e"]["end"].isNotNull()),
                    lambda k: F.struct(k["d"].alias("key"), k["e"]["pos"].alias("pos"), F.lit("M").alias("s"), k["no"].alias("no")),
                ),
            )
        )

        def resolve(es: Column) -> Column:
            signature = F.array_join(F.transform(es, lambda e: e["s"]), "")
            holders = F.filter(es, lambda e: e["s"] == "M")
            return let(
                F.struct(holders.alias("hs"), running_count(signature, "M").alias("ns")),
                lambda at: F.sort_array(
                    F.transform(
                        F.filter(F.arrays_zip(es.alias("e"), at["ns"].alias("n")), lambda z: z["e"]["s"] == "K"),
                        lambda z: F.struct(
                            z["e"]["no"].alias("no"),
                            let(F.get(at["hs"], z["n"] - 1), lambda h: F.when(h["key"] == z["e"]["key"], h["no"])).alias("parent"),
                        ),
                    )
                ),
            )

        return F.zip_with(
            ks, let(entries, resolve),
            lambda k, p: F.struct(
                k["no"].alias("no"), k["e"]["pos"].alias("pos"), F.coalesce(k["e"]["end"], k["e"]["pos"]).alias("end"),
                k["e"]["name"].alias("name"), k["d"].alias("depth"), p["parent"].alias("parent"),
            ),
        )

    return let(known, attach)


def _with_ordinals(elements: Column) -> Column:
    """Adds the place among all siblings and among those of the same name, how many there are, and the sibling before (its ``no``)."""
    parent = lambda e: F.coalesce(e["parent"], F.lit(0))
    children = F.sort_array(F.transform(elements, lambda e: F.struct(parent(e).alias("p"), e["no"].alias("no"))))
    types = F.sort_array(F.transform(elements, lambda e: F.struct(parent(e).alias("p"), e["name"].alias("name"), e["no"].alias("no"))))

    def place(known: Column) -> Column:
        by_child = F.sort_array(
            numbered(
                known["children"], lambda a, b: a["p"] != b["p"],
                lambda x, rank, size: F.struct(x["no"].alias("no"), rank.alias("rank"), size.alias("size")),
            )
        )
        earlier = F.sort_array(
            F.transform(known["children"], lambda x, i: F.struct(x["no"].alias("no"), F.when(F.get(known["children"], i - 1)["p"] == x["p"], F.get(known["children"], i - 1)["no"]).alias("before")))
        )
        by_type = F.sort_array(
            numbered(
                known["types"], lambda a, b: (a["p"] != b["p"]) | (a["name"] != b["name"]),
                lambda x, rank, size: F.struct(x["no"].alias("no"), rank.alias("rank"), size.alias("size")),
            )
        )
        return F.transform(
            F.arrays_zip(elements.alias("e"), by_child.alias("c"), by_type.alias("t"), earlier.alias("b")),
            lambda z: F.struct(
                *[z["e"][n].alias(n) for n in ("no", "pos", "end", "name", "depth", "parent")],
                z["c"]["rank"].alias("child_no"), z["c"]["size"].alias("children"), z["t"]["rank"].alias("type_no"), z["t"]["size"].alias("types"),
                z["b"]["before"].alias("before"),
            ),
        )

    return let(F.struct(children.alias("children"), types.alias("types")), place)


def spans_of(units: Column) -> Column:
    """``pos, end, name`` of the elements in document order: the units where they begin and end; ``end`` is NULL where nothing ends them."""
    tags = F.transform(
        units,
        lambda u, i: F.struct(
            i.alias("pos"), F.lower(F.regexp_extract(u, "^</?([a-zA-Z][^\\s/>]*)", 1)).alias("name"), u.startswith("</").alias("close")
        ),
    )
    return let(tags, _pairs)


def elements_of(units: Column, ordinals: bool = True) -> Column:
    """Elements in document order with the fields ``PLACED`` and, where asked for, ``ORDINALS``; an element that nothing ends is only its tag."""

    def placed(els: Column) -> Column:
        return let(_depths(els), lambda ds: let(_with_parents(els, ds), _with_ordinals) if ordinals else _with_parents(els, ds))

    return let(spans_of(units), placed)


def element_text(units: Column, element: Column) -> Column:
    """Text content of an element, trimmed."""
    # unit by unit: a slice would copy the array of all units for each element
    span = F.transform(F.sequence(element["pos"], F.greatest(element["end"] - 1, element["pos"])), lambda k: F.get(units, k))
    return trim_text(
        decode_entities(F.regexp_replace(F.array_join(span, ""), "(?s)" + ANY_TAG, ""))
    )
