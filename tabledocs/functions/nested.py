"""Descendant-wide reading of nested tables.

Here an outer table also yields the rows and cells of the tables inside it, as a
document-order search through all descendants does.  Elements are kept in
document order, so what lies inside one is a slice found by counting.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabledocs.functions.markdown import inline_to_markdown, number_lists
from tabledocs.functions.markup import ANY_TAG
from tabledocs.functions.text import decode_entities, let, running_count, trim_text
from tabledocs.functions.tree import counted_before, page_units, spans_of

# One symbol for each kind of element that is looked up.
_SYMBOLS = {"tr": "r", "td": "d", "th": "d", "caption": "c", "thead": "h", "table": "t"}


def _named(elements: Column, *names: str) -> Column:
    return F.filter(elements, lambda e: e["name"].isin(*names))


def _closed(elements: Column) -> Column:
    """Let an element without closing tag run up to the next of its kind."""
    return F.transform(
        elements,
        lambda e, i: F.struct(
            e["pos"].alias("pos"), e["name"].alias("name"),
            F.when(e["end"] > e["pos"], e["end"]).otherwise(
                F.coalesce(F.get(elements, i + 1)["pos"] - 1, F.lit(2147483647))
            ).alias("end"),
        ),
    )


def _signature(units: Column) -> Column:
    def symbol(unit: Column) -> Column:
        name = F.lower(F.regexp_extract(unit, "^<([a-zA-Z]+)(?=[\\s/>])", 1))
        return let(
            name,
            lambda n: F.coalesce(
                F.try_element_at(F.create_map(*[F.lit(x) for kv in _SYMBOLS.items() for x in kv]), n), F.lit(".")
            ),
        )

    return F.array_join(F.transform(units, symbol), "")


def tables_with_nested(html: Column, cell_format: str = "text") -> Column:
    """Like ``tables_column``, with the content of inner tables repeated in the
    tables around them."""

    def read(units: Column, seen: Column) -> Column:
        last = F.size(units) - 1

        def text_of(e: Column) -> Column:
            span = F.array_join(F.slice(units, e["pos"] + 1, F.least(e["end"], last) - e["pos"] + 1), "")
            if cell_format == "markdown":
                marked = inline_to_markdown(
                    F.regexp_replace(span, "(?is)</?(?:table|thead|tbody|tfoot|caption|tr|td|th)(?=[\\s/>])[^>]*>", ""), ""
                )
                return trim_text(number_lists(decode_entities(marked)))
            return trim_text(decode_entities(F.regexp_replace(span, "(?s)" + ANY_TAG, "")))

        def inside(kind: str, counts: str, outer: Column) -> Column:
            before = F.get(seen[counts], outer["pos"])
            upto = F.get(seen[counts], F.least(outer["end"], last))
            # the element itself may be of the kind looked for, so count from after it
            return F.slice(seen[kind], before + 1, F.greatest(upto - before, F.lit(0)))

        def table(t: Column, number: Column) -> Column:
            def shape(own: Column) -> Column:
                head = F.get(inside("heads", "n_heads", t), F.lit(0))
                in_head = F.get(inside("rows", "n_rows", head), F.lit(0))
                first = F.get(own, F.lit(0))
                by_head = inside("cells", "n_cells", in_head)
                titles = F.filter(inside("cells", "n_cells", first), lambda c: c["name"] == "th")

                def assemble(head_cells: Column, th: Column) -> Column:
                    use_head = F.coalesce(F.size(head_cells), F.lit(0)) > 0
                    use_first = F.coalesce(F.size(th), F.lit(0)) > 0
                    skip = F.when(use_head, in_head["pos"]).when(use_first, first["pos"]).otherwise(F.lit(-1))
                    headers = (
                        F.when(use_head, F.transform(head_cells, text_of))
                        .when(use_first, F.transform(th, text_of))
                        .otherwise(F.array().cast("array<string>"))
                    )
                    caption = F.get(inside("captions", "n_captions", t), F.lit(0))
                    return F.struct(
                        number.alias("table_no"),
                        t["depth"].alias("depth"),
                        F.when(caption.isNotNull(), text_of(caption)).alias("caption"),
                        headers.alias("headers"),
                        F.transform(
                            F.filter(own, lambda r: r["pos"] != skip),
                            lambda r: F.transform(inside("cells", "n_cells", r), text_of),
                        ).alias("rows"),
                    )

                return let(by_head, lambda h: let(titles, lambda th: assemble(h, th)))

            return let(inside("rows", "n_rows", t), shape)

        return F.transform(seen["tables"], lambda t, i: table(t, i + 1))

    def collect(units: Column, elements: Column) -> Column:
        def build(sig: Column) -> Column:
            tables = F.transform(
                _named(elements, "table"),
                lambda e: F.struct(
                    e["pos"].alias("pos"),
                    F.when(e["end"] > e["pos"], e["end"]).otherwise(F.size(units) - 1).alias("end"),
                ),
            )
            seen = F.struct(
                # those around a table began before it and have not ended
                let(tables, lambda ts: counted_before(
                    ts, F.transform(ts, lambda t: t["pos"]), F.transform(ts, lambda t: t["end"]),
                    lambda t, opened, closed: F.struct(t["pos"].alias("pos"), t["end"].alias("end"), (opened - closed + 1).alias("depth")),
                )).alias("tables"),
                let(_named(elements, "tr"), _closed).alias("rows"),
                let(_named(elements, "td", "th"), _closed).alias("cells"),
                let(_named(elements, "caption"), _closed).alias("captions"),
                let(_named(elements, "thead"), _closed).alias("heads"),
                running_count(sig, "r").alias("n_rows"),
                running_count(sig, "d").alias("n_cells"),
                running_count(sig, "c").alias("n_captions"),
                running_count(sig, "h").alias("n_heads"),
            )
            return let(seen, lambda s: read(units, s))

        return let(_signature(units), build)

    return let(page_units(html), lambda u: let(spans_of(u), lambda els: collect(u, els)))
