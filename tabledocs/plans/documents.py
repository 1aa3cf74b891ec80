"""Writing rows of any DataFrame as documents, one per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabledocs.functions import render
from tabledocs.functions.payload import object_items
from tabledocs.functions.text import escape_text
from tabledocs.operators.extract import each
from tabledocs.plans.assemble import PART_BYTES, PART_ROWS, group_text
from tabledocs.plans.options import WriteOptions

Columns = dict[str, Column] | list[str]


def _named(columns: Columns) -> dict[str, Column]:
    return columns if isinstance(columns, dict) else {c: F.col(f"`{c}`") for c in columns}


def _types(df: DataFrame, columns: dict[str, Column]) -> dict[str, str]:
    return dict(df.select(*[c.alias(n) for n, c in columns.items()]).dtypes)


def _html_line(columns: dict[str, Column], types: dict[str, str]) -> Column:
    parts = [F.lit("<tr>")]
    for name, column in columns.items():
        text = F.coalesce(column.cast("string"), F.lit(""))
        parts += [F.lit("<td>"), text if types[name] in _PLAIN_TYPES else escape_text(text), F.lit("</td>")]
    return F.concat(*parts, F.lit("</tr>"))


# Types whose text has nothing to escape or quote.
_PLAIN_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date")


def _csv_line(columns: dict[str, Column], types: dict[str, str], delimiter: str) -> Column:
    safe = not set(delimiter) & set("0123456789+-.eEaflrstuINny")
    fields = [
        F.coalesce(c.cast("string"), F.lit("")) if types[n] in _PLAIN_TYPES and safe
        else render.csv_field(c.cast("string"), delimiter)
        for n, c in columns.items()
    ]
    return F.concat_ws(delimiter, *fields)


def _most_bytes(columns: dict[str, Column], types: dict[str, str]) -> Column:
    """At least the bytes of a row's text in any target, without making it: no character is escaped by more than six others."""
    sizes = [F.lit(32) if types[n] in _PLAIN_TYPES else F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) * 6 for n, c in columns.items()]
    return sum(sizes, F.lit(sum(len(n.encode()) * 6 + 32 for n in columns)))


def render_groups(
    df: DataFrame,
    keys: list[str],
    columns: Columns,
    order: dict[str, Column] | list[str],
    target: str = "html",
    *,
    caption: str | None = None,
    write: WriteOptions = WriteOptions(),
    max_rows: int = PART_ROWS,
    max_bytes: int = PART_BYTES,
    output: str = "payload",
) -> DataFrame:
    """``keys, part, payload``: the rows of each group as one table or text.

    ``caption`` names a key column.  A group of more than ``max_rows`` rows or ``max_bytes`` bytes makes several
    complete texts, ordered by ``part`` (the rule of ``group_text``).
    """
    named = _named(columns)
    types = _types(df, named)
    heads = F.array(*[F.lit(n) for n in named])
    if target == "html":
        line, separator = _html_line(named, types), ""
    elif target == "csv":
        line, separator = _csv_line(named, types, write.delimiter), "\n"
    elif target == "json":
        line = F.to_json(F.struct(*[c.alias(n) for n, c in named.items()]), {"ignoreNullFields": "false"})
        separator = ","
    else:
        raise ValueError("target must be 'html', 'csv' or 'json'")
    grouped = group_text(df, keys, order, line, separator=separator, max_rows=max_rows, max_bytes=max_bytes, most=_most_bytes(named, types))
    body = F.col("body")
    if target == "html":
        text = F.concat(
            F.lit("<table>"),
            render.html_caption(F.col(caption).cast("string")) if caption else F.lit(""),
            render.html_head(heads) if write.include_headers else F.lit(""),
            F.lit("<tbody>"), body, F.lit("</tbody></table>"),
        )
    elif target == "csv":
        text = F.concat(render.csv_line(heads, write.delimiter), F.lit("\n"), body) if write.include_headers else body
    else:
        text = F.concat(F.lit("["), body, F.lit("]"))
        if write.pretty:
            text = render.pretty_json(text)
    return grouped.select(*keys, "part", text.alias(output))


def render_all(df: DataFrame, columns: Columns, order: dict[str, Column] | list[str], target: str = "html",
               **options) -> DataFrame:
    """``part, payload``: all rows as one text, or as parts when they are many."""
    return render_groups(df, [], columns, order, target, **options)


def first_appearance(df: DataFrame, items: Column, order: list[Column]) -> list[str]:
    """The keys of all records, each once, in order of first appearance.

    ``items`` is the map of a row's record.  The first position of each key is a minimum, so it is taken per task
    first; only the names, the columns of a result, reach the driver, as those of an inferred schema do.
    """
    at = [f"__b{i}" for i in range(len(order))]
    keys = df.select(*[c.alias(n) for n, c in zip(at, order, strict=True)], F.posexplode(F.map_keys(items)).alias("__k", "__key"))
    first = keys.groupBy("__key").agg(F.min(F.struct(*at, "__k")).alias("__first"))
    return [r["__key"] for r in first.orderBy("__first").select("__key").collect()]


def combine_objects(
    df: DataFrame,
    item: str,
    order: list[str],
    target: str = "json",
    *,
    write: WriteOptions = WriteOptions(),
    max_rows: int = PART_ROWS,
    max_bytes: int = PART_BYTES,
) -> DataFrame:
    """``part, payload``: the objects of all items as one output.

    Columns of HTML and CSV are the keys of all objects, in order of first appearance; an object without a key has an empty cell
    there.  ``__`` keys are left out and strings parsed as in ``object_items``.
    """
    typed = target == "json"
    exploded = each(df, order, object_items(F.col(item), typed=typed), "__rec", "__i")
    by = {**{o: F.col(o) for o in order}, "__i": F.col("__i")}
    if typed:
        grouped = group_text(exploded, [], by, F.to_json("__rec"), separator=",", max_rows=max_rows, max_bytes=max_bytes)
        return grouped.select("part", F.concat(F.lit("["), F.col("body"), F.lit("]")).alias("payload"))
    names = first_appearance(exploded, F.col("__rec"), list(by.values()))
    columns = {n: F.try_element_at("__rec", F.lit(n)) for n in names}
    return render_groups(exploded, [], columns, by, target, write=write, max_rows=max_rows, max_bytes=max_bytes)


def append_sections(
    df: DataFrame, key: str, order: list[str], heading: Column, body: Column, output: str = "html",
    **options,
) -> DataFrame:
    """``key, part, html``: sections (a heading text and a body) joined in order."""
    grouped = group_text(df, [key], order, F.concat(heading, body), **options)
    return grouped.select(key, "part", F.col("body").alias(output))

