"""One entry for every pair of source and target format.

A payload is read into tables or records, these are sorted and projected, and
written in the target format: four readers and four writers.  Everything is a
projection of one row, so a conversion of any number of payloads is one narrow
stage without a shuffle.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from tabledocs.functions import render
from tabledocs.functions.outline_json import mark_own_data, nested_json, order_by_path, with_paths
from tabledocs.functions.payload import (
    csv_cells, csv_records, json_records, json_rows, json_shape, key_value_rows, object_items, zip_record,
)
from tabledocs.functions.text import let
from tabledocs.operators.extract import each, with_tables
from tabledocs.operators.quality import checked, input_error
from tabledocs.operators.select import no_match_error
from tabledocs.operators.shape import manipulate_records, project_records, sort_records
from tabledocs.plans.options import FORMATS, ExtractOptions, OptionError, ShapeOptions, WriteOptions

# The result for an empty batch.
EMPTY = {"html": "<table></table>", "csv": "", "json": "[]", "objects": "[]"}

_NO_HEADERS = "array<string>"


def _headers_if(wanted: bool, headers: Column) -> Column:
    return headers if wanted else F.array().cast(_NO_HEADERS)


# -- tables of pages ---------------------------------------------------------------


def _shaped_tables(tables: Column, shape: ShapeOptions) -> Column:
    """Sort and project the rows of every table that has headers (``keyed``)."""

    def keep(t: Column, *extra: Column) -> Column:
        return F.struct(
            *[t[n].alias(n) for n in ("table_no", "caption", "headers", "rows", "heading_path")], *extra
        )

    if not (shape.sort_by.strip() or shape.fields.strip()):
        return F.transform(tables, lambda t: keep(t, (F.size(t["headers"]) > 0).alias("keyed")))

    def one(t: Column) -> Column:
        recs = F.transform(t["rows"], lambda r: zip_record(t["headers"], r))

        def project(sorted_records: Column) -> Column:
            kept = manipulate_records(sorted_records, ShapeOptions(fields=shape.fields))
            return let(
                kept,
                lambda rs: let(
                    _kept_headers(t["headers"], shape.fields),
                    lambda hs: F.struct(
                        t["table_no"].alias("table_no"), t["caption"].alias("caption"), hs.alias("headers"),
                        render.record_rows(rs, hs).alias("rows"), t["heading_path"].alias("heading_path"),
                        F.lit(True).alias("keyed"),
                    ),
                ),
            )

        return F.when(F.size(t["headers"]) == 0, keep(t, F.lit(False).alias("keyed"))).otherwise(
            let(sort_records(recs, shape.sort_by, shape.order), project)
        )

    return F.transform(tables, one)


def _kept_headers(headers: Column, fields: str) -> Column:
    if not fields.strip():
        return F.array_distinct(headers)
    probe = F.map_from_arrays(F.array_distinct(headers), F.array_distinct(headers))
    return F.map_keys(project_records(F.array(probe), fields)[0])


def _table_comment(t: Column) -> Column:
    path = F.array_join(F.transform(t["heading_path"], lambda h: h["text"]), " > ")
    return (
        F.when(F.size(t["heading_path"]) > 0, F.concat(F.lit("# "), path, F.lit("\n")))
        .when(t["caption"] != "", F.concat(F.lit("# "), t["caption"], F.lit("\n")))
        .otherwise(F.lit(""))
    )


def tables_html(tables: Column, options: WriteOptions = WriteOptions()) -> Column:
    """Selected tables rebuilt in one normal form."""
    separator = "\n\n" if options.pretty else ""
    return F.array_join(
        F.transform(
            tables,
            lambda t: render.html_table(_headers_if(options.include_headers, t["headers"]), t["rows"], t["caption"]),
        ),
        separator,
    )


def tables_csv(tables: Column, options: WriteOptions = WriteOptions(), newline: str = "\r\n") -> Column:
    """CSV of the tables, each after a comment line that names it."""
    return F.array_join(
        F.transform(
            tables,
            lambda t: F.concat(
                _table_comment(t),
                render.csv_text(
                    _headers_if(options.include_headers, t["headers"]), t["rows"], options.delimiter, newline
                ),
            ),
        ),
        "\n\n",
    )


def _table_data(t: Column, options: WriteOptions) -> Column:
    """Rows of a table as JSON: objects under headers, else arrays."""
    as_arrays = F.to_json(t["rows"])
    if not options.include_headers:
        return as_arrays
    return F.when(t["keyed"], F.to_json(F.transform(t["rows"], lambda r: zip_record(t["headers"], r)))).otherwise(as_arrays)


def _one_table_json(t: Column, options: WriteOptions) -> Column:
    data = _table_data(t, options)
    return F.when(
        t["caption"] != "",
        F.concat(F.lit('{"caption":'), _json_text(t["caption"]), F.lit(',"data":'), data, F.lit("}")),
    ).otherwise(data)


def _json_text(value: Column) -> Column:
    listed = F.to_json(F.array(value))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def _list_json(tables: Column, options: WriteOptions) -> Column:
    def one(t: Column) -> Column:
        caption = F.when(
            t["caption"] != "", F.concat(F.lit(',"caption":'), _json_text(t["caption"]))
        ).otherwise(F.lit(""))
        return F.concat(F.lit('{"data":'), _table_data(t, options), caption, F.lit("}"))

    return F.concat(F.lit("["), F.array_join(F.transform(tables, one), ","), F.lit("]"))


def heading_keyed_json(df: DataFrame, tables: str, output: str, options: WriteOptions = WriteOptions()) -> DataFrame:
    """Tables of a page as JSON nested by their headings."""
    return _heading_keyed(df.withColumn("__keyed", _shaped_tables(F.col(tables), ShapeOptions())), "__keyed", output,
                          options).drop("__keyed")


def _heading_keyed(df: DataFrame, tables: str, output: str, options: WriteOptions) -> DataFrame:
    columns = [c for c in df.columns if c != output]
    items = F.transform(
        F.col(tables),
        lambda t: F.struct(
            t["table_no"].alias("table_no"), t["heading_path"].alias("heading_path"),
            let(_table_data(t, options), lambda d: F.substr(d, F.lit(2), F.length(d) - 2)).alias("data"),
        ),
    )
    staged = df.withColumn("__items", items)
    staged = staged.withColumn("__items", with_paths(F.col("__items"), options.duplicates))
    staged = staged.withColumn("__items", mark_own_data(F.col("__items")))
    staged = staged.withColumn("__items", order_by_path(F.col("__items")))
    return staged.select(*columns, nested_json(F.col("__items")).alias(output))


def _write_tables(df: DataFrame, target: str, extract: ExtractOptions, write: WriteOptions) -> DataFrame:
    t = F.col("__tables")
    if target == "html":
        return df.withColumn("__out", tables_html(t, write))
    if target == "csv":
        return df.withColumn("__out", tables_csv(t, write))
    single = _one_table_json(F.get(t, F.lit(0)), write)
    if extract.detects_headings or extract.heading_selector.strip():
        df = _heading_keyed(df, "__tables", "__many", write)
        many = F.col("__many")
    else:
        many = _list_json(t, write)
    return df.withColumn("__out", F.when(F.size(t) > 1, many).otherwise(single))


# -- records ------------------------------------------------------------------------


def _write_records(records: Column, target: str, write: WriteOptions, newline: str = "\n") -> Column:
    if target == "html":
        return render.records_html(records, write.include_headers)
    if target == "csv":
        return render.records_csv(records, write.delimiter, write.include_headers, newline)
    return F.to_json(records)


def _write_rows(rows: Column, target: str, write: WriteOptions) -> Column:
    none = F.array().cast(_NO_HEADERS)
    text = F.transform(rows, lambda r: F.transform(r, lambda v: F.coalesce(v, F.lit("null"))))
    if target == "html":
        return render.html_table(none, text)
    if target == "csv":
        return render.csv_text(none, text, write.delimiter)
    return F.to_json(rows)


def _write_pairs(pairs: Column, target: str, write: WriteOptions) -> Column:
    if target == "html":
        return render.key_value_html(pairs, write.include_headers)
    return render.key_value_csv(pairs, write.delimiter, write.include_headers)


def _from_csv(df: DataFrame, target: str, shape: ShapeOptions, write: WriteOptions, delimiter: str) -> DataFrame:
    p = F.col("__in")
    asked = bool(shape.sort_by.strip() or shape.fields.strip())
    if target == "csv" and not asked and delimiter == write.delimiter:
        return df.withColumn("__out", p)
    if not write.include_headers:
        df = df.withColumn("__rows", csv_cells(p, delimiter))
        return df.withColumn("__out", _write_rows(F.col("__rows"), target, write))
    df = df.withColumn("__records", csv_records(p, delimiter))
    df = df.withColumn("__records", manipulate_records("__records", shape))
    written = _write_records(F.col("__records"), target, write)
    if target in ("html", "csv") and not asked:
        # a payload of only a header row still has its columns
        df = df.withColumn("__head", F.coalesce(F.get(csv_cells(p, delimiter), F.lit(0)), F.array().cast(_NO_HEADERS)))
        empty = F.array().cast("array<array<string>>")
        bare = (
            render.html_table(F.col("__head"), empty) if target == "html"
            else render.csv_text(F.col("__head"), empty, write.delimiter)
        )
        written = F.when(F.size("__records") == 0, bare).otherwise(written)
    return df.withColumn("__out", written)


def _from_json(df: DataFrame, target: str, shape: ShapeOptions, write: WriteOptions) -> DataFrame:
    p = F.col("__in")
    asked = bool(shape.sort_by.strip() or shape.fields.strip())
    if target == "json" and not asked:
        return df.withColumn("__out", p)
    df = df.withColumn("__shape", json_shape(p))
    df = df.withColumn("__records", json_records(p, typed=target == "json"))
    df = df.withColumn("__records", manipulate_records("__records", shape))
    df = df.withColumn("__rows", F.when(F.col("__shape") == "arrays", json_rows(p)))
    records = _write_records(F.col("__records"), target, write)
    if target == "json":
        return df.withColumn(
            "__out",
            F.when(F.col("__shape") == "arrays", p)
            .when(F.col("__shape") == "object", F.to_json(F.get("__records", F.lit(0))))
            .otherwise(records),
        )
    single = (
        records if asked else let(key_value_rows(p, write.qualified_keys and target == "html"),
                                  lambda kv: _write_pairs(kv, target, write))
    )
    if target == "csv" and not asked:
        flat = F.transform(
            F.map_entries(F.from_json(p, "map<string,string>")),
            lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"], F.lit("null")).alias("value")),
        )
        single = let(flat, lambda kv: _write_pairs(kv, target, write))
    return df.withColumn(
        "__out",
        F.when(F.col("__shape") == "objects", records)
        .when(F.col("__shape") == "arrays", _write_rows(F.col("__rows"), target, write))
        .when(F.col("__shape") == "object", single),
    )


def _from_objects(df: DataFrame, target: str, shape: ShapeOptions, write: WriteOptions) -> DataFrame:
    df = df.withColumn("__records", object_items(F.col("__in"), typed=target == "json"))
    df = df.withColumn("__records", manipulate_records("__records", shape))
    written = _write_records(F.col("__records"), target, write, "\r\n")
    return df.withColumn("__out", F.when(F.size("__records") == 0, F.lit(EMPTY[target])).otherwise(written))


def convert(
    df: DataFrame,
    source: str,
    target: str,
    payload: str = "payload",
    *,
    extract: ExtractOptions = ExtractOptions(),
    shape: ShapeOptions = ShapeOptions(),
    write: WriteOptions = WriteOptions(),
    input_delimiter: str = ",",
    strict_keys: bool = True,
    mode: str = "PERMISSIVE",
    output: str = "output",
    error: str = "error",
) -> DataFrame:
    """Convert a payload column from one format to another.

    Adds ``output`` (text; VARIANT for target 'objects') and ``error``; a payload
    that cannot be read has a NULL output.  ``mode='FAILFAST'`` stops instead.
    """
    for name in (source, target):
        if name not in FORMATS:
            raise OptionError(f"format must be one of {', '.join(FORMATS)}; got {name!r}")
    columns = [c for c in df.columns if c not in (output, error)]
    inner = "json" if target == "objects" else target
    if source == "objects":
        problem = F.when(F.col(payload).isNull(), F.lit("input is empty"))
    else:
        problem = input_error(payload, source, input_delimiter, strict_keys)
    staged = df.withColumn("__problem", problem)
    staged = staged.withColumn("__in", F.when(F.col("__problem").isNull(), F.col(payload)))
    if source == "html":
        reading = replace(extract, include_headers=True)
        staged = with_tables(staged, "__in", reading, "__tables")
        staged = staged.withColumn(
            "__problem",
            F.coalesce("__problem", no_match_error(F.col("__tables"), extract.selector)),
        )
        staged = staged.withColumn("__tables", _shaped_tables(F.col("__tables"), shape))
        writing = replace(write, include_headers=write.include_headers and extract.include_headers)
        staged = _write_tables(staged, inner, extract, writing)
    elif source == "csv":
        staged = _from_csv(staged, inner, shape, write, input_delimiter)
    elif source == "json":
        staged = _from_json(staged, inner, shape, write)
    else:
        staged = _from_objects(staged, inner, shape, write)
    out = F.col("__out")
    if inner == "json" and write.pretty and target == "json":
        out = render.pretty_json(out)
    elif inner == "html" and not write.pretty:
        out = render.minify(out)
    out = F.when(F.col("__problem").isNull(), out)
    if target == "objects":
        out = F.try_parse_json(out)
    staged = staged.withColumn("__final", out)
    kept = staged.select(*columns, F.col("__final").alias(output), F.col("__problem"))
    return checked(kept, F.col("__problem"), mode, error).select(*columns, output, error)


def wrap_output(df: DataFrame, column: str = "output", name: str = "convertedData", wrap: bool = True) -> DataFrame:
    """Nest a result under a field name, or give every object of an array its own row."""
    others = [c for c in df.columns if c != column]
    value = F.col(column)
    if wrap:
        return df.select(*others, F.struct(value.alias(name)).alias("item"))
    if dict(df.dtypes)[column] != "variant":
        return df.select(*others, value.alias("item"))
    parts = F.when(
        F.schema_of_variant(value).startswith("ARRAY"), value.try_cast("array<variant>")
    ).otherwise(F.array(value))
    return each(df, others, parts, "item", "item_no")


def fill_empty(df: DataFrame, ids: DataFrame, key: str, target: str, output: str = "output") -> DataFrame:
    """Every id of ``ids``, with the empty result of the format where none was built; each part of an output is a row."""
    return ids.join(df, key, "left").withColumn(output, F.coalesce(output, F.lit(EMPTY[target])))
