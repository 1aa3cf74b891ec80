"""From pages to tables, rows, cells and records.

All operators are projections and explodes of one row each: no shuffle, and
they work on streaming frames as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabledocs.functions.css import nearest_preceding_text
from tabledocs.functions.markup import HEADING_PATH_TYPE, heading_paths, tables_column
from tabledocs.functions.nested import tables_with_nested
from tabledocs.functions.payload import zip_record
from tabledocs.functions.text import as_column, let
from tabledocs.operators.quality import sanitize_html
from tabledocs.operators.select import ordinals_of, reads_tree, select_tables, with_tree
from tabledocs.plans.options import ExtractOptions


def _single_paths(texts: Column) -> Column:
    return F.transform(
        texts,
        lambda t: F.when(
            t.isNotNull(), F.array(F.struct(F.lit(1).alias("level"), t.alias("text")))
        ).otherwise(F.array().cast(HEADING_PATH_TYPE)),
    )


def with_tables(df: DataFrame, html: str = "html", options: ExtractOptions = ExtractOptions(),
                output: str = "tables") -> DataFrame:
    """Add the selected tables of each page as one array column of
    ``struct<table_no, n_tables, depth, caption, headers, rows, heading_path>``.

    Pages of any size and depth are read; to set some aside, split by
    ``html_error`` first.  ``heading_path`` is empty unless headings are asked for.  Header rows are not
    part of ``rows``; with ``include_headers=False`` the headers are dropped.
    The steps are separate projections of one narrow stage.
    """
    o = options
    columns = df.columns
    source = as_column(html)
    page = sanitize_html(source) if o.sanitize else source
    staged = df.withColumn("__page", page)
    h, every = F.col("__page"), F.col("__every")
    read = tables_with_nested if o.include_nested else tables_column
    staged = staged.withColumn("__every", read(h, o.cell_format))
    tree = None
    if o.heading_selector.strip() or reads_tree(o.selector):
        staged, tree = with_tree(staged, "__page", ordinals_of(o.selector, o.heading_selector))
    if o.heading_selector.strip():
        staged = staged.withColumn("__paths", nearest_preceding_text(h, o.heading_selector, tree))
        staged = staged.withColumn("__paths", _single_paths(F.col("__paths")))
    elif o.detects_headings:
        staged = staged.withColumn("__paths", heading_paths(h))
    else:
        staged = staged.withColumn("__paths", F.array().cast(f"array<{HEADING_PATH_TYPE}>"))
    staged = staged.withColumn("__chosen", select_tables(h, every, o.selector, tree))

    def shape(total: Column, paths: Column):
        def one(t: Column) -> Column:
            headers = t["headers"] if o.include_headers else F.array().cast("array<string>")
            return F.struct(
                t["table_no"].alias("table_no"),
                total.alias("n_tables"),
                t["depth"].alias("depth"),
                t["caption"].alias("caption"),
                headers.alias("headers"),
                t["rows"].alias("rows"),
                F.coalesce(F.get(paths, t["table_no"] - 1), F.array().cast(HEADING_PATH_TYPE)).alias("heading_path"),
            )

        return one

    result = let(
        F.struct(F.size(every).alias("n"), F.col("__paths").alias("paths")),
        lambda known: F.transform(F.col("__chosen"), shape(known["n"], known["paths"])),
    )
    kept = [F.col(c) for c in columns if c != output]
    return staged.select(*kept, result.alias(output))


def each(df: DataFrame, keep: list, items: Column | str, item: str, position: str = "__pos") -> DataFrame:
    """One row per array element, with its 1-based position.

    The outer form is used on purpose: for a plain explode the optimizer adds a
    filter on the array and pushes a second copy of its whole expression down.
    """
    out = df.select(*keep, F.posexplode_outer(items).alias("__i", item)).filter(F.col("__i").isNotNull())
    others = [c for c in out.columns if c not in ("__i", item)]
    return out.select(*others, (F.col("__i") + 1).alias(position), item)


def _exploded(df: DataFrame, html: str, options: ExtractOptions, keep: list[str] | None) -> DataFrame:
    kept = [c for c in df.columns if c != html] if keep is None else keep
    return each(with_tables(df, html, options, "__tables"), kept, "__tables", "__t").drop("__pos")


def tables(df: DataFrame, html: str = "html", options: ExtractOptions = ExtractOptions(),
           keep: list[str] | None = None) -> DataFrame:
    """One row per table: number, depth, caption, headers, heading path, row count."""
    t = F.col("__t")
    exploded = _exploded(df, html, options, keep)
    kept = [c for c in exploded.columns if c != "__t"]
    return exploded.select(
        *kept,
        t["table_no"].alias("table_no"), t["n_tables"].alias("n_tables"), t["depth"].alias("depth"),
        t["caption"].alias("caption"), t["headers"].alias("headers"),
        t["heading_path"].alias("heading_path"), F.size(t["rows"]).alias("n_rows"),
    )


def rows(df: DataFrame, html: str = "html", options: ExtractOptions = ExtractOptions(),
         keep: list[str] | None = None) -> DataFrame:
    """One row per table row: ``table_no, row_no, headers, cells``."""
    exploded = _exploded(df, html, options, keep)
    kept = [c for c in exploded.columns if c != "__t"]
    t = F.col("__t")
    fields = [t[n].alias(n) for n in ("table_no", "caption", "heading_path", "headers")]
    return each(exploded, [*kept, *fields], t["rows"], "cells", "row_no").select(
        *kept, "table_no", "row_no", "caption", "heading_path", "headers", "cells"
    )


def cells(df: DataFrame, html: str = "html", options: ExtractOptions = ExtractOptions(),
          keep: list[str] | None = None) -> DataFrame:
    """One row per cell: ``table_no, row_no, col_no, header, value``."""
    r = rows(df, html, options, keep)
    kept = [c for c in r.columns if c not in ("table_no", "row_no", "caption", "heading_path", "headers", "cells")]
    # headers stand beside their cells, so that a cell does not carry all of them
    titled = F.transform("cells", lambda v, i: F.struct(F.get("headers", i).alias("header"), v.alias("value")))
    return each(r, [*kept, "table_no", "row_no"], titled, "__c", "col_no").select(
        *kept, "table_no", "row_no", "col_no", F.col("__c")["header"].alias("header"), F.col("__c")["value"].alias("value")
    )


def records(df: DataFrame, html: str = "html", options: ExtractOptions = ExtractOptions(),
            keep: list[str] | None = None) -> DataFrame:
    """One row per table row, as a map from header to cell."""
    r = rows(df, html, options, keep)
    kept = [c for c in r.columns if c not in ("headers", "cells")]
    return r.select(*kept, zip_record(F.col("headers"), F.col("cells")).alias("rec"))


def record_columns(records_df: DataFrame, headers: dict[str, str] | list[str], rec: str = "rec",
                   keep: list[str] | None = None) -> DataFrame:
    """Known headers as typed columns: ``{"header": "bigint", ...}``."""
    types = headers if isinstance(headers, dict) else {h: "string" for h in headers}
    kept = [c for c in records_df.columns if c != rec] if keep is None else keep
    return records_df.select(
        *kept, *[F.try_element_at(rec, F.lit(h)).try_cast(t).alias(h) for h, t in types.items()]
    )
