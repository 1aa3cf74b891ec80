"""Putting new content in the place of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabledocs.functions.markup import balanced_levels, lossless_units, numbered_tables, tables_column
from tabledocs.functions.render import minify
from tabledocs.functions.text import let
from tabledocs.operators.quality import html_error, sanitize_html
from tabledocs.operators.select import no_match_error, ordinals_of, reads_tree, selected_numbers, with_tree
from tabledocs.operators.style import style_tables
from tabledocs.plans.convert import convert
from tabledocs.plans.options import ShapeOptions, StyleOptions, TableSelector, WriteOptions

_TAG_END = "(?is)^</table(?:\\s[^<>]*)?>"


def splice_table(html: Column, table_no: Column, content: Column) -> Column:
    """The page with table ``table_no`` (document order) replaced by ``content``."""

    def cut(units: Column, signature: Column, levels: Column) -> Column:
        opens = F.filter(
            F.transform(F.regexp_extract_all(signature, F.lit("."), F.lit(0)), lambda s, i: F.when(s == "O", i)),
            lambda i: i.isNotNull(),
        )

        def around(known: Column) -> Column:
            start, insert = known["start"], known["content"]
            own = F.get(levels, start)
            after = F.transform(
                F.slice(levels, start + 2, F.greatest(F.size(levels) - start - 1, F.lit(0))), lambda v: v < own
            )
            # units from the opening tag to the closing one; all the rest if it is missing
            length = let(
                F.array_position(after, F.lit(True)).cast("int"),
                lambda at: F.when(at == 0, F.size(units) - start).otherwise(at + 1),
            )

            def join(n: Column) -> Column:
                last = F.get(units, start + n - 1)
                return F.concat(
                    F.array_join(F.slice(units, F.lit(1), start), ""),
                    insert,
                    F.when(last.startswith("</"), F.regexp_replace(last, _TAG_END, "")).otherwise(F.lit("")),
                    F.array_join(
                        F.slice(units, start + n + 1, F.greatest(F.size(units) - start - n, F.lit(0))), ""
                    ),
                )

            return let(length, join)

        # bound here, so the page's own columns are read once, outside the lambdas
        return let(
            F.struct(F.get(opens, table_no - 1).alias("start"), content.alias("content")), around
        )

    def start(units: Column) -> Column:
        signature = F.array_join(
            F.transform(
                units,
                lambda u: let(
                    F.lower(F.substr(u, F.lit(1), F.lit(7))),
                    lambda n: F.when(n.startswith("</table"), "c").when(n.startswith("<table"), "O").otherwise("x"),
                ),
            ),
            "",
        )
        return let(signature, lambda s: let(balanced_levels(s), lambda v: cut(units, s, v)))

    return let(lossless_units(html, "/?table"), start)


def replace_table(
    df: DataFrame,
    content: Column | str,
    html: str = "html",
    selector: TableSelector = TableSelector("first-table"),
    *,
    sanitize: bool = True,
    pretty: bool = False,
    output: str = "html",
    error: str = "error",
) -> DataFrame:
    """Replace the first selected table of each page.

    ``content`` is a column (or its name) or a literal Column.  A page without
    such a table, or without content, stays as it is; the former gets an error.
    """
    insert = F.col(content) if isinstance(content, str) else content
    if sanitize:
        insert = sanitize_html(insert)
    columns = [c for c in df.columns if c not in (output, error)]
    staged = df.withColumn("__problem", html_error(html, need_table=False)).withColumn("__insert", insert)
    source = F.when(F.col("__problem").isNull(), F.col(html))
    staged = staged.withColumn("__page", sanitize_html(source) if sanitize else source)
    # captions are read only when tables are chosen by them
    read = tables_column if selector.preset == "table-with-caption" else numbered_tables
    staged = staged.withColumn("__every", read(F.col("__page")))
    tree = None
    if reads_tree(selector):
        staged, tree = with_tree(staged, "__page", ordinals_of(selector))
    staged = staged.withColumn("__chosen", selected_numbers(F.col("__page"), F.col("__every"), selector, tree))
    spliced = splice_table(F.col("__page"), F.get("__chosen", F.lit(0)), F.col("__insert"))
    result = F.when(
        (F.size("__chosen") > 0) & F.col("__insert").isNotNull(), spliced
    ).otherwise(F.col("__page"))
    return staged.select(
        *columns,
        F.coalesce(result if pretty else minify(result), F.col(html)).alias(output),
        F.coalesce("__problem", no_match_error(F.col("__chosen"), selector)).alias(error),
    )


def replacement_tables(
    df: DataFrame,
    source: str,
    payload: str = "payload",
    *,
    shape: ShapeOptions = ShapeOptions(),
    write: WriteOptions = WriteOptions(),
    style: StyleOptions | None = None,
    output: str = "content",
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """HTML to insert, made from CSV, JSON or object payloads.

    Payloads are checked, sorted and projected; a style touches only the table
    that is inserted, never the page.
    """
    made = convert(df, source, "html", payload, shape=shape, write=write, mode=mode, output=output, error="error")
    return style_tables(made, style, output, sanitize=False, output=output) if style is not None else made


def replace_from(
    docs: DataFrame,
    replacements: DataFrame,
    key: str,
    content: str,
    html: str = "html",
    selector: TableSelector = TableSelector("first-table"),
    **options,
) -> DataFrame:
    """Replace per page by key: one row out for each page.

    A key with several replacements names none of them, so its page stays as it is, with
    an error.  Replacements are counted per key before the join, with partial sums, so a key
    repeated very often costs no more than another.  The join is an ordinary left join:
    Spark broadcasts the replacements when their size at run time allows it, and splits the
    partition of a hot key when not.
    """
    error = options.get("error", "error")
    side = replacements.groupBy(F.col(key).alias("__key")).agg(
        F.min(content).alias("__content"), F.count(F.lit(1)).alias("__count")
    )
    joined = docs.join(side, docs[key].eqNullSafe(F.col("__key")), "left").drop("__key")
    single = F.when(F.col("__count") == 1, F.col("__content"))
    out = replace_table(joined, single, html, selector, **options)
    several = F.when(F.col("__count") > 1, F.concat(F.col("__count").cast("string"), F.lit(" replacements for one page")))
    return out.withColumn(error, F.coalesce(several, error)).drop("__content", "__count")
