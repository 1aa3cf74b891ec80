"""Choosing tables of a page: filters on the ``tables`` array of one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabledocs.functions.css import Tree, compile_selector, needs_ordinals, select_table_numbers, under_heading_in_parent
from tabledocs.functions.markup import under_heading_number
from tabledocs.functions.text import contains_ignore_case, let
from tabledocs.functions.tree import elements_of, page_units
from tabledocs.plans.options import TableSelector


def _first(tables: Column) -> Column:
    return F.slice(tables, F.lit(1), F.lit(1))


def _numbered(tables: Column, numbers: Column) -> Column:
    return let(numbers, lambda ns: F.transform(ns, lambda n: F.get(tables, n - 1)))


def reads_tree(selector: TableSelector) -> bool:
    """Whether a selection needs the element tree of a page."""
    s = selector
    if s.element_selector is not None:
        return not _all_of_page(s)
    if s.preset in ("first-table", "last-table"):
        return s.takes_many
    if s.preset == "table-under-heading":
        return s.scope == "parent"
    return s.preset == "custom" and s.table_selector.strip() != "table"


def _all_of_page(s: TableSelector) -> bool:
    return s.element_selector.strip() in ("html", "body") and s.table_selector.strip() == "table"


def ordinals_of(selector: TableSelector, *others: str) -> bool:
    """Whether a selection looks at places among siblings."""
    s = selector
    texts = [x for x in (*others, s.element_selector, s.table_selector) if x and x.strip()]
    of_type = s.element_selector is None and s.preset in ("first-table", "last-table")
    return of_type or needs_ordinals([compile_selector(x) for x in texts])


def with_tree(df: DataFrame, html: str, ordinals: bool = True) -> tuple[DataFrame, Tree]:
    """``df`` with the units and elements of its pages as columns, which selections of any length then share."""
    staged = df.withColumn("__units", page_units(F.col(html)))
    return staged.withColumn("__elements", elements_of(F.col("__units"), ordinals)), (F.col("__units"), F.col("__elements"))


def select_tables(html: Column, tables: Column, selector: TableSelector, tree: Tree | None = None) -> Column:
    """Keep the tables of ``tables`` (all tables of ``html``) that are selected.

    ``tree`` has the elements of the page, where ``with_tree`` added them.
    """
    s = selector
    one = not s.takes_many
    if s.element_selector is not None:
        if _all_of_page(s):
            chosen = tables
        else:
            chosen = _numbered(tables, select_table_numbers(html, s.table_selector, s.element_selector, tree))
        return _first(chosen) if one else chosen
    if s.preset == "all-tables":
        return _first(tables) if one else tables
    if s.preset == "first-table":
        if one:
            return _first(tables)
        return _numbered(tables, select_table_numbers(html, "table:first-of-type", tree=tree))
    if s.preset == "last-table":
        if one:
            return F.slice(tables, F.greatest(F.size(tables), F.lit(1)), F.lit(1))
        return _numbered(tables, select_table_numbers(html, "table:last-of-type", tree=tree))
    if s.preset == "table-under-heading":
        wanted = (html, s.heading_level, s.heading_text, s.table_index)
        return let(
            under_heading_in_parent(*wanted, tree) if s.scope == "parent" else under_heading_number(*wanted),
            lambda n: F.slice(tables, F.coalesce(n, F.size(tables) + 1), F.lit(1)),
        )
    if s.preset == "table-with-caption":
        text = s.caption_text.strip()
        matched = F.filter(
            tables,
            lambda t: contains_ignore_case(t["caption"], text) if text else t["caption"].isNotNull(),
        )
        return _first(matched) if one else matched
    compile_selector(s.table_selector)
    chosen = tables if s.table_selector.strip() == "table" else _numbered(
        tables, select_table_numbers(html, s.table_selector, tree=tree)
    )
    return _first(chosen) if one else chosen


def selected_numbers(html: Column, tables: Column, selector: TableSelector, tree: Tree | None = None) -> Column:
    return F.transform(select_tables(html, tables, selector, tree), lambda t: t["table_no"])


def no_match_error(selected: Column, selector: TableSelector) -> Column:
    """Error text naming the selection when a page has no such table."""
    s = selector
    if s.element_selector is not None:
        what = f"no tables found for {s.table_selector!r} inside {s.element_selector!r}"
    elif s.preset == "table-under-heading":
        what = (
            f"no table {s.table_index} found under an h{s.heading_level} heading containing "
            f"{s.heading_text!r}; check the level, the text and the table number"
        )
    elif s.preset == "table-with-caption":
        what = f"no table found with a caption containing {s.caption_text!r}"
    elif s.preset == "custom":
        what = f"no tables found for selector {s.table_selector!r}"
    else:
        what = f"no tables found for preset {s.preset!r}"
    return F.when(F.coalesce(F.size(selected), F.lit(0)) <= 0, F.lit(what))
