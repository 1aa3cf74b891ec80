"""Queries that choose tables by their places among siblings."""

from __future__ import annotations

from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import ExtractOptions, TableSelector
from workload import documents as D
from workload.registry import query


def _sql(condition: str) -> str:
    return f"""
WITH {D.SQL_CUSTOMER_TABLES}
SELECT page_id, table_no, 'Customers of ' || n_name AS caption, CAST(n_rows AS INTEGER) AS n_rows FROM tabs WHERE {condition}"""


# a region holds an h1 and, for each nation, an h2 and a table: table k of a region is child 2 k + 1
_CHOICES = {
    "css_nth_of_type": ("div.region > table:nth-of-type(2n+1)", "in_region % 2 = 1"),
    "css_nth_child": ("table:nth-child(4n+3), table:nth-child(5)", "(2 * in_region + 1) % 4 = 3 OR in_region = 2"),
    "css_nth_last_child": ("div > table:nth-last-child(-n+3)", "in_region > of_region - 2"),
    "css_nth_last_of_type": ("table:nth-last-of-type(2)", "in_region = of_region - 1"),
    "css_only_of_type": ("h1:only-of-type:first-child ~ table:nth-of-type(1), table:only-of-type", "in_region = 1"),
    "css_not": ("div.region:not(#ASIA, [id^=AM]) > :not(h1):not(h2):not(:last-child)", "r_name <> 'ASIA' AND r_name NOT LIKE 'AM%' AND in_region < of_region"),
    "css_next_sibling": ("h1 + h2 + table, #EUROPE > h2:nth-of-type(3) + table", "in_region = 1 OR r_name = 'EUROPE' AND in_region = 3"),
    "css_later_sibling": ("div.region > table:first-of-type ~ table", "in_region > 1"),
    "css_sibling_scopes": ("div.region ~ div.region:is(#EUROPE, #ASIA) table", "(r_name = 'EUROPE' OR r_name = 'ASIA') AND r_name > first_region"),
}


def _choose(name: str, selector: str, condition: str) -> None:
    sql = _sql(condition)
    if "first_region" in condition:
        sql = sql.replace("FROM tabs WHERE", "FROM (SELECT *, min(r_name) OVER (PARTITION BY page_id) AS first_region FROM tabs) WHERE")

    def run(spark, sf):
        options = ExtractOptions(selector=TableSelector("custom", table_selector=selector, multiple=True), headings=False)
        return td.tables(D.customer_pages(spark, sf), "html", options).select("page_id", "table_no", "caption", "n_rows")

    run.__name__ = name
    query(sql)(run)


for _name, (_selector, _condition) in _CHOICES.items():
    _choose(_name, _selector, _condition)


@query(
    f"""WITH {D.SQL_CUSTOMER_SECTIONS}
SELECT page_id, string_agg(opening || heading || chr(10) || CASE WHEN in_region = 2 AND table_no = k THEN '<p>gone</p>' ELSE tab END || closing, '' ORDER BY table_no) AS html
FROM sections LEFT JOIN (SELECT page_id AS p, min(table_no) AS k FROM tabs WHERE in_region = 2 GROUP BY 1) ON page_id = p GROUP BY page_id"""
)
def replace_by_place(spark, sf):
    """The first second table of a region replaced."""
    selector = TableSelector("custom", table_selector="div.region table:nth-of-type(2)")
    return td.replace_table(D.customer_pages(spark, sf), F.lit("<p>gone</p>"), selector=selector, pretty=True).select("page_id", "html")
