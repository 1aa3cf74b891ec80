"""Queries on documents that are built from many rows, and on payloads of rows without names."""

from __future__ import annotations

from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import WriteOptions
from workload import documents as D
from workload.registry import query

_FLAG_ROWS = """
f AS (SELECT l_returnflag AS flag, l_orderkey || ',' || l_linenumber || ',' || l_partkey AS t, l_orderkey, l_linenumber FROM lineitem),
r AS (SELECT *, row_number() OVER w AS rn, coalesce(sum(strlen(t)) OVER (PARTITION BY flag ORDER BY l_orderkey, l_linenumber, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM f WINDOW w AS (PARTITION BY flag ORDER BY l_orderkey, l_linenumber, t))"""


@query(
    f"""WITH {_FLAG_ROWS}
SELECT flag, CAST((rn - 1) // 1500 + before // 16000 AS BIGINT) AS part, 'l_orderkey,l_linenumber,l_partkey' || chr(10) || string_agg(t, chr(10) ORDER BY rn) AS csv
FROM r GROUP BY flag, (rn - 1) // 1500 + before // 16000"""
)
def hot_key_csv_parts(spark, sf):
    """Three groups, one with half of all rows: parts bounded by rows and by bytes."""
    rows = D.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    return td.render_groups(
        rows, ["flag"], ["l_orderkey", "l_linenumber", "l_partkey"], ["l_orderkey", "l_linenumber"], "csv", output="csv", max_rows=1500, max_bytes=16_000
    )


@query(
    """WITH j AS (SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS t FROM customer),
r AS (SELECT *, coalesce(sum(strlen(t)) OVER (ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 9000 AS part FROM j)
SELECT CAST(part AS BIGINT) AS part, '[' || string_agg(t, ',' ORDER BY c_custkey) || ']' AS payload FROM r GROUP BY part"""
)
def all_at_once_by_bytes(spark, sf):
    """One output for the whole batch, in parts of bounded bytes, as they are written."""
    rows = D.table(spark, sf, "customer")
    return td.render_all(rows, ["c_custkey", "c_name", "c_mktsegment"], ["c_custkey"], "json", max_bytes=9000)


@query(
    """WITH e AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'kind' WHEN 1 THEN 'user' ELSE 'extra' END AS name, event_type AS v, json_extract_string(props, '$.k') AS k FROM events),
names AS (SELECT name, min(event_id) AS f FROM e GROUP BY name),
cols AS (SELECT string_agg(name, ',' ORDER BY f) AS heads, list(name ORDER BY f) AS ns FROM names),
-- the key that all objects share comes after the first object's own key, which has its place before it
r AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 700 AS part, name, v, k FROM e)
SELECT part, ns[1] || ',k' || coalesce(',' || array_to_string(ns[2:], ','), '') || chr(10) ||
  string_agg(CASE WHEN name = ns[1] THEN v ELSE '' END || ',' || k || coalesce(',' || array_to_string([CASE WHEN x = name THEN v ELSE '' END FOR x IN ns[2:]], ','), ''), chr(10) ORDER BY event_id) AS payload
FROM r, cols GROUP BY part, ns"""
)
def batch_columns_of_all_objects(spark, sf):
    """Objects with different keys as one CSV: the columns are the keys of all objects, by first appearance."""
    name = F.element_at(F.array(F.lit("kind"), F.lit("user"), F.lit("extra")), (F.col("event_id") % 3 + 1).cast("int"))
    items = D.table(spark, sf, "events").select(
        "event_id", F.concat(F.lit('{"'), name, F.lit('":"'), "event_type", F.lit('",'), F.substr("props", F.lit(2))).alias("item")
    )
    return td.combine_objects(items, "item", ["event_id"], "csv", max_rows=700)


@query(
    f"""WITH {D.SQL_LINES}
SELECT l_orderkey, '<table><tbody>' || string_agg('<tr><td>' || line || '</td><td>' || flag || ' &lt;' || status || '</td></tr>', '' ORDER BY row_no) || '</tbody></table>' AS html,
  string_agg(line || ';' || flag || ' <' || status, chr(10) ORDER BY row_no) AS csv FROM li GROUP BY l_orderkey"""
)
def array_rows_to_html_and_csv(spark, sf):
    """A JSON array of arrays: a table without a header row, and CSV without one."""
    row = F.concat(F.lit("["), F.col("line").cast("string"), F.lit(',"'), "flag", F.lit(" <"), "status", F.lit('"]'))
    docs = td.group_text(D.lines(spark, sf), ["l_orderkey"], list(D.LINE_HEADERS), row, separator=",")
    docs = docs.select("l_orderkey", F.concat(F.lit("["), "body", F.lit("]")).alias("payload"))
    html = td.convert(docs, "json", "html", output="html").drop("error")
    return td.convert(html, "json", "csv", output="csv", write=WriteOptions(delimiter=";")).select("l_orderkey", "html", "csv")


@query(
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'invalid object' WHEN 1 THEN 'must be an object or array' END AS error FROM events"""
)
def object_validate(spark, sf):
    """Object payloads: broken, scalar, an object, an array of objects, an empty array."""
    k = F.col("event_id") % 5
    items = D.table(spark, sf, "events").select(
        "event_id",
        F.when(k == 0, F.concat("props", F.lit("}"))).when(k == 1, F.lit('"text"')).when(k == 2, F.col("props"))
        .when(k == 3, F.concat(F.lit(" ["), "props", F.lit("]"))).otherwise(F.lit("[]")).alias("item"),
    )
    return items.select("event_id", td.object_error("item").alias("error"))


@query(
    """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'no table elements found' END AS error, 1 AS stopped FROM pages"""
)
def failure_policy(spark, sf):
    """Bad documents are marked in one mode and stop the job in the other."""
    pages = D.table(spark, sf, "pages").select(
        "page_id", F.when(F.col("page_id") % 4 == 0, F.lit("<p>none</p>")).otherwise(F.concat("html", F.lit("<table></table>"))).alias("html")
    )
    error = td.html_error("html")
    marked = td.checked(pages, error)
    strict = td.checked(pages, error, "FAILFAST")
    try:
        strict.agg(F.count("error"), F.max("error")).collect()
        stopped = 0
    except Exception as failure:  # noqa: BLE001 - the job's own error is what is looked for
        stopped = int("no table elements found" in str(failure))
    return marked.select("page_id", "error", F.lit(stopped).alias("stopped"))


@query(
    f"""WITH {D.SQL_LINES}
SELECT l_orderkey, '<table style="color: blue; width: 100%;">' ||
  string_agg('<tr style="height: 2em; text-align: left;" id="r' || line || '"><td style="padding: 9px; margin: 0;">' || flag || '</td></tr>', '' ORDER BY row_no) || '</table>' AS html
FROM li GROUP BY l_orderkey"""
)
def style_merge(spark, sf):
    """Tags that already have a style: declarations that are set replace those of the same name, others stay."""
    line = F.concat(F.lit("<tr style='height:1em;text-align:left' id=\"r"), F.col("line").cast("string"), F.lit('"><td style="padding : 1px; margin:0">'), "flag", F.lit("</td></tr>"))
    pages = td.group_text(D.lines(spark, sf), ["l_orderkey"], list(D.LINE_HEADERS), line)
    pages = pages.select("l_orderkey", F.concat(F.lit('<table style="color:blue; width:5px">'), "body", F.lit("</table>")).alias("html"))
    options = td.StyleOptions(table_width="full", row_style="height:2em", cell_style="padding: 9px")
    return td.style_tables(pages, options).select("l_orderkey", "html")


def _outline_pages(spark, sf):
    """Orders as pages: rows under a heading, tables below it under equal subheadings, and a table before any heading."""
    lines = D.lines(spark, sf)
    section = F.concat(F.lit("<h2>Flag "), "flag", F.lit("</h2><table><tr><td>"), F.col("line").cast("string"), F.lit("</td></tr></table>"))
    pages = td.group_text(lines, ["l_orderkey"], list(D.LINE_HEADERS), section)
    return pages.select(
        "l_orderkey",
        F.concat(F.lit("<table><tr><td>first</td></tr></table><h1>Order no. "), F.col("l_orderkey").cast("string"), F.lit("</h1><table><tr><td>own</td></tr></table>"), "body").alias("html"),
    )


_SQL_OUTLINE = f"""WITH {D.SQL_LINES},
s AS (SELECT l_orderkey, flag, min(row_no) AS f, string_agg('["' || line || '"]', ',' ORDER BY row_no) AS j FROM li GROUP BY l_orderkey, flag)
SELECT l_orderkey, '{{"table_1":[["first"]],"Order_no_' || l_orderkey || '":{{"_data":[["own"]],' ||
  string_agg('"Flag_' || flag || '":[' || j || ']', ',' ORDER BY f) || '}}}}' AS json FROM s GROUP BY l_orderkey"""


@query(_SQL_OUTLINE)
def heading_keyed_own_data(spark, sf):
    """A table without heading, rows of a node with children, and equal headings whose rows are appended."""
    pages = td.with_tables(_outline_pages(spark, sf), "html", td.ExtractOptions())
    return td.heading_keyed_json(pages, "tables", "json").select("l_orderkey", "json")


@query(
    f"""WITH {D.SQL_LINES},
n AS (SELECT l_orderkey, flag, line, row_no, row_number() OVER (PARTITION BY l_orderkey, flag ORDER BY row_no) AS k FROM li),
g AS (SELECT l_orderkey, '"Flag_' || flag || CASE WHEN k > 1 THEN '_' || k ELSE '' END || '":[["' || line || '"]]' AS j, row_no FROM n)
SELECT l_orderkey, '{{"table_1":[["first"]],"Order_no_' || l_orderkey || '":{{"_data":[["own"]],' || string_agg(j, ',' ORDER BY row_no) || '}}}}' AS json FROM g GROUP BY l_orderkey"""
)
def heading_keyed_suffixes(spark, sf):
    """Equal headings are told apart by a number."""
    pages = td.with_tables(_outline_pages(spark, sf), "html", td.ExtractOptions())
    return td.heading_keyed_json(pages, "tables", "json", WriteOptions(duplicates="suffix")).select("l_orderkey", "json")
