"""The registered queries and, beside each, the SQL with the same result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

import tabledocs as td
from tabledocs import ExtractOptions, ShapeOptions, StyleOptions, TableSelector, WriteOptions
from tabledocs.functions import render
from tabledocs.functions.markup import lossless_units
from tabledocs.functions.payload import (
    csv_records, json_records, json_rows, json_shape, key_value_rows, object_items, zip_record,
)
from tabledocs.functions.text import decode_entities, escape_html
from tabledocs.operators.quality import MAX_DEPTH, MAX_HTML_BYTES, MAX_JSON_BYTES
from tabledocs.operators.select import no_match_error
from tabledocs.operators.shape import sort_keys
from tabledocs.plans.assemble import checkpoint_folder
from tabledocs.streaming.documents import stream_documents, stream_tables, write_stream
from workload import documents as D
from workload.registry import ORACLE, QUERIES, Query, query  # noqa: F401

PLAIN = ExtractOptions(headings=False)


def chosen(**options) -> ExtractOptions:
    return ExtractOptions(selector=TableSelector(**options), headings=False)


def table_list(df: DataFrame, options: ExtractOptions) -> DataFrame:
    return td.tables(df, "html", options).select("page_id", "table_no", "caption", "n_rows")


SQL_TABLE_LIST = f"""
WITH {D.SQL_CUSTOMER_TABLES}
SELECT page_id, table_no, 'Customers of ' || n_name AS caption, CAST(n_rows AS INTEGER) AS n_rows
FROM tabs"""


# -- assembly ---------------------------------------------------------------------


@query(
    f"""WITH {D.SQL_CUSTOMERS}
SELECT n_name, part, '<table><caption>' || n_name || '</caption>{D.SQL_CUSTOMER_HEAD}<tbody>' ||
       string_agg({D.SQL_CUSTOMER_LINE}, '' ORDER BY c_custkey) || '</tbody></table>' AS html
FROM (SELECT *, (row_number() OVER (PARTITION BY n_name ORDER BY c_custkey) - 1) // 40 AS part FROM cust) GROUP BY n_name, part"""
)
def render_html_by_nation(spark, sf):
    return td.render_groups(
        D.customers(spark, sf), ["n_name"], list(D.CUSTOMER_HEADERS), ["c_custkey"], caption="n_name", output="html", max_rows=40
    )


@query(
    f"""WITH {D.SQL_CONVERSATIONS}
SELECT conv_id, part, 'turn;role;text' || chr(10) || string_agg(
  turn || ';' || role || ';"' || replace(text, '"', '""') || '"', chr(10) ORDER BY turn, role, text) AS csv
FROM (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1) // 6 AS part FROM conv) GROUP BY conv_id, part"""
)
def records_to_csv(spark, sf):
    return td.render_groups(
        D.conversations(spark, sf), ["conv_id"], ["turn", "role", "text"], ["turn", "role", "text"], "csv",
        write=WriteOptions(delimiter=";"), output="csv", max_rows=6,
    )


@query(
    f"""WITH {D.SQL_CONVERSATIONS},
j AS (SELECT conv_id, turn, role, text, '{{"turn":' || turn || ',"role":' || CAST(to_json(role) AS VARCHAR) || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}}' AS t FROM conv),
b AS (SELECT *, coalesce(sum(strlen(t)) OVER (PARTITION BY conv_id ORDER BY turn, role, text, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM j)
SELECT conv_id, CAST(before // 1200 AS BIGINT) AS part, '[' || string_agg(t, ',' ORDER BY turn, role, text) || ']' AS json FROM b GROUP BY conv_id, before // 1200"""
)
def records_to_json(spark, sf):
    """One JSON text per conversation, or several where its bytes exceed the bound."""
    return td.render_groups(
        D.conversations(spark, sf), ["conv_id"], ["turn", "role", "text"], ["turn", "role", "text"], "json", output="json", max_bytes=1200
    )


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def all_at_once(spark, sf):
    """One output for the whole batch, written in parts and read back whole."""
    rows = D.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    parts = td.render_all(rows, ["c_custkey", "c_name", "c_mktsegment"], ["c_custkey"], "json", max_rows=400)
    recs = td.each(parts, [], json_records(F.col("payload")), "rec").select("rec")
    return td.record_columns(recs, {"c_custkey": "bigint", "c_name": "string", "c_mktsegment": "string"}, keep=[])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def combine_all_objects(spark, sf):
    """The objects of all items as one JSON text, in parts, and read back whole."""
    items = D.table(spark, sf, "events").select(
        "event_id",
        F.concat(
            F.lit('{"__internal":true,"event_id":'), F.col("event_id").cast("string"), F.lit(","),
            F.substr("props", F.lit(2)),
        ).alias("item"),
    )
    parts = td.combine_objects(items, "item", ["event_id"], "json", max_rows=500)
    recs = td.each(parts, [], json_records(F.col("payload")), "rec")
    return td.record_columns(recs, {"event_id": "bigint", "k": "bigint"}, keep=[])


# -- extraction -------------------------------------------------------------------


@query(f"WITH {D.SQL_LINES} SELECT l_orderkey, CAST(row_no AS INTEGER) AS row_no, line, part, supp, qty, flag, status FROM li")
def extract_records(spark, sf):
    recs = td.records(D.order_pages(spark, sf), "html", PLAIN)
    types = {"line": "int", "part": "bigint", "supp": "bigint", "qty": "bigint", "flag": "string", "status": "string"}
    return td.record_columns(recs, types, keep=["l_orderkey", "row_no"])


@query(
    f"""WITH {D.SQL_LINES},
long AS (
  SELECT l_orderkey, row_no, 1 AS col_no, 'line' AS header, CAST(line AS VARCHAR) AS value FROM li
  UNION ALL SELECT l_orderkey, row_no, 2, 'part', CAST(part AS VARCHAR) FROM li
  UNION ALL SELECT l_orderkey, row_no, 3, 'supp', CAST(supp AS VARCHAR) FROM li
  UNION ALL SELECT l_orderkey, row_no, 4, 'qty', CAST(qty AS VARCHAR) FROM li
  UNION ALL SELECT l_orderkey, row_no, 5, 'flag', flag FROM li
  UNION ALL SELECT l_orderkey, row_no, 6, 'status', status FROM li)
SELECT l_orderkey, 1 AS table_no, CAST(row_no AS INTEGER) AS row_no, col_no, header, value FROM long"""
)
def extract_cells(spark, sf):
    return td.cells(D.order_pages(spark, sf), "html", PLAIN)


@query(
    """WITH r AS (SELECT p_brand, p_partkey, p_name, p_size,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS row_no FROM part)
SELECT p_brand, (row_no - 1) // 30 AS part, CAST((row_no - 1) % 30 + 1 AS INTEGER) AS row_no, CAST(p_partkey AS VARCHAR) AS c1, p_name AS c2,
       CAST(p_size AS VARCHAR) AS c3, 3 AS width FROM r"""
)
def extract_headerless(spark, sf):
    """Tables without a header row: rows come back as arrays of cells."""
    pages = td.render_groups(
        D.table(spark, sf, "part"), ["p_brand"], ["p_partkey", "p_name", "p_size"], ["p_partkey"],
        write=WriteOptions(include_headers=False), output="html", max_rows=30,
    )
    cells = F.col("cells")
    return td.rows(pages, "html", PLAIN).select(
        "p_brand", "part", "row_no", cells[0].alias("c1"), cells[1].alias("c2"), cells[2].alias("c3"),
        F.size(cells).alias("width"),
    )


@query(f"WITH {D.SQL_LINES} SELECT l_orderkey, CAST(row_no AS INTEGER) AS row_no, CAST(line AS VARCHAR) AS c1, 0 AS n_headers FROM li")
def header_rows_left_out(spark, sf):
    """Header-less mode: the header row is left out and no headers are given."""
    options = ExtractOptions(headings=False, include_headers=False)
    return td.rows(D.order_pages(spark, sf), "html", options).select(
        "l_orderkey", "row_no", F.col("cells")[0].alias("c1"), F.size("headers").alias("n_headers")
    )


@query(
    f"""WITH {D.SQL_CUSTOMER_TABLES}
SELECT page_id, table_no, n_tables, 1 AS depth, 'Customers of ' || n_name AS caption,
       '{"|".join(D.CUSTOMER_HEADERS)}' AS headers, CAST(n_rows AS INTEGER) AS n_rows FROM tabs"""
)
def table_inventory(spark, sf):
    t = td.tables(D.customer_pages(spark, sf), "html", PLAIN)
    return t.select(
        "page_id", "table_no", "n_tables", "depth", "caption", F.array_join("headers", "|").alias("headers"), "n_rows"
    )


@query(
    f"""WITH {D.SQL_CUSTOMERS}
SELECT page_id, n_name, c_custkey, c_label FROM cust"""
)
def entity_round_trip(spark, sf):
    """Labels with markup characters survive escaping and reading."""
    recs = td.records(D.customer_pages(spark, sf), "html", PLAIN)
    return recs.select(
        "page_id", F.substr("caption", F.lit(14)).alias("n_name"),
        F.try_element_at("rec", F.lit("c_custkey")).cast("bigint").alias("c_custkey"),
        F.try_element_at("rec", F.lit("c_label")).alias("c_label"),
    )


# -- selection --------------------------------------------------------------------


@query(SQL_TABLE_LIST)
def select_all(spark, sf):
    return table_list(D.customer_pages(spark, sf), chosen(preset="all-tables"))


@query(SQL_TABLE_LIST + " WHERE table_no = 1")
def select_first(spark, sf):
    return table_list(D.customer_pages(spark, sf), chosen(preset="first-table"))


@query(SQL_TABLE_LIST + " WHERE in_region = 1")
def select_first_of_siblings(spark, sf):
    return table_list(D.customer_pages(spark, sf), chosen(preset="first-table", multiple=True))


@query(SQL_TABLE_LIST + " WHERE table_no = n_tables")
def select_last(spark, sf):
    return table_list(D.customer_pages(spark, sf), chosen(preset="last-table"))


@query(
    SQL_TABLE_LIST + """ JOIN (SELECT page_id AS p, min(table_no) AS lo FROM tabs WHERE r_name LIKE '%ASIA%' GROUP BY 1) h
  ON page_id = p WHERE table_no = lo + 1"""
)
def select_under_heading(spark, sf):
    """The second table after the heading, anywhere in the page."""
    return table_list(
        D.customer_pages(spark, sf),
        chosen(preset="table-under-heading", heading_level=1, heading_text=" asia ", table_index=2),
    )


@query(SQL_TABLE_LIST + " WHERE r_name = 'ASIA' AND in_region = 2")
def select_under_heading_in_parent(spark, sf):
    """The second table after the heading, inside the heading's own section."""
    return table_list(
        D.customer_pages(spark, sf),
        chosen(preset="table-under-heading", heading_level=1, heading_text="ASIA", table_index=2, scope="parent"),
    )


@query(SQL_TABLE_LIST + " WHERE n_name LIKE '%NATION_1%' QUALIFY table_no = min(table_no) OVER (PARTITION BY page_id)")
def select_by_caption(spark, sf):
    return table_list(D.customer_pages(spark, sf), chosen(preset="table-with-caption", caption_text="of nation_1"))


@query(SQL_TABLE_LIST + " WHERE n_name LIKE '%NATION_1%'")
def select_by_caption_many(spark, sf):
    return table_list(
        D.customer_pages(spark, sf), chosen(preset="table-with-caption", caption_text="of nation_1", multiple=True)
    )


@query(SQL_TABLE_LIST + " WHERE in_region = of_region OR r_name = 'EUROPE'")
def css_custom_select(spark, sf):
    return table_list(
        D.customer_pages(spark, sf),
        chosen(preset="custom", table_selector="div.region table:last-of-type, #EUROPE > table", multiple=True),
    )


@query(SQL_TABLE_LIST + " WHERE r_name IN ('AFRICA', 'MIDDLE EAST')")
def css_scope_select(spark, sf):
    return table_list(
        D.customer_pages(spark, sf),
        chosen(element_selector="div[id=AFRICA], div[id$='EAST']", table_selector="table", multiple=True),
    )


@query(
    f"""WITH {D.SQL_CUSTOMERS}
SELECT page_id, 'html' AS source, 'tables' AS target, 'selection' AS kind,
       'no table found with a caption containing ''NATION_7''' AS error
FROM cust GROUP BY page_id HAVING count(*) FILTER (WHERE n_name LIKE '%NATION_7%') = 0"""
)
def selection_rejects(spark, sf):
    """Pages without the wanted table, with the reason."""
    selector = TableSelector("table-with-caption", caption_text="NATION_7")
    pages = td.with_tables(D.customer_pages(spark, sf), "html", ExtractOptions(selector=selector, headings=False))
    return td.split_rejects(
        pages, no_match_error(F.col("tables"), selector), "page_id", "html", "tables", "selection"
    )[1]


# -- headings ---------------------------------------------------------------------


@query(
    f"""WITH {D.SQL_CUSTOMER_TABLES}
SELECT page_id, table_no, '1:' || r_name || '/2:' || n_name AS path FROM tabs"""
)
def heading_path_tables(spark, sf):
    t = td.tables(D.customer_pages(spark, sf), "html", ExtractOptions())
    path = F.array_join(F.transform("heading_path", lambda h: F.concat(h["level"], F.lit(":"), h["text"])), "/")
    return t.select("page_id", "table_no", path.alias("path"))


@query(f"WITH {D.SQL_CUSTOMER_TABLES} SELECT page_id, table_no, r_name AS heading FROM tabs")
def nearest_heading(spark, sf):
    options = ExtractOptions(heading_selector="div.region > h1")
    t = td.tables(D.customer_pages(spark, sf), "html", options)
    return t.select("page_id", "table_no", F.col("heading_path")[0]["text"].alias("heading"))


def _sql_record_list(order: str = "c_custkey") -> str:
    return (
        "string_agg('{\"c_custkey\":\"' || c_custkey || '\",\"c_label\":' || CAST(to_json(c_label) AS VARCHAR) || "
        f"',\"c_mktsegment\":\"' || c_mktsegment || '\"}}', ',' ORDER BY {order})"
    )


@query(
    f"""WITH {D.SQL_CUSTOMERS},
leaf AS (
  SELECT page_id, r_name, n_name, '"' || n_name || '":[' || {_sql_record_list()} || ']' AS j, count(*) AS n
  FROM cust GROUP BY page_id, r_name, n_name),
reg AS (
  SELECT page_id, r_name, '"' || replace(r_name, ' ', '_') || '":{{' || string_agg(j, ',' ORDER BY n_name) || '}}' AS j
  FROM leaf GROUP BY page_id, r_name)
SELECT page_id, '{{' || string_agg(j, ',' ORDER BY r_name) || '}}' AS json FROM reg GROUP BY page_id"""
)
def heading_keyed_json(spark, sf):
    pages = td.with_tables(D.customer_pages(spark, sf), "html", ExtractOptions())
    keyed = td.heading_keyed_json(pages, "tables", "json")
    return keyed.select("page_id", "json")


# -- sorting and projection --------------------------------------------------------


def mixed_code():
    return F.when(F.col("line") % 3 == 0, F.concat("flag", "status")).when(
        F.col("line") % 5 == 0, F.lit("")
    ).otherwise(F.col("part").cast("string"))


@query(
    f"""WITH {D.SQL_LINES},
m AS (SELECT l_orderkey, row_no, qty, CASE WHEN line % 3 = 0 THEN flag || status WHEN line % 5 = 0 THEN '' ELSE CAST(part AS VARCHAR) END AS code FROM li)
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY
    CASE WHEN regexp_full_match(code, '[0-9]*') THEN 0 ELSE 1 END,
    CASE WHEN code = '' THEN 0 ELSE TRY_CAST(code AS DOUBLE) END,
    CASE WHEN regexp_full_match(code, '[0-9]*') THEN NULL ELSE lower(code) END, row_no) AS INTEGER) AS position,
  code, CAST(qty AS VARCHAR) AS qty
FROM m"""
)
def sort_mixed_numeric(spark, sf):
    """Ascending sort of a column that mixes numbers, text and blanks."""
    rows = D.lines(spark, sf).withColumn("code", mixed_code())
    pages = td.render_groups(
        rows, ["l_orderkey"], ["code", "qty"], list(D.LINE_HEADERS), output="html"
    ).select("l_orderkey", "html")
    tables = td.with_tables(pages, "html", PLAIN).select("l_orderkey", F.col("tables")[0].alias("t"))
    recs = tables.select(
        "l_orderkey",
        F.transform(F.col("t")["rows"], lambda r: zip_record(F.array(F.lit("code"), F.lit("qty")), r)).alias("recs"),
    )
    ordered = td.each(recs, ["l_orderkey"], td.sort_records("recs", "CODE"), "rec", "position")
    return ordered.select(
        "l_orderkey", "position", F.col("rec")["code"].alias("code"), F.col("rec")["qty"].alias("qty")
    )


@query(
    f"""WITH {D.SQL_LINES},
m AS (SELECT l_orderkey, row_no, line, CASE WHEN flag = 'N' THEN NULL ELSE qty END AS v FROM li)
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY v DESC NULLS LAST, row_no) AS INTEGER) AS position,
  CAST(v AS VARCHAR) AS v, CAST(line AS VARCHAR) AS line FROM m"""
)
def sort_desc_nulls(spark, sf):
    """Descending stable sort of JSON records; nulls come last."""
    rows = D.lines(spark, sf).withColumn("v", F.when(F.col("flag") == "N", None).otherwise(F.col("qty")))
    docs = td.render_groups(rows, ["l_orderkey"], ["v", "line"], list(D.LINE_HEADERS), "json").select("l_orderkey", "payload")
    ordered = td.each(
        docs, ["l_orderkey"], td.sort_records(json_records(F.col("payload")), "V", "descending"), "rec", "position"
    )
    return ordered.select(
        "l_orderkey", "position", F.col("rec")["v"].alias("v"), F.col("rec")["line"].alias("line")
    )


@query(
    """SELECT o_orderkey, o_orderpriority,
  CAST(row_number() OVER (ORDER BY lower(o_orderpriority), o_orderkey) AS BIGINT) AS position FROM orders"""
)
def sort_global_position(spark, sf):
    """Place of every row in a total order, without a single-task window."""
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return td.ordered_position(orders, [*sort_keys(F.col("o_orderpriority")), F.col("o_orderkey")])


@query("SELECT c_mktsegment, c_custkey, c_name FROM customer")
def project_reorder(spark, sf):
    return td.project(D.table(spark, sf, "customer"), "C_MKTSEGMENT, 'c_custkey', \"C_Name\", unknown")


@query(
    f"""WITH {D.SQL_LINES},
s AS (SELECT l_orderkey, flag, CAST(part AS VARCHAR) AS part,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY qty DESC, row_no) AS k FROM li)
SELECT l_orderkey, 'flag,part' || chr(10) || string_agg(flag || ',' || part, chr(10) ORDER BY k) AS output, CAST(NULL AS VARCHAR) AS error
FROM s GROUP BY l_orderkey"""
)
def sort_then_project(spark, sf):
    """CSV to CSV: sorted by a column that is then dropped."""
    docs = D.order_documents(spark, sf, "csv")
    out = td.convert(
        docs, "csv", "csv", shape=ShapeOptions(sort_by="QTY", order="descending", fields="FLAG, part")
    )
    return out.select("l_orderkey", "output", "error")


# -- CSV and JSON payloads ----------------------------------------------------------


@query(f"WITH {D.SQL_LINES} SELECT l_orderkey, CAST(row_no AS INTEGER) AS row_no, line, part, flag FROM li")
def csv_payload_records(spark, sf):
    docs = D.order_documents(spark, sf, "csv")
    recs = td.each(docs, ["l_orderkey"], csv_records(F.col("payload")), "rec", "row_no")
    return td.record_columns(recs, {"line": "int", "part": "bigint", "flag": "string"})


@query(f"WITH {D.SQL_CONVERSATIONS} SELECT conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conv")
def csv_payload_semicolon(spark, sf):
    """Quoted fields with quotes, delimiters and line breaks, and ``;`` between fields."""
    docs = records_to_csv(spark, sf)
    rec = F.col("rec")
    return td.each(docs, ["conv_id"], csv_records(F.col("csv"), ";"), "rec").select(
        "conv_id", rec["turn"].alias("turn"), rec["role"].alias("role"), rec["text"].alias("text")
    )


@query(
    f"""WITH {D.SQL_CUSTOMER_TABLES},
csvs AS (SELECT page_id, r_name, n_name, '# ' || r_name || ' > ' || n_name || chr(10) || 'c_custkey,c_label,c_mktsegment' || chr(13) || chr(10) ||
  string_agg(c_custkey || ',"' || replace(c_label, '"', '""') || '",' || c_mktsegment, chr(13) || chr(10) ORDER BY c_custkey) AS c
  FROM cust GROUP BY page_id, r_name, n_name)
SELECT page_id, string_agg(c, chr(10) || chr(10) ORDER BY r_name, n_name) AS output FROM csvs GROUP BY page_id"""
)
def multi_table_csv(spark, sf):
    return td.convert(D.customer_pages(spark, sf), "html", "csv", "html").select("page_id", "output")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_payload_records(spark, sf):
    recs = td.each(D.table(spark, sf, "events"), ["event_id"], json_records(F.col("props")), "rec")
    return td.record_columns(recs, {"k": "bigint"}, keep=["event_id"])


@query(
    """SELECT event_id, 'type' AS key, event_type AS value FROM events
UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k') FROM events
UNION ALL SELECT event_id, 'who', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'none', 'null' FROM events"""
)
def json_key_value_rows(spark, sf):
    """A single object as key and value rows; the nested object is flattened."""
    docs = D.table(spark, sf, "events").select(
        "event_id",
        F.concat(
            F.lit('{"type":"'), "event_type", F.lit('","detail":'), "props", F.lit(',"who":'),
            F.col("user_id").cast("string"), F.lit(',"none":null}'),
        ).alias("json"),
    )
    return td.each(docs, ["event_id"], key_value_rows(F.col("json")), "kv").select(
        "event_id", F.col("kv")["key"].alias("key"), F.col("kv")["value"].alias("value")
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'objects' WHEN event_id % 4 = 1 THEN 'arrays'
  WHEN event_id % 4 = 2 THEN 'object' ELSE 'scalar' END AS shape,
  CASE WHEN event_id % 4 = 3 THEN 'must be an object or array' END AS error FROM events"""
)
def json_shape_dispatch(spark, sf):
    e = D.table(spark, sf, "events")
    k = F.col("event_id") % 4
    docs = e.select(
        "event_id",
        F.when(k == 0, F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]")))
        .when(k == 1, F.lit('[[1,"a"],[2,"b"]]')).when(k == 2, F.col("props")).otherwise(F.lit("42")).alias("j"),
    )
    return docs.select("event_id", json_shape(F.col("j")).alias("shape"), td.json_error("j").alias("error"))


@query(
    f"""WITH {D.SQL_LINES}
SELECT l_orderkey, CAST(row_no AS INTEGER) AS row_no, CAST(line AS VARCHAR) AS c1, flag AS c2 FROM li"""
)
def json_array_rows(spark, sf):
    """An array of arrays: rows without headers."""
    docs = td.group_text(
        D.lines(spark, sf), ["l_orderkey"], list(D.LINE_HEADERS),
        F.concat(F.lit("["), F.col("line").cast("string"), F.lit(',"'), "flag", F.lit('"]')), separator=",",
    ).select("l_orderkey", F.concat(F.lit("["), "body", F.lit("]")).alias("j"))
    rows = td.each(docs, ["l_orderkey"], json_rows(F.col("j")), "r", "row_no")
    return rows.select("l_orderkey", "row_no", F.col("r")[0].alias("c1"), F.col("r")[1].alias("c2"))


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS value FROM events WHERE event_id % 3 < 2
UNION ALL SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT), CAST(NULL AS VARCHAR) FROM events WHERE event_id % 3 = 1
UNION ALL SELECT event_id, CAST(NULL AS BIGINT), event_type FROM events WHERE event_id % 3 = 2"""
)
def object_item_rows(spark, sf):
    """Items of three kinds: with internal keys, already converted, and plain text."""
    e = D.table(spark, sf, "events")
    k = F.col("event_id") % 3
    items = e.select(
        "event_id",
        F.when(k == 0, F.concat(F.lit('{"__note":"x",'), F.substr("props", F.lit(2))))
        .when(k == 1, F.concat(F.lit('{"a":1,"convertedData":['), "props", F.lit(',7,'), "props", F.lit("]}")))
        .otherwise(F.col("event_type")).alias("item"),
    )
    recs = td.each(items, ["event_id"], object_items(F.col("item")), "rec")
    return td.record_columns(recs, {"k": "bigint", "value": "string"}, keep=["event_id"])


# -- quality ----------------------------------------------------------------------

_SQL_DANGEROUS = "script|iframe|object|form|button|select|textarea|style|noscript|applet|frameset".split("|")


def _sql_sanitize(x: str) -> str:
    for name in _SQL_DANGEROUS:
        x = f"regexp_replace({x}, '(?is)<{name}(?:\\s[^>]*)?>.*?</{name}\\s*>', '', 'g')"
    x = f"regexp_replace({x}, '(?i)</?(?:embed|input|meta|link|frame)(?:\\s[^>]*)?>', '', 'g')"
    x = f"regexp_replace({x}, '(?i)\\sonclick\\s*=\\s*(?:\"[^\"]*\"|''[^'']*''|[^\\s>\"'']+)', '', 'g')"
    return f"regexp_replace({x}, '(?i)\\bhref\\s*=\\s*\"javascript:[^\"]*\"', 'href=\"#\"', 'g')"


_SQL_HOSTILE = """replace(replace(html, '<p>', '<p onclick="go(''x'')">'), 'href="/', 'href="javascript:/')"""


def hostile_pages(spark, sf):
    """The given pages with event handlers and script links added."""
    return D.table(spark, sf, "pages").select(
        "page_id",
        F.replace(
            F.replace("html", F.lit("<p>"), F.lit("<p onclick=\"go('x')\">")),
            F.lit('href="/'), F.lit('href="javascript:/'),
        ).alias("html"),
    )


@query(f"SELECT page_id, {_sql_sanitize(_SQL_HOSTILE)} AS html FROM pages")
def sanitize_pages(spark, sf):
    return hostile_pages(spark, sf).select("page_id", td.sanitize_html("html").alias("html"))


@query(
    """WITH t AS (
  SELECT page_id, unnest(regexp_extract_all(html, '</?[a-zA-Z][^>]*>')) AS tag,
         generate_subscripts(regexp_extract_all(html, '</?[a-zA-Z][^>]*>'), 1) AS i FROM pages),
s AS (SELECT page_id, i, sum(CASE WHEN tag LIKE '</%' THEN -1 WHEN tag LIKE '%/>' THEN 0 ELSE 1 END)
       OVER (PARTITION BY page_id ORDER BY i) AS run FROM t
  WHERE NOT regexp_matches(tag, '(?i)^</?(area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr|p|li|dt|dd|tr|td|th|thead|tbody|tfoot|colgroup|option|optgroup|rt|rp)[\\s/>]')),
d AS (SELECT page_id, run - least(0, min(run) OVER (PARTITION BY page_id ORDER BY i)) AS depth FROM s)
SELECT page_id, CAST(max(depth) AS INTEGER) AS depth FROM d GROUP BY page_id"""
)
def html_depth_of_pages(spark, sf):
    return D.table(spark, sf, "pages").select("page_id", td.html_depth("html").alias("depth"))


@query(
    """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'must be a non-empty string' WHEN page_id % 5 = 1 THEN 'empty or blank'
  WHEN page_id % 5 = 2 THEN 'no table elements found' WHEN page_id % 5 = 3 THEN 'excessively nested' END AS error FROM pages"""
)
def html_guard(spark, sf):
    """Empty, blank, table-less, too deep and good payloads."""
    k = F.col("page_id") % 5
    pages = D.table(spark, sf, "pages").select(
        "page_id",
        F.when(k == 0, F.lit("")).when(k == 1, F.lit(" \n\u00a0 ")).when(k == 2, F.col("html"))
        .when(k == 3, F.concat(F.repeat(F.lit("<div>"), F.lit(101)), "html", F.lit("<table></table>")))
        .otherwise(F.concat("html", F.lit("<table></table>"))).alias("html"),
    )
    return pages.select("page_id", td.html_error("html", MAX_HTML_BYTES, max_depth=MAX_DEPTH).alias("error"))


@query(
    f"""WITH {D.SQL_LINES}, n AS (SELECT l_orderkey, max(row_no) AS n FROM li GROUP BY 1)
SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 1 THEN 'row ' || (n + 2) || ' has 1 columns, expected 6'
  WHEN l_orderkey % 3 = 2 THEN 'malformed quotes' END AS error FROM n"""
)
def csv_validate(spark, sf):
    docs = D.order_documents(spark, sf, "csv")
    k = F.col("l_orderkey") % 3
    broken = docs.select(
        "l_orderkey",
        F.concat("payload", F.when(k == 1, "\nshort").when(k == 2, '\n"open').otherwise("\n")).alias("payload"),
    )
    return broken.select("l_orderkey", td.csv_error("payload").alias("error"))


@query(
    """SELECT event_id, CASE WHEN event_id % 6 = 1 THEN 'malformed structure' WHEN event_id % 6 = 2 THEN 'item at index 1 has different keys'
  WHEN event_id % 6 = 3 THEN 'row 2 has 1 columns, expected 2' WHEN event_id % 6 = 4 THEN 'contains functions'
  WHEN event_id % 6 = 5 THEN 'too deeply nested' END AS error FROM events"""
)
def json_validate(spark, sf):
    k = F.col("event_id") % 6
    docs = D.table(spark, sf, "events").select(
        "event_id",
        F.when(k == 1, F.concat("props", F.lit("]")))
        .when(k == 2, F.concat(F.lit("["), "props", F.lit(',{"other":1}]')))
        .when(k == 3, F.lit("[[1,2],[3]]"))
        .when(k == 4, F.lit('{"f":"function (a) {}"}'))
        .when(k == 5, F.concat(F.repeat(F.lit("["), F.lit(101)), F.repeat(F.lit("]"), F.lit(101))))
        .otherwise(F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]"))).alias("j"),
    )
    return docs.select(
        "event_id", F.coalesce(td.json_safety_error("j", MAX_JSON_BYTES, MAX_DEPTH), td.json_error("j")).alias("error")
    )


@query(
    """SELECT page_id, 'html' AS source, 'json' AS target, 'validation' AS kind, 'no table elements found' AS error
FROM pages WHERE page_id % 2 = 0"""
)
def rejects(spark, sf):
    """Pages that cannot be read are set aside with the reason."""
    pages = D.table(spark, sf, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise(F.concat("html", F.lit("<table></table>"))).alias("html"),
    )
    return td.split_rejects(pages, td.html_error("html"), "page_id", "html", "json")[1]


@query(
    f"""WITH {D.SQL_CONVERSATIONS},
j AS (SELECT conv_id, sum(strlen('{{"turn":' || turn || ',"role":' || CAST(to_json(role) AS VARCHAR) || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}}') + 1) + 1 AS b
  FROM conv GROUP BY conv_id)
SELECT conv_id, CASE WHEN b > 1500 THEN 'output too large: ' || CAST(b AS BIGINT) || ' bytes exceeds 1500' END AS error FROM j"""
)
def output_size_guard(spark, sf):
    docs = td.render_groups(
        D.conversations(spark, sf), ["conv_id"], ["turn", "role", "text"], ["turn", "role", "text"], "json", output="json"
    )
    return docs.select("conv_id", td.output_size_error("json", 1500).alias("error"))


# -- whole pages --------------------------------------------------------------------


@query("SELECT page_id, trim(regexp_replace(html, '>\\s+<', '><', 'g')) AS html FROM pages")
def minify_pages(spark, sf):
    return D.table(spark, sf, "pages").select("page_id", render.minify(F.col("html")).alias("html"))


@query("SELECT page_id, true AS same, CAST(length(html) AS BIGINT) AS n FROM pages")
def lossless_units_of_pages(spark, sf):
    """Cutting a page into units and joining them again changes nothing."""
    units = lossless_units(F.col("html"), "/?(?:p|a|li|h1)|article|footer")
    pages = D.table(spark, sf, "pages").select("page_id", "html", F.array_join(units, "").alias("joined"))
    return pages.select(
        "page_id", (F.col("html") == F.col("joined")).alias("same"), F.length("joined").cast("bigint").alias("n")
    )


@query(
    """SELECT page_id, trim(replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')) AS h1 FROM pages"""
)
def page_headings(spark, sf):
    """The heading above a table that is appended to each given page."""
    pages = D.table(spark, sf, "pages").select(
        "page_id", F.concat("html", F.lit("<table><tr><td>x</td></tr></table>")).alias("html")
    )
    t = td.tables(pages, "html", ExtractOptions())
    return t.select("page_id", F.element_at("heading_path", -1)["text"].alias("h1"))


@query(
    """SELECT page_id, replace(replace(replace(regexp_extract(html, '<footer>(.*?)</footer>', 1),
  '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&') AS footer FROM pages"""
)
def decode_page_entities(spark, sf):
    footer = F.regexp_extract("html", "<footer>(.*?)</footer>", 1)
    return D.table(spark, sf, "pages").select("page_id", decode_entities(footer).alias("footer"))


@query("""SELECT doc_id, replace(replace(replace(replace(replace(text,'&','&amp;'),'<','&lt;'),'>','&gt;'),'"','&quot;'),'''','&#39;') AS escaped FROM documents""")
def escape_documents(spark, sf):
    return D.table(spark, sf, "documents").select("doc_id", escape_html(F.col("text")).alias("escaped"))


@query(
    f"""WITH {D.SQL_LINES}
SELECT l_orderkey, CAST(row_no AS INTEGER) AS row_no,
  '**' || line || '** *' || flag || '*' AS a, '[part ' || part || '](/p/' || part || ')' || chr(10) || '~~' || qty || '~~' AS b,
  '- ' || flag || chr(10) || '- ' || status || chr(10) || '1. ' || line || chr(10) || '2. ' || supp AS c FROM li"""
)
def markdown_cells(spark, sf):
    """Cells with inline markup, links and lists, read as Markdown."""
    n = lambda c: F.col(c).cast("string")
    line = F.concat(
        F.lit("<tr><td> <b>"), n("line"), F.lit("</b> <em>"), "flag", F.lit("</em></td><td><a class='x' href=\"/p/"), n("part"),
        F.lit('">part '), n("part"), F.lit("</a><br/><del>"), n("qty"), F.lit("</del></td><td><ul><li> "), "flag",
        F.lit("</li> <li>"), "status", F.lit("</li></ul><ol><li>"), n("line"), F.lit("</li><li><span>"), n("supp"),
        F.lit("</span></li></ol></td></tr>"),
    )
    pages = td.group_text(D.lines(spark, sf), ["l_orderkey"], list(D.LINE_HEADERS), line, first_row="first_row").select(
        "l_orderkey", "first_row", F.concat(F.lit("<table>"), "body", F.lit("</table>")).alias("html")
    )
    options = ExtractOptions(headings=False, cell_format="markdown")
    c = F.col("cells")
    return td.rows(pages, "html", options).select(
        "l_orderkey", (F.col("first_row") + F.col("row_no") - 1).cast("int").alias("row_no"), c[0].alias("a"), c[1].alias("b"), c[2].alias("c")
    )


# -- replace and style ------------------------------------------------------------------


@query(
    f"""WITH {D.SQL_CUSTOMER_SECTIONS}, target AS (
  SELECT page_id AS p, min(table_no) AS k FROM tabs WHERE r_name LIKE '%ASIA%' GROUP BY page_id)
SELECT page_id, string_agg(opening || heading || CASE WHEN table_no = k THEN '<p>gone</p>' ELSE tab END || closing, '' ORDER BY table_no) AS html,
  CASE WHEN min(k) IS NULL THEN 'no table 1 found under an h1 heading containing ''ASIA''; check the level, the text and the table number' END AS error
FROM sections LEFT JOIN target ON page_id = p GROUP BY page_id"""
)
def replace_under_heading(spark, sf):
    selector = TableSelector("table-under-heading", heading_level=1, heading_text="ASIA")
    return td.replace_table(D.customer_pages(spark, sf), F.lit("<p>gone</p>"), selector=selector)


@query(
    f"""WITH {D.SQL_CUSTOMER_SECTIONS}, fresh AS (
  SELECT page_id AS p, '<table><thead><tr><th>segment</th><th>n</th></tr></thead><tbody>' ||
    string_agg('<tr><td>' || c_mktsegment || '</td><td>' || n || '</td></tr>', '' ORDER BY c_mktsegment) || '</tbody></table>' AS t
  FROM (SELECT page_id, c_mktsegment, count(*) AS n FROM cust GROUP BY ALL) GROUP BY page_id)
SELECT page_id, string_agg(opening || heading || CASE WHEN table_no = n_tables AND page_id % 10 <> 0 THEN t ELSE tab END || closing, '' ORDER BY table_no) AS html
FROM sections JOIN fresh ON page_id = p GROUP BY page_id"""
)
def replace_from_records(spark, sf):
    """The last table of each page replaced by a table built from data; one page in ten has none and stays."""
    fresh = D.customers(spark, sf).filter("page_id % 10 <> 0").groupBy(
        "page_id", F.col("c_mktsegment").alias("segment")
    ).agg(F.count(F.lit(1)).alias("n"))
    tables = td.render_groups(fresh, ["page_id"], ["segment", "n"], ["segment"])
    out = td.replace_from(
        D.customer_pages(spark, sf), tables, "page_id", "payload", selector=TableSelector("last-table")
    )
    return out.select("page_id", "html")


@query(
    f"""WITH {D.SQL_CUSTOMER_SECTIONS}, fresh AS (
  SELECT page_id AS p, '<table style="width: 100%;"><thead><tr><th style="text-align: center;">n</th><th style="text-align: center;">segment</th></tr></thead><tbody>' ||
    string_agg(CASE WHEN k % 2 = 1 THEN '<tr style="background-color: #f9f9f9;">' ELSE '<tr>' END ||
      '<td style="text-align: right;">' || n || '</td><td>' || c_mktsegment || '</td></tr>', '' ORDER BY k) || '</tbody></table>' AS t
  FROM (SELECT page_id, c_mktsegment, count(*) AS n, row_number() OVER (PARTITION BY page_id ORDER BY count(*) DESC, c_mktsegment) AS k
        FROM cust GROUP BY page_id, c_mktsegment) GROUP BY page_id)
SELECT page_id, string_agg(opening || heading || CASE WHEN table_no = 1 THEN t ELSE tab END || closing, '' ORDER BY table_no) AS html
FROM sections JOIN fresh ON page_id = p GROUP BY page_id"""
)
def replace_from_json(spark, sf):
    """A JSON payload, sorted and projected, rendered and styled before it is inserted."""
    fresh = D.customers(spark, sf).groupBy("page_id", F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n"), F.lit("x").alias("unused")
    )
    payloads = td.render_groups(fresh, ["page_id"], ["segment", "unused", "n"], ["segment"], "json")
    tables = td.replacement_tables(
        payloads, "json", shape=ShapeOptions(sort_by="n", order="descending", fields="N, segment"),
        style=StyleOptions(table_width="full", header_text_align="center", numeric_alignment="right", banded_rows="on"),
    )
    out = td.replace_from(D.customer_pages(spark, sf), tables, "page_id", "content")
    return out.select("page_id", "html")


def _sql_styled(row: str, cell=lambda expr, text: f"'<td>' || {text} || '</td>'", head: str = "<th>{h}</th>", opening: str = "<table>") -> str:
    cells = " || ".join(cell(c, f"CAST({c} AS VARCHAR)") for c in D.LINE_HEADERS)
    headers = "".join(head.format(h=h) for h in D.LINE_HEADERS)
    return (
        f"WITH {D.SQL_LINES} SELECT l_orderkey, '<html><body><h1>Order ' || l_orderkey || '</h1>' || chr(10) || "
        f"'{opening}<thead>{row.split('|')[0]}{headers}</tr></thead><tbody>' || "
        f"string_agg({row.split('|')[1]} || {cells} || '</tr>', '' ORDER BY row_no) || '</tbody></table></body></html>' AS html "
        "FROM li GROUP BY l_orderkey"
    )


@query(
    _sql_styled(
        "<tr>|CASE WHEN row_no % 2 = 1 THEN '<tr style=\"background-color: #eee;\">' ELSE '<tr style=\"background-color: #ddd;\">' END",
        opening='<table class="styled">',
    )
)
def style_zebra(spark, sf):
    options = StyleOptions(table_class="styled", zebra=True, even_row_color="#eee", odd_row_color="#ddd")
    return td.style_tables(D.order_pages(spark, sf), options)


@query(
    _sql_styled(
        "<tr style=\"height: 1em; text-align: left;\">|'<tr style=\"height: 1em; text-align: left;\">'",
        cell=lambda c, t: "'<td style=\"padding: 2px;\">' || " + t + " || '</td>'",
        head='<th style="white-space: nowrap; padding: 2px;">{h}</th>',
        opening='<table style="width: 100%; border-style: solid; border-color: red; border-width: 2px; border-collapse: collapse; text-align: center;" border="2">',
    )
)
def style_border(spark, sf):
    options = StyleOptions(
        table_style="width: 5px", table_width="full", border_style="solid", border_color="red", border_width=2,
        border_collapse="collapse", table_text_align="center", row_style="height:1em", row_text_align="left",
        cell_style="padding:2px", header_wrap="nowrap",
    )
    return td.style_tables(D.order_pages(spark, sf), options)


@query(
    _sql_styled(
        "<tr>|CASE WHEN row_no % 2 = 1 THEN '<tr style=\"background-color: #f9f9f9;\">' ELSE '<tr>' END",
        cell=lambda c, t: (f"'<td style=\"text-align: right;\">' || {t} || '</td>'" if c in ("line", "part", "supp", "qty")
                           else f"'<td>' || {t} || '</td>'"),
    )
)
def style_numeric_align(spark, sf):
    options = StyleOptions(numeric_alignment="right", banded_rows="on")
    return td.style_tables(D.order_pages(spark, sf), options)


@query(
    f"""WITH {D.SQL_CUSTOMER_SECTIONS}
SELECT page_id, string_agg(opening || heading || chr(10) || replace(tab, '<caption>', '<caption style="font-weight: bold; caption-side: bottom;">') || closing, '' ORDER BY table_no) AS html
FROM sections GROUP BY page_id"""
)
def style_caption(spark, sf):
    options = StyleOptions(caption_style="font-weight:bold", caption_position="bottom")
    return td.style_tables(D.customer_pages(spark, sf), options)


# -- nested tables --------------------------------------------------------------------


@query(
    f"""WITH {D.SQL_NESTED}
SELECT page_id, 1 AS table_no, 1 AS depth, 'region|nations' AS headers, r_name || '|' AS cells FROM inn WHERE k = 1
UNION ALL SELECT page_id, CAST(r + 1 AS INTEGER), 2, 'nation|n', n_name || '|' || n FROM inn"""
)
def nested_innermost(spark, sf):
    """An inner table owns its rows; the outer cell does not repeat them."""
    t = td.each(td.with_tables(D.nested_pages(spark, sf), "html", PLAIN), ["page_id"], "tables", "t")
    fields = [F.col("t.table_no").alias("table_no"), F.col("t.depth").alias("depth"), F.array_join("t.headers", "|").alias("headers")]
    return td.each(t, ["page_id", *fields], "t.rows", "r").select(
        "page_id", "table_no", "depth", "headers", F.array_join("r", "|").alias("cells")
    )


@query(
    f"""WITH {D.SQL_NESTED},
inner_text AS (SELECT page_id, r_name, any_value(r) AS r, 'nationn' || string_agg(n_name || n, '' ORDER BY n_name) AS txt,
   '|nation|n' || string_agg('|' || n_name || '|' || n, '' ORDER BY n_name) AS cells FROM inn GROUP BY page_id, r_name)
SELECT page_id, 1 AS table_no, r_name || '|' || txt || cells AS cells FROM inner_text
UNION ALL SELECT page_id, 1, 'nation|n' FROM inner_text
UNION ALL SELECT page_id, 1, n_name || '|' || n FROM inn
UNION ALL SELECT page_id, CAST(r + 1 AS INTEGER), n_name || '|' || n FROM inn"""
)
def nested_all(spark, sf):
    """Descendant-wide reading: the outer table repeats what is inside it."""
    options = ExtractOptions(headings=False, include_nested=True)
    return td.rows(D.nested_pages(spark, sf), "html", options).select(
        "page_id", "table_no", F.array_join("cells", "|").alias("cells")
    )


# -- conversion matrix ----------------------------------------------------------------

_SQL_MATRIX = f"""WITH {D.SQL_LINES},
g AS (SELECT l_orderkey,
  '<table><thead><tr><th>line</th><th>flag</th></tr></thead><tbody>' || string_agg('<tr><td>' || line || '</td><td>' || flag || '</td></tr>', '' ORDER BY row_no) || '</tbody></table>' AS html,
  'line,flag' || chr(10) || string_agg(line || ',' || flag, chr(10) ORDER BY row_no) AS csv,
  'line,flag' || chr(13) || chr(10) || string_agg(line || ',' || flag, chr(13) || chr(10) ORDER BY row_no) AS csv_crlf,
  '[' || string_agg('{{"line":"' || line || '","flag":"' || flag || '"}}', ',' ORDER BY row_no) || ']' AS json_text,
  '[' || string_agg('{{"flag":"' || flag || '","line":"' || line || '"}}', ',' ORDER BY row_no) || ']' AS json_text_sorted,
  '[' || string_agg('{{"line":' || line || ',"flag":"' || flag || '"}}', ',' ORDER BY row_no) || ']' AS json,
  '[' || string_agg('{{"flag":"' || flag || '","line":' || line || '}}', ',' ORDER BY row_no) || ']' AS json_sorted
  FROM li GROUP BY l_orderkey)
SELECT l_orderkey, @column AS output FROM g"""

# Column of the SQL above that a conversion from one format to another gives.
MATRIX = {
    ("html", "html"): "html", ("html", "csv"): "csv_crlf", ("html", "json"): "json_text", ("html", "objects"): "json_text_sorted",
    ("csv", "html"): "html", ("csv", "csv"): "csv", ("csv", "json"): "json_text", ("csv", "objects"): "json_text_sorted",
    ("json", "html"): "html", ("json", "csv"): "csv", ("json", "json"): "json", ("json", "objects"): "json_sorted",
    ("objects", "html"): "html", ("objects", "csv"): "csv_crlf", ("objects", "json"): "json", ("objects", "objects"): "json_sorted",
}


def _matrix_query(source: str, target: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        form = "json" if source == "objects" else source
        docs = td.render_groups(
            D.lines(spark, sf), ["l_orderkey"], ["line", "flag"], list(D.LINE_HEADERS), form
        ).select("l_orderkey", "payload")
        out = td.convert(docs, source, target)
        text = F.to_json("output") if target == "objects" else F.col("output")
        return out.select("l_orderkey", text.alias("output"))

    run.__name__ = f"convert_{source}_to_{target}"
    return run


for (_source, _target), _column in MATRIX.items():
    query(_SQL_MATRIX.replace("@column", _column))(_matrix_query(_source, _target))


@query(
    f"""WITH {D.SQL_CUSTOMERS}, t AS (
  SELECT page_id, r_name, n_name, '{{"data":[' || {_sql_record_list()} || '],"caption":"Customers of ' || n_name || '"}}' AS j
  FROM cust GROUP BY page_id, r_name, n_name)
SELECT page_id, '[' || string_agg(j, ',' ORDER BY r_name, n_name) || ']' AS output FROM t GROUP BY page_id"""
)
def html_to_json_many(spark, sf):
    out = td.convert(D.customer_pages(spark, sf), "html", "json", "html", extract=PLAIN)
    return out.select("page_id", "output")


@query(
    f"""WITH {D.SQL_CUSTOMERS}, t AS (
  SELECT page_id, r_name, n_name, '{{"caption":"Customers of ' || n_name || '","data":[' || {_sql_record_list()} || ']}}' AS j
  FROM cust GROUP BY page_id, r_name, n_name)
SELECT page_id, j AS output FROM t QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY r_name, n_name) = 1"""
)
def html_to_json_captioned(spark, sf):
    out = td.convert(D.customer_pages(spark, sf), "html", "json", "html", extract=chosen(preset="first-table"))
    return out.select("page_id", "output")


@query(
    f"""WITH {D.SQL_LINES}
SELECT l_orderkey, (row_no - 1) // 20000 AS part, '[' || chr(10) || string_agg('  {{' || chr(10) || '    "line": ' || line || ',' || chr(10) || '    "flag": "' || flag || '"' || chr(10) || '  }}', ',' || chr(10) ORDER BY row_no) || chr(10) || ']' AS output
FROM li GROUP BY l_orderkey, (row_no - 1) // 20000"""
)
def pretty_json_output(spark, sf):
    docs = td.render_groups(D.lines(spark, sf), ["l_orderkey"], ["line", "flag"], list(D.LINE_HEADERS), "json")
    out = td.convert(docs, "json", "json", write=WriteOptions(pretty=True))
    return out.select("l_orderkey", "part", "output")


@query(
    """SELECT event_id, '<table><thead><tr><th>Key</th><th>Value</th></tr></thead><tbody><tr><td>type</td><td>' || event_type ||
  '</td></tr><tr><td>k</td><td>' || json_extract_string(props, '$.k') || '</td></tr></tbody></table>' AS html,
  'Key,Value' || chr(10) || 'type,' || event_type || chr(10) || 'detail,"{""k"":' || json_extract_string(props, '$.k') || '}"' AS csv FROM events"""
)
def key_value_outputs(spark, sf):
    """A single object as a key and value table, in HTML and in CSV."""
    docs = D.table(spark, sf, "events").select(
        "event_id", F.concat(F.lit('{"type":"'), "event_type", F.lit('","detail":'), "props", F.lit("}")).alias("payload")
    )
    html = td.convert(docs, "json", "html", output="html").drop("error")
    return td.convert(html, "json", "csv", output="csv").select("event_id", "html", "csv")


@query(
    f"""WITH {D.SQL_LINES}
SELECT l_orderkey, (row_no - 1) // 20000 AS part, CAST((row_no - 1) % 20000 AS INTEGER) AS item_no, CAST(line AS VARCHAR) AS line, flag FROM li"""
)
def wrap_output(spark, sf):
    """Unwrapped object output: every object becomes a row of its own."""
    docs = td.render_groups(D.lines(spark, sf), ["l_orderkey"], ["line", "flag"], list(D.LINE_HEADERS), "html")
    out = td.convert(docs, "html", "objects").select("l_orderkey", "part", "output")
    items = td.wrap_output(out, wrap=False)
    return items.select(
        "l_orderkey", "part", (F.col("item_no") - 1).alias("item_no"), F.try_variant_get("item", "$.line", "string").alias("line"),
        F.try_variant_get("item", "$.flag", "string").alias("flag"),
    )


@query(
    f"""WITH {D.SQL_LINES}, big AS (SELECT * FROM li WHERE qty > 45),
h AS (SELECT l_orderkey AS k, '<table><thead><tr><th>line</th></tr></thead><tbody>' || string_agg('<tr><td>' || line || '</td></tr>', '' ORDER BY row_no) || '</tbody></table>' AS t FROM big GROUP BY 1)
SELECT o_orderkey, coalesce(t, '<table></table>') AS output FROM orders LEFT JOIN h ON o_orderkey = k"""
)
def empty_result(spark, sf):
    """Every order has an output; orders without matching lines have the empty one."""
    big = D.lines(spark, sf).filter("qty > 45")
    docs = td.render_groups(big, ["l_orderkey"], ["line"], list(D.LINE_HEADERS), output="output").select(
        F.col("l_orderkey").alias("o_orderkey"), "output"
    )
    return td.fill_empty(docs, D.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "html")


# -- streaming ------------------------------------------------------------------------


@query(
    """SELECT page_id, 1 AS table_no, 1 AS row_no, CAST(page_id AS VARCHAR) AS id FROM pages"""
)
def stream_extract(spark, sf):
    """Pages that arrive as files, read as a stream and written as records."""
    base = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    documents = stream_documents(spark, sf, "page_id bigint, url string, html string", entries="pages.parquet")
    with_table = documents.select(
        "page_id",
        F.concat("html", F.lit("<table><tr><th>id</th></tr><tr><td>"), F.col("page_id").cast("string"), F.lit("</td></tr></table>")).alias("html"),
    )
    records = stream_tables(with_table, "html", PLAIN).select(
        "page_id", "table_no", "row_no", F.try_element_at("rec", F.lit("id")).alias("id")
    )
    write_stream(records, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.schema(records.schema).parquet(f"{base}/out")


# -- whole pages, repeated keys and other payloads that used to be lost ----------------


@query("SELECT page_id, i AS row_no, rtrim('x' || i || ' ' || repeat('y', CAST(page_id % 7 AS INTEGER))) AS first FROM pages, range(1, 4) t(i)")
def many_breaks(spark, sf):
    """Every page with a table whose cells hold over a hundred line breaks or unclosed items: all rows come back."""
    filler = F.when(F.col("page_id") % 2 == 0, F.repeat(F.lit("<br>"), F.lit(150))).otherwise(F.repeat(F.lit("<li>"), F.lit(150)))
    body = F.concat(*[
        F.concat(F.lit(f"<tr><td>x{i} "), F.repeat(F.lit("y"), (F.col("page_id") % 7).cast("int")), F.lit("</td><td>"), filler, F.lit("</td></tr>"))
        for i in (1, 2, 3)
    ])
    pages = D.table(spark, sf, "pages").select("page_id", F.concat(F.lit("<table><tbody>"), body, F.lit("</tbody></table>"), "html").alias("html"))
    rows = td.rows(pages, "html", ExtractOptions(selector=TableSelector("first-table")))
    return rows.select("page_id", "row_no", F.col("cells")[0].alias("first"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(event_id % 9 AS BIGINT) AS m, 'k,m' AS names FROM events""")
def json_repeated_keys(spark, sf):
    """A key that an object repeats has its last value, at its first place."""
    payload = F.concat(
        F.lit('[{"k":"old","m":'), (F.col("event_id") % 9).cast("string"), F.lit(","), F.substr("props", F.lit(2)), F.lit("]")
    )
    events = D.table(spark, sf, "events").select("event_id", payload.alias("payload"))
    csv = td.convert(events, "json", "csv", "payload")
    recs = td.each(events.select("event_id", json_records(F.col("payload")).alias("r")), ["event_id"], F.col("r"), "rec")
    both = recs.join(csv.select("event_id", F.split("output", "\n")[0].alias("head")), "event_id")
    return both.select(
        "event_id", F.col("rec")["k"].cast("bigint").alias("k"), F.col("rec")["m"].cast("bigint").alias("m"),
        F.regexp_replace("head", '"', "").alias("names"),
    )


@query("SELECT page_id, '\u00a9 2020 AT&T \u00e9t\u00e9 <b ' || url AS cell FROM pages")
def entities_without_semicolon(spark, sf):
    cell = F.concat(F.lit("&copy 2020 AT&T &eacutet&#233 &ltb "), F.replace("url", F.lit("&"), F.lit("&amp;")))
    pages = D.table(spark, sf, "pages").select("page_id", F.concat(F.lit("<table><tr><td>"), cell, F.lit("</td></tr></table>")).alias("html"))
    return td.cells(pages, "html").select("page_id", F.col("value").alias("cell"))


@query(
    """SELECT page_id, html AS kept, CASE WHEN page_id % 3 = 0 THEN '2 replacements for one page' END AS error FROM (
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '<table><tr><td>old</td></tr></table>' ELSE '<p>new ' || page_id || '</p>' END AS html FROM pages)"""
)
def replace_repeated_keys(spark, sf):
    """Two replacements for one page: the page stays, with an error; still one row for each page."""
    ids = D.table(spark, sf, "pages").select("page_id")
    pages = ids.withColumn("html", F.lit("<table><tr><td>old</td></tr></table>"))
    fresh = ids.withColumn("n", F.explode(F.when(F.col("page_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    fresh = fresh.select("page_id", F.concat(F.lit("<p>new "), F.col("page_id").cast("string"), F.lit("</p>")).alias("payload"))
    out = td.replace_from(pages, fresh, "page_id", "payload")
    return out.select("page_id", F.col("html").alias("kept"), "error")


@query("SELECT count(*) AS n_rows, count(DISTINCT page_id) AS n_pages, CAST(sum(strlen(html)) AS BIGINT) AS bytes FROM pages")
def wide_group_round_trip(spark, sf):
    """All pages as escaped cells of a few documents of many megabytes, and every row read back."""
    pages = D.table(spark, sf, "pages").select("page_id", "html", F.lit(1).alias("g"))
    docs = td.render_groups(pages, ["g"], ["page_id", "html"], ["page_id"], max_bytes=1 << 20)
    rows = td.rows(docs, "payload", ExtractOptions(selector=TableSelector("first-table"), sanitize=False))
    cells = rows.select(F.col("cells")[0].cast("bigint").alias("page_id"), F.col("cells")[1].alias("html"))
    return cells.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("page_id").alias("n_pages"), F.sum(F.octet_length("html")).cast("bigint").alias("bytes")
    )


from workload import assembly_queries, file_queries, selector_queries, stream_queries  # noqa: E402, F401
