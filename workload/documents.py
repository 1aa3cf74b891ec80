"""Documents built from the given tables, as DataFrames and as SQL.

Groups may be of any size: a page whose group is too large for one text becomes
several pages (see ``group_text``), so no step depends on even keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabledocs import group_text, render_groups
from tabledocs.functions.render import html_caption, html_head, html_row
from tabledocs.functions.text import escape_text

PAGE_SIZE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def heads(*names: str) -> Column:
    return html_head(F.array(*[F.lit(n) for n in names]))


# -- pages of customers: regions, nations under them, one table per nation ---------

CUSTOMER_HEADERS = ("c_custkey", "c_label", "c_mktsegment")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.floor(F.col("c_custkey") / PAGE_SIZE).cast("bigint").alias("page_id"),
            "r_name", "n_name", "c_custkey",
            F.concat("c_name", F.lit(' <"'), "c_mktsegment", F.lit('"> & Co')).alias("c_label"),
            "c_mktsegment",
        )
    )


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, html``: one page per 50 customer keys."""
    keys = ["page_id", "r_name", "n_name"]
    line = F.concat(
        F.lit("<tr><td>"), F.col("c_custkey").cast("string"), F.lit("</td><td>"), escape_text(F.col("c_label")),
        F.lit("</td><td>"), "c_mktsegment", F.lit("</td></tr>"),
    )
    sections = group_text(customers(spark, sf_dir), keys, ["c_custkey"], line)
    # a page holds at most one section per nation, or one part of a large one
    region = Window.partitionBy("page_id", "part", "r_name").orderBy("n_name")
    marked = sections.select(
        *keys, "part",
        F.lag("n_name").over(region).isNull().alias("first"),
        F.lead("n_name").over(region).isNull().alias("last"),
        F.concat(
            F.lit("<h2>"), "n_name", F.lit("</h2>\n<table>"),
            html_caption(F.concat(F.lit("Customers of "), F.col("n_name"))),
            heads(*CUSTOMER_HEADERS), F.lit("<tbody>"), "body", F.lit("</tbody></table>"),
        ).alias("section"),
    )
    opening = F.when(
        F.col("first"),
        F.concat(F.lit('<div class="region" id="'), "r_name", F.lit('"><h1>'), "r_name", F.lit("</h1>")),
    ).otherwise("")
    text = F.concat(opening, "section", F.when(F.col("last"), "</div>").otherwise(""))
    pages = group_text(
        marked.withColumnRenamed("part", "section_part"), ["page_id", "section_part"], ["r_name", "n_name"], text,
    )
    return pages.select("page_id", F.col("body").alias("html"))


SQL_ESCAPE = "replace(replace(replace(replace({x},'&','&amp;'),chr(160),'&nbsp;'),'<','&lt;'),'>','&gt;')"


def sql_escape(x: str) -> str:
    return SQL_ESCAPE.format(x=x)


SQL_CUSTOMERS = f"""
cust AS (
  SELECT c_custkey // {PAGE_SIZE} AS page_id, r_name, n_name, c_custkey,
         c_name || ' <"' || c_mktsegment || '"> & Co' AS c_label, c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

SQL_CUSTOMER_TABLES = SQL_CUSTOMERS + """,
tabs AS (
  SELECT page_id, r_name, n_name, count(*) AS n_rows,
         CAST(row_number() OVER (PARTITION BY page_id ORDER BY r_name, n_name) AS INTEGER) AS table_no,
         CAST(count(*) OVER (PARTITION BY page_id) AS INTEGER) AS n_tables,
         row_number() OVER (PARTITION BY page_id, r_name ORDER BY n_name) AS in_region,
         count(*) OVER (PARTITION BY page_id, r_name) AS of_region
  FROM cust GROUP BY page_id, r_name, n_name
)"""

SQL_CUSTOMER_LINE = (
    "'<tr><td>' || c_custkey || '</td><td>' || " + sql_escape("c_label") + " || '</td><td>' || c_mktsegment || '</td></tr>'"
)
SQL_CUSTOMER_HEAD = "<thead><tr>" + "".join(f"<th>{h}</th>" for h in CUSTOMER_HEADERS) + "</tr></thead>"

SQL_CUSTOMER_SECTIONS = SQL_CUSTOMER_TABLES + f""",
bodies AS (
  SELECT page_id, r_name, n_name, string_agg({SQL_CUSTOMER_LINE}, '' ORDER BY c_custkey) AS body
  FROM cust GROUP BY page_id, r_name, n_name
),
sections AS (
  SELECT t.*, b.body,
         CASE WHEN in_region = 1 THEN '<div class="region" id="' || t.r_name || '"><h1>' || t.r_name || '</h1>' ELSE '' END AS opening,
         CASE WHEN in_region = of_region THEN '</div>' ELSE '' END AS closing,
         '<h2>' || t.n_name || '</h2>' AS heading,
         '<table><caption>Customers of ' || t.n_name || '</caption>{SQL_CUSTOMER_HEAD}<tbody>' || body || '</tbody></table>' AS tab
  FROM tabs t JOIN bodies b ON t.page_id = b.page_id AND t.n_name = b.n_name AND t.r_name = b.r_name
)"""


# -- one page per order -------------------------------------------------------------

LINE_HEADERS = ("line", "part", "supp", "qty", "flag", "status")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


SQL_LINES = """
li AS (
  SELECT l_orderkey, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
         CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS flag, l_linestatus AS status,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT), l_returnflag, l_linestatus) AS row_no
  FROM lineitem
)"""


def order_documents(spark: SparkSession, sf_dir: str, target: str = "html", **options) -> DataFrame:
    """``l_orderkey, payload``: the lines of each order as one table."""
    grouped = render_groups(
        lines(spark, sf_dir), ["l_orderkey"], list(LINE_HEADERS), list(LINE_HEADERS), target, **options
    )
    return grouped.select("l_orderkey", "payload")


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, html``: a heading and the table of lines."""
    return order_documents(spark, sf_dir).select(
        "l_orderkey",
        F.concat(
            F.lit("<html><body><h1>Order "), F.col("l_orderkey").cast("string"), F.lit("</h1>\n"), "payload",
            F.lit("</body></html>"),
        ).alias("html"),
    )


# -- conversations: free text with line breaks ---------------------------------------


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.concat(F.lit('"'), "text", F.lit('", & <end>')).alias("text")
    )


SQL_CONVERSATIONS = """
conv AS (SELECT conv_id, turn, role, '"' || text || '", & <end>' AS text FROM conversations)"""


# -- nested tables: regions outside, nations inside -----------------------------------


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, html``: an outer row per region with a table of its nations."""
    counted = customers(spark, sf_dir).groupBy("page_id", "r_name", "n_name").agg(F.count(F.lit(1)).alias("n"))
    inner = group_text(
        counted, ["page_id", "r_name"], ["n_name"], html_row(F.array("n_name", F.col("n").cast("string")))
    )
    outer_row = F.concat(
        F.lit("<tr><td>"), "r_name", F.lit("</td><td><table>"), heads("nation", "n"), F.lit("<tbody>"), "body",
        F.lit("</tbody></table></td></tr>"),
    )
    pages = group_text(inner.withColumnRenamed("part", "p"), ["page_id"], ["r_name"], outer_row)
    return pages.select("page_id", F.concat(F.lit("<table>"), heads("region", "nations"), F.lit("<tbody>"), "body", F.lit("</tbody></table>")).alias("html"))


SQL_NESTED = SQL_CUSTOMERS + """,
inn AS (
  SELECT page_id, r_name, n_name, count(*) AS n,
         row_number() OVER (PARTITION BY page_id, r_name ORDER BY n_name) AS k,
         dense_rank() OVER (PARTITION BY page_id ORDER BY r_name) AS r
  FROM cust GROUP BY page_id, r_name, n_name
)"""
