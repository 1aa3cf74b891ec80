"""Queries that run as streams, and counts that are made while a job runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

import tabledocs as td
from tabledocs import ExtractOptions
from tabledocs.plans.assemble import checkpoint_folder
from tabledocs.streaming.documents import stream_documents, write_records_and_rejects
from workload import documents as D
from workload.registry import query


def _mixed(pages: DataFrame) -> DataFrame:
    """Pages of which some are empty, some have no table, and some hold tables of one to three rows."""
    k = F.col("page_id") % 5
    rows = F.repeat(F.concat(F.lit("<tr><td>"), F.col("page_id").cast("string"), F.lit("</td></tr>")), (F.col("page_id") % 3 + 1).cast("int"))
    return pages.select(
        "page_id",
        F.when(k == 0, F.lit("")).when(k == 1, F.col("html"))
        .otherwise(F.concat("html", F.lit("<table><tr><th>id</th></tr>"), rows, F.lit("</table>"))).alias("html"),
    )


_REASON = "CASE page_id % 5 WHEN 0 THEN 'must be a non-empty string' WHEN 1 THEN 'no table elements found' END"


@query(
    f"""SELECT page_id, 'record' AS side, CAST(i AS INTEGER) AS row_no, CAST(page_id AS VARCHAR) AS value FROM pages, range(1, 4) t(i)
WHERE page_id % 5 > 1 AND i <= page_id % 3 + 1
UNION ALL SELECT page_id, 'reject', NULL, {_REASON} FROM pages WHERE page_id % 5 < 2"""
)
def stream_records_and_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that arrive as files: one stream writes the records of the good ones and the others with their reasons."""
    base = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    pages = _mixed(stream_documents(spark, sf, "page_id bigint, url string, html string", entries="pages.parquet"))
    options = ExtractOptions(headings=False)
    write_records_and_rejects(pages, "page_id", f"{base}/out", f"{base}/rejects", f"{base}/state", options=options).awaitTermination()
    records = spark.read.parquet(f"{base}/out").select("page_id", F.lit("record").alias("side"), "row_no", F.try_element_at("rec", F.lit("id")).alias("value"))
    rejects = spark.read.parquet(f"{base}/rejects").select("page_id", F.lit("reject").alias("side"), F.lit(None).cast("int").alias("row_no"), F.col("error").alias("value"))
    return records.unionByName(rejects)


@query(
    f"""WITH e AS (SELECT {_REASON} AS error FROM pages),
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE error IS NULL) AS good, count(*) FILTER (WHERE error LIKE 'must%') AS empty, count(*) FILTER (WHERE error LIKE 'no table%') AS tables FROM e)
SELECT kind, n, written FROM (SELECT unnest(['rows', 'good', 'empty', 'without tables', 'other']) AS kind, unnest([total, good, empty, tables, 0]) AS n,
  unnest([total, good, empty, tables, 0]) AS written FROM c)"""
)
def rejects_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per kind of error, made by the job that writes the judged pages, beside counts of what it wrote."""
    path = f"{checkpoint_folder(spark)}/judged-{uuid.uuid4().hex}"
    marked = td.checked(_mixed(D.table(spark, sf, "pages")), td.html_error("html"))
    out, counts = td.counted(marked, "error", {"empty": "must be", "without tables": "no table"})
    out.write.parquet(path)
    seen = spark.createDataFrame(list(counts.get.items()), "kind string, n bigint")
    error = F.col("error")
    written = spark.read.parquet(path).select(
        F.explode(
            F.array(
                F.lit("rows"),
                F.when(error.isNull(), "good").when(error.startswith("must be"), "empty").when(error.startswith("no table"), "without tables").otherwise("other"),
            )
        ).alias("kind")
    )
    written = written.groupBy("kind").agg(F.count(F.lit(1)).alias("written"))
    return seen.join(written, "kind", "left").select("kind", "n", F.coalesce("written", F.lit(0)).alias("written"))
