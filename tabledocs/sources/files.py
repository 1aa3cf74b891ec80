"""Reading documents from files, and writing results as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabledocs.plans.options import check_delimiter

# Schema of a landing folder of whole documents.
DOCUMENT_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.StringType()), T.StructField("payload", T.StringType())]
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``doc_id`` (the path) and ``payload`` (the text)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("payload")
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines items as text, one per row, with the file they came from."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("item")
    ).filter(F.trim("item") != "")


def read_csv_files(spark: SparkSession, path: str, delimiter: str = ",", header: bool = True) -> DataFrame:
    """CSV files as text columns; quotes are doubled, fields may span lines."""
    return spark.read.csv(
        path, sep=check_delimiter(delimiter), header=header, multiLine=True, quote='"', escape='"',
        inferSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def read_json_files(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return spark.read.json(path, multiLine=multi_line, primitivesAsString=True)


def literal_document(spark: SparkSession, payload: str, doc_id: str = "input") -> DataFrame:
    """A payload given in the call rather than read from upstream."""
    return spark.createDataFrame([(doc_id, payload)], DOCUMENT_SCHEMA)


def explicit_or_upstream(explicit: Column, upstream: Column) -> Column:
    """The explicit payload when there is one, else the upstream one."""
    return F.when(explicit.isNotNull() & (explicit != ""), explicit).otherwise(upstream)


def write_csv(df: DataFrame, path: str, delimiter: str = ",", header: bool = True, mode: str = "errorifexists") -> None:
    """All rows as CSV files, one per partition: the whole batch without one big text."""
    df.write.csv(
        path, sep=check_delimiter(delimiter), header=header, quote='"', escape='"', escapeQuotes=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="", mode=mode,
    )


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.json(path, ignoreNullFields=False, mode=mode)


def write_text(df: DataFrame, path: str, column: str = "payload", partition_by: list[str] | None = None,
               mode: str = "errorifexists") -> None:
    """Payloads one after the other, in text files."""
    out = df.select(*(partition_by or []), F.col(column).alias("value"))
    writer = out.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)
