"""Documents that arrive as files.

Reading tables is a projection of one document, so a stream needs neither state
nor watermark: the batch operators apply to a streaming frame as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tabledocs.operators import extract as operators
from tabledocs.operators.quality import counted, html_error, split_rejects
from tabledocs.plans.options import ExtractOptions


def stream_documents(spark: SparkSession, folder: str, schema: str, source: str = "parquet",
                     files_per_trigger: int | None = None, files: str | None = None,
                     entries: str | None = None) -> DataFrame:
    """Documents from files that keep arriving in ``folder``.

    ``files`` is a pattern for the files' own names, ``entries`` one for what stands in the folder: files, or
    folders of part files, which are read as well.
    """
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # in braces the path is a pattern even without wildcards, so that it may name a file as well as a folder
    return reader.format(source).load(f"{folder}/{{{entries}}}" if entries else folder)


def stream_tables(
    documents: DataFrame,
    html: str = "html",
    options: ExtractOptions = ExtractOptions(),
    level: str = "records",
) -> DataFrame:
    """Records, rows, cells or tables of the good documents of a stream."""
    if level not in ("records", "rows", "cells", "tables"):
        raise ValueError("level must be records, rows, cells or tables")
    good = documents.filter(html_error(html).isNull())
    return getattr(operators, level)(good, html, options)


def stream_rejects(documents: DataFrame, id_column: str, html: str = "html") -> DataFrame:
    return documents.select(id_column, html_error(html).alias("error")).filter(F.col("error").isNotNull())


def write_stream(
    frame: DataFrame, output: str, checkpoint: str, *, sink: str = "parquet",
    available_now: bool = True, each_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Append a stream to files; offsets and commits live in ``checkpoint``, so a
    restart neither loses nor repeats a document."""
    writer = frame.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    return writer.format(sink).option("path", output).outputMode("append").start()


def write_records_and_rejects(
    documents: DataFrame, id_column: str, output: str, rejects: str, checkpoint: str, *, html: str = "html",
    options: ExtractOptions = ExtractOptions(), level: str = "records", target: str = "records",
    available_now: bool = True, after_batch: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """One stream with two outputs: records (rows, cells, tables) of good documents, and rejects with their reasons.

    Each batch is read and judged once. Both sides are written under the number of the batch (``batch=n``), replacing what an attempt that
    was ended before has left there; ``checkpoint`` says which documents make a batch. So after any restart each document is in
    the outputs once. ``after_batch`` gets the number and the counts of ``rows``, ``good`` and ``rejected`` once both sides are written.
    """
    if level not in ("records", "rows", "cells", "tables"):
        raise ValueError("level must be records, rows, cells or tables")
    error = html_error(html)

    def write(batch: DataFrame, number: int) -> None:
        # held for two writes; a lost executor's part is read again
        marked, counts = counted(batch.withColumn("__error", error), F.col("__error"), {}, f"batch-{number}")
        marked = marked.persist()
        try:
            good, bad = split_rejects(marked, F.col("__error"), id_column, "html", target)
            good = good.drop("__error")
            getattr(operators, level)(good, html, options).write.mode("overwrite").parquet(f"{output}/batch={number}")
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        finally:
            marked.unpersist()
        if after_batch is not None:
            seen = counts.get
            after_batch(number, {"rows": seen["rows"], "good": seen["good"], "rejected": seen["other"]})

    writer = documents.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write).start()
