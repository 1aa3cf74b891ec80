"""One large CSV file with line breaks in fields, or one large JSON array, read by many tasks.

A file is cut at a byte that may end a record: a line feed for CSV, a closing brace for JSON. Whether a piece is inside quotes, and how
deep, depends on all pieces before it. Both are sums, so each block of a file is summed up by itself, a few numbers per
block are added up in order, and every task then knows where it stands. What a record has in the next block is a
fragment that is sent to the record's start; nothing else crosses blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabledocs.functions.payload import csv_cells
from tabledocs.operators.extract import each
from tabledocs.plans.options import check_delimiter

_BLOCK = ["file", "block"]


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``file, block, at, value``: the text between two separators; a block is what one task reads of a file."""
    lines = spark.read.option("lineSep", separator).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def _occurrences(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _before(pieces: DataFrame, amount: str, output: str) -> DataFrame:
    """``pieces`` with the sum of a column over all earlier pieces of the file: those of earlier blocks, then those of its own."""
    totals = pieces.groupBy(*_BLOCK).agg(F.sum(amount).alias("__sum"))
    # one row per block of a file
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*_BLOCK, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    own = Window.partitionBy(*_BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = pieces.withColumn("__local", F.coalesce(F.sum(amount).over(own), F.lit(0)))
    return local.join(offsets, _BLOCK).withColumn(output, F.col("__offset") + F.col("__local")).drop("__offset", "__local")


def _records(pieces: DataFrame, separator: str) -> DataFrame:
    """``file, block, at, text, last`` of records: pieces from one that starts a record up to the next that does, joined again.

    ``last`` says that the record ends the file.
    """
    own = Window.partitionBy(*_BLOCK).orderBy("at")
    numbered = pieces.withColumn("rec", F.sum(F.col("start").cast("int")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("at", "value")))
    texts = numbered.groupBy(*_BLOCK, "rec").agg(F.min("at").alias("at"), F.array_join(F.transform(parts, lambda p: p["value"]), separator).alias("text"))
    # the last record that begins before a block, and whether blocks follow
    ends = texts.groupBy(*_BLOCK).agg(F.max("rec").alias("n"))
    by_file = Window.partitionBy("file").orderBy("block")
    ends = ends.withColumn("owner", F.last(F.when(F.col("n") > 0, F.struct("block", "n")), ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, -1)))
    final = Window.partitionBy("file").orderBy(F.desc("block"))
    last = ends.withColumn("__k", F.row_number().over(final)).where("__k = 1")
    last = last.select("file", F.when(F.col("n") > 0, F.struct("block", "n")).otherwise(F.col("owner")).alias("end"))
    last = last.select("file", F.col("end.block").alias("block"), F.col("end.n").alias("rec"), F.lit(True).alias("last"))
    # what blocks begin with goes to the record before; a block may hold nothing else
    heads = texts.where("rec = 0").join(ends.select(*_BLOCK, "owner"), _BLOCK)
    fragments = F.array_sort(F.collect_list(F.struct("block", "text")))
    heads = heads.groupBy("file", F.col("owner.block").alias("owner_block"), F.col("owner.n").alias("rec")).agg(
        F.array_join(F.transform(fragments, lambda f: f["text"]), separator).alias("rest")
    ).withColumnRenamed("owner_block", "block")
    found = texts.where("rec > 0").join(heads, [*_BLOCK, "rec"], "left").join(last, [*_BLOCK, "rec"], "left")
    whole = F.when(F.col("rest").isNull(), F.col("text")).otherwise(F.concat("text", F.lit(separator), "rest"))
    return found.select(*_BLOCK, "at", whole.alias("text"), F.coalesce("last", F.lit(False)).alias("last"))


def csv_file_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, at, text``: the records of CSV files, each with its line breaks; ``block, at`` gives their order in a file."""
    pieces = _pieces(spark, path, "\n").withColumn("quotes", _occurrences(F.col("value"), '"'))
    records = _records(_before(pieces, "quotes", "opened").withColumn("start", F.col("opened") % 2 == 0), "\n")
    text = F.regexp_replace("text", "\\r$", "")
    return records.withColumn("text", text).where("text <> ''").drop("last")


def read_large_csv(spark: SparkSession, path: str, delimiter: str = ",", header: bool = True) -> DataFrame:
    """CSV files as text columns, like ``read_csv_files``, with one file read by as many tasks as it has blocks.

    Line breaks in fields stay as they are; the plain reader makes ``\\r\\n`` one ``\\n`` in files that have it between records.
    Names are those of the first file's header, or ``_c0, _c1, ...`` of its first record; building the frame reads that record.
    """
    records = csv_file_records(spark, path)
    options = {
        "sep": check_delimiter(delimiter), "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    firsts = records.where("block = 0").groupBy("file").agg(F.min(F.struct("at", "text")).alias("first"))
    head = firsts.orderBy("file").select(csv_cells(F.col("first.text"), delimiter)[0].alias("cells")).head()
    if head is None:
        return spark.createDataFrame([], "_c0 string")
    names = head["cells"]
    names = [n or f"_c{i}" for i, n in enumerate(names)] if header else [f"_c{i}" for i in range(len(names))]
    if header:
        records = records.join(firsts.select("file", F.col("first.at").alias("__first")), "file").where((F.col("block") > 0) | (F.col("at") != F.col("__first")))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    return records.select(F.from_csv("text", F.lit(schema), options).alias("r")).select("r.*")


def json_array_items(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, at, item``: the elements of files that hold one JSON array each, as text; ``block, at, part`` gives their order.

    Elements are cut between objects, so an array without objects is read by one task.
    """
    pieces = _pieces(spark, path, "}").withColumn("__plain", F.regexp_replace("value", "(?s)\\\\.", ""))
    pieces = pieces.withColumn("quotes", _occurrences(F.col("__plain"), '"'))
    pieces = _before(pieces, "quotes", "opened")
    inside = F.col("opened") % 2 == 1
    # what stands outside strings: without the rest of an open one, whole ones, and the beginning of one
    outside = F.when(inside, F.regexp_replace("__plain", '^[^"]*"?', "")).otherwise(F.col("__plain"))
    outside = F.regexp_replace(F.regexp_replace(outside, '"[^"]*"', ""), '(?s)".*$', "")
    closes = F.when((F.col("opened") + F.col("quotes")) % 2 == 0, 1).otherwise(0)
    pieces = pieces.withColumn("deeper", _occurrences(outside, "[{") - _occurrences(outside, "]}") - closes)
    pieces = _before(pieces.drop("__plain"), "deeper", "depth").withColumn("start", ~inside & (F.col("depth") <= 1))
    records = _records(pieces, "}")
    ended = F.when(F.col("last"), F.regexp_replace("text", "\\s*\\]\\s*$", "")).otherwise(F.concat("text", F.lit("}")))
    body = F.regexp_replace(ended, "^\\s*[\\[,]", "")
    items = records.select(*_BLOCK, "at", body.alias("body")).where(F.trim("body") != "")
    parsed = F.from_json(F.concat(F.lit("["), "body", F.lit("]")), "array<string>")
    return each(items, [*_BLOCK, "at"], parsed, "item", "part")
