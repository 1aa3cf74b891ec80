"""Queries that write files and read them back in blocks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

import tabledocs as td
from tabledocs.plans.assemble import checkpoint_folder
from tabledocs.sources import files
from tabledocs.sources.split import json_array_items, read_large_csv
from workload import documents as D
from workload.registry import query

_SQL = """SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role || chr(10) || '"' || coalesce(text, '') || '}",' AS note FROM conversations"""


def _notes(spark: SparkSession, sf: str) -> DataFrame:
    """Turns with line breaks, quotes and brackets in their texts."""
    note = F.concat("role", F.lit('\n"'), F.coalesce("text", F.lit("")), F.lit('}",'))
    return D.table(spark, sf, "conversations").select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), note.alias("note"))


@query(_SQL)
def csv_files_in_blocks(spark, sf):
    """CSV files whose fields span lines, each read by as many tasks as it has blocks."""
    path = f"{checkpoint_folder(spark)}/csv-{uuid.uuid4().hex}"
    files.write_csv(_notes(spark, sf), path)
    return read_large_csv(spark, path)


@query(_SQL)
def json_arrays_in_blocks(spark, sf):
    """JSON arrays of one line each, read by as many tasks as a file has blocks."""
    path = f"{checkpoint_folder(spark)}/json-{uuid.uuid4().hex}"
    parts = td.render_all(_notes(spark, sf), ["conv_id", "turn", "note"], ["conv_id", "turn"], "json", max_bytes=200_000)
    files.write_text(parts, path, partition_by=["part"])
    items = json_array_items(spark, path)
    record = F.from_json("item", "conv_id string, turn string, note string")
    return items.select(record.alias("r")).select("r.*")
