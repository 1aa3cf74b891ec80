"""Tables that every executor sees, and choices of join by counted size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows of ids that a join may broadcast after counting them: 16 bytes each, so 16 MB
BROADCAST_IDS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where it is unset and everything runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The rows written to a table in the shared folder and read back: lineage ends, lost executors lose nothing."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def having(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among `ids` (distinct, stored): broadcast where counted to be few, shuffled else."""
    ids = ids.select(key)
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, key, "left_semi")


def text_of(column: Column) -> Column:
    """A null text is an empty one."""
    return F.coalesce(column.cast("string"), F.lit(""))
