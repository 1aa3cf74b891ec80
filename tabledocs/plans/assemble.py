"""From many rows to texts of groups of any size, by one rule.

The rows of a group are ranked, and their bytes summed in that order; ranks and sums
say which part, a text of its own, a row belongs to. The rule is the same for every group,
depends on the rows alone, and bounds what a task collects in rows and in bytes. How the ranks come
about depends on size: a group that makes one part needs none, and larger ones are ranked
over range partitions, so that no task holds a group whole.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

PART_ROWS = 20_000
PART_BYTES = 16 << 20
# The characters of a text that say which range a row belongs to, and the bytes of rows that a task gets.
BOUND_CHARS = 64
STRETCH_BYTES = 64 << 20
# Fixed value: the rows of a counted table of keys that every task may hold.
FEW_KEYS = 100_000


def _join_ordered(order: list[str], separator: str) -> Column:
    collected = F.sort_array(F.collect_list(F.struct(*order, "__text")))
    return F.array_join(F.transform(collected, lambda s: s["__text"]), separator)


def group_text(
    df: DataFrame,
    keys: list[str],
    order: dict[str, Column] | list[str],
    text: Column,
    *,
    separator: str = "",
    max_rows: int = PART_ROWS,
    max_bytes: int = PART_BYTES,
    most: Column | None = None,
    first_row: str | None = None,
) -> DataFrame:
    """``keys, part, body``: the ordered texts of each group.

    Rows are ranked in the order given; rows that tie are ordered by their text. A row of rank r, with b bytes of text
    before it in its group, belongs to part ``(r - 1) div max_rows + b div max_bytes``. So a part has at most ``max_rows`` rows and, besides its last row,
    less than ``max_bytes`` bytes of text; parts are in order, and a number may be left out where both bounds are met at once.

    One aggregation counts rows and bytes per group; ``most``, at least the bytes of a row's text, spares
    making the texts for it. Groups that fit a part are collected; the others, and those that only may be larger, are
    ranked by ``running_totals``, whatever their size, with the same result. ``first_row`` names a column for the rank of
    a part's first row in its group.
    """
    columns = {n: F.col(n) for n in order} if isinstance(order, list) else order
    names = [f"__o{i}" for i in range(len(columns))]
    slim = df.select(
        *keys, *[c.alias(n) for n, c in zip(names, columns.values(), strict=True)], text.alias("__text")
    )
    size = F.coalesce(F.octet_length("__text"), F.lit(0)).cast("bigint")
    sizes = df.select(*keys, (F.coalesce(F.octet_length(text), F.lit(0)) if most is None else most).cast("bigint").alias("__most"))
    sizes = sizes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.sum("__most").alias("__bytes"))
    large = sizes.where((F.col("__rows") > max_rows) | (F.col("__bytes") >= max_bytes))
    counts = large.agg(F.count(F.lit(1)).alias("groups"), F.sum("__rows").alias("rows"), F.sum("__bytes").alias("bytes")).first()
    large = large.select(*keys)
    first = [F.lit(0).cast("bigint").alias("part"), "body"] + ([F.lit(1).cast("bigint").alias(first_row)] if first_row else [])
    if not counts["groups"]:
        return slim.groupBy(*keys).agg(_join_ordered(names, separator).alias("body")).select(*keys, *first) if keys else (
            # an empty table has no text
            slim.agg(F.count(F.lit(1)).alias("__rows"), _join_ordered(names, separator).alias("body")).where("__rows > 0").select(*first)
        )
    wide = slim
    if keys:
        # a join by key would bring all rows of a hot key to one task
        large = durable(large)
        large = F.broadcast(large) if counts["groups"] <= FEW_KEYS else large
        alike = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
        wide = slim.alias("l").join(large.alias("r"), alike, "left_semi")
        small = slim.alias("l").join(large.alias("r"), alike, "left_anti").groupBy(*keys).agg(_join_ordered(names, separator).alias("body"))
    # all rows of the large groups, with their text twice as it is cut and joined
    stretches = int(2 * (counts["rows"] * 16 * (len(names) + len(keys) + 3) + counts["bytes"]) // STRETCH_BYTES) + 1
    placed = running_totals(wide, keys, [F.col(n) for n in (*names, "__text")], {"__before": size}, stretches=stretches, groups=counts["groups"])
    part = F.floor((F.col("__rank") - 1) / max_rows) + F.floor((F.col("__before") - size) / max_bytes)
    starts = [F.min("__rank").cast("bigint").alias(first_row)] if first_row else []
    parts = placed.withColumn("part", part.cast("bigint"))
    if stretches > _shuffle_partitions(df):
        parts = parts.repartition(stretches, *keys, "part")
    parts = parts.groupBy(*keys, "part").agg(_join_ordered(["__rank"], separator).alias("body"), *starts)
    return small.select(*keys, *first).unionByName(parts) if keys else parts


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bounds(df: DataFrame, by: list[Column]) -> list[Column]:
    """The start of an order, never against it, of bounded size per row.

    The driver finds ranges from sampled rows of their order; whole texts there would be sent to it. A text is cut, and rows whose text is
    cut come after those whose text ends there; what is ordered after a cut text does not count.
    """
    out: list[Column] = []
    whole = F.lit(True)
    for column, kind in zip(by, df.select(*[c.alias(f"c{i}") for i, c in enumerate(by)]).dtypes, strict=True):
        # nulls come first, as they do where nothing is left to compare
        out.append(F.when(whole, F.left(column, F.lit(BOUND_CHARS)) if kind[1] == "string" else column))
        if kind[1] == "string":
            cut = F.coalesce(F.length(column) > BOUND_CHARS, F.lit(False))
            out.append(F.when(whole, cut))
            whole = whole & ~cut
    return out


def running_totals(
    df: DataFrame, keys: list[str], by: list[Column], sums: dict[str, Column], rank: str = "__rank", stretches: int = 1,
    groups: int | None = None,
) -> DataFrame:
    """``df`` with each row's rank in its group in the order ``by``, and the running sums of columns up to it, itself included.

    A segmented prefix sum: rows are range-partitioned by keys and order and stored, so that a hot key is cut into
    as many stretches as partitions; a stretch is summed up in one task, and starts from the totals of the key's stretches before it. Rows that tie
    in everything are interchangeable and are dealt out as well. Without keys all rows are one group. ``stretches`` is the least
    number of them, from the size of the rows, so that what a task reads does not grow with the table; ``groups``, the number of
    groups where it is known, says whether the stretches' totals go to every task.
    """
    columns = df.columns
    tie, at, stretch = "__tie", "__at", "__stretch"
    total = {n: f"__total{i}" for i, n in enumerate(sums)}
    ordered = [*[F.col(f"`{k}`") for k in keys], *by, F.col(tie)]
    # several stretches to a task, so that dealing them out by number is even
    dealt = max(stretches, _shuffle_partitions(df))
    stretches = max(stretches, 4 * _shuffle_partitions(df))
    tied = df.withColumn(tie, F.monotonically_increasing_id())
    placed = durable(
        tied.repartitionByRange(stretches, *_bounds(tied, ordered)).sortWithinPartitions(*ordered)
        .withColumn(at, F.monotonically_increasing_id()).withColumn(stretch, F.shiftright(at, 33))
    )
    counted = placed.groupBy(*keys, stretch).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(total[n]) for n, c in sums.items()])
    # a key has as many rows here as partitions
    earlier = Window.partitionBy(*keys).orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        *keys, stretch, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__skip"),
        *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(t) for t in total.values()],
    )
    # stretches are dealt out by number, one or a few to a task, which the windows then need no other exchange for
    own = Window.partitionBy(*keys, stretch).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.repartitionByRange(dealt, stretch).select(
        *columns, stretch, F.row_number().over(own).alias(rank), *[F.sum(c).over(own).alias(n) for n, c in sums.items()]
    )
    if groups is not None and groups + stretches <= FEW_KEYS:
        offsets = F.broadcast(offsets)
    alike = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in (*keys, stretch)]
    return local.alias("l").join(offsets.alias("r"), alike, "left").select(
        *[F.col(f"l.`{c}`") for c in columns], (F.col(rank) + F.col("__skip")).alias(rank), *[(F.col(n) + F.col(t)).alias(n) for n, t in total.items()]
    )


def ordered_position(df: DataFrame, by: list[Column], output: str = "position") -> DataFrame:
    """Dense 1-based position of every row in a total order.

    The rows are range-partitioned and sorted; a row's position is its place in
    its partition plus the sizes of the partitions before it.  The sorted rows
    are checkpointed so both uses see the same partitions even after a retry.
    """
    placed = (
        df.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    placed = durable(placed)
    split = F.shiftright("__id", 33)
    sizes = placed.groupBy(split.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition of the sort, so this window and broadcast stay small
    so_far = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__p", F.coalesce(F.sum("__n").over(so_far), F.lit(0)).alias("__before"))
    return (
        placed.withColumn("__p", split)
        .join(F.broadcast(before), "__p")
        .withColumn(output, F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
        .drop("__p", "__id", "__before")
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tabledocs-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage in the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()
