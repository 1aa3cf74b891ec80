"""Near-duplicate vectors by lattice hashing and exact cosines.

1. Equal vectors become one node. Random projections to eight dimensions are decoded to E8 lattice points in
   several tables; a node's cells are its own one and the neighbouring ones that lie nearest.
2. Nodes of one cell that are all within half the threshold's angle of their mean form a ball. By the triangle
   inequality all of them are linked, so a group of copies of any size is one row from here on: its mean, its radius and its count.
3. Balls and single nodes meet where one's own cell is among the other's. Sketches of signs drop the unlike, and
   the exact angle of the centres with both radii says that all pairs link, or none, or that members must be compared.
4. Those are compared in blocks, inside tasks, and only counts and one link per group leave a task.

Every link counts only after an exact cosine or the triangle inequality with a margin; what may be missed are
pairs that never meet in a table. At the threshold itself a pair of vectors meets with a probability of about 0.997
(measured on 1,500 such pairs), above it more surely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabledocs.llm import lattice
from tabledocs.llm.links import components
from tabledocs.llm.shared import BROADCAST_IDS, cut

#: angles are compared with this margin, far above the error of a double
_MARGIN = 1e-7


@dataclass(frozen=True)
class LatticeOptions:
    """cosine: least of a link; tables: of lattice cells; probes: neighbouring cells of each; scale: of the projections (larger
    means smaller cells); block: rows of a cell or ball that meet others in one step."""

    cosine: float = 0.9
    tables: int = 6
    probes: int = 8
    scale: float = 0.75
    block: int = 2048


def usable(vector: Column) -> Column:
    """Whether a vector is not null, holds neither null nor non-finite components, and is not zero; never null itself."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The unit vectors in a binary column, all as long."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.float64).reshape(len(parts), -1)


def _sketches(unit: np.ndarray) -> np.ndarray:
    """128 signs of random projections of each row, as two 64-bit numbers."""
    signs = np.random.default_rng([14, unit.shape[1]]).normal(size=(unit.shape[1], 128))
    return np.packbits(unit @ signs > 0, axis=1).view(np.int64)


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _complete(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each group, which are neighbours; the first `keys` columns name it."""
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table])
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows - 1, bool)
        for k in range(keys):
            column = table.column(k).to_numpy()
            change |= column[1:] != column[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, z in zip(starts, starts[1:]):
            yield table.slice(a, z - a)
        kept = table.slice(starts[-1])
    if kept is not None:
        yield kept


def signed(nodes: DataFrame, options: LatticeOptions) -> DataFrame:
    """(node, unit, cells, sketch_a, sketch_b) of nodes (node, vec). Each table has 1 + probes cells, a node's own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                vectors = batch.column(1).take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), size)
                # first by the largest component, whose square need not fit a double
                vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
                unit = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
                rng = np.random.default_rng([13, size])
                points = unit @ (rng.normal(size=(size, 8 * options.tables)) * options.scale) + rng.normal(size=8 * options.tables) * 4
                tables = points.reshape(len(rows), options.tables, 8)
                cells = [lattice.keys(lattice.probed(tables[:, t], options.probes), size * options.tables + t) for t in range(options.tables)]
                cells = np.concatenate(cells, axis=1)
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * cells.shape[1])
                sketch = _sketches(unit)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)), pa.array([x.tobytes() for x in unit], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(cells.view(np.int64).ravel())), pa.array(sketch[:, 0].copy()), pa.array(sketch[:, 1].copy()),
                    ],
                    names=["node", "unit", "cells", "sketch_a", "sketch_b"],
                )

    return nodes.select("node", "vec").mapInArrow(run, "node bigint, unit binary, cells array<bigint>, sketch_a bigint, sketch_b bigint")


def _means(rows: DataFrame) -> DataFrame:
    """(key, center, center_a, center_b) of rows (key, unit): the direction of the sum of all vectors of a key and its sketch;
    none for keys with one row.

    Sums are made per batch first, so that one key with most rows moves few.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, place = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            order = np.argsort(place, kind="stable")
            counts = np.bincount(place)
            starts = np.cumsum(counts) - counts
            parts = batch.column(1).take(pa.array(order)).to_pylist()
            # vectors of one key are equally long
            sums = [np.frombuffer(b"".join(parts[a : a + n])).reshape(n, -1).sum(axis=0).tobytes() for a, n in zip(starts.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts, pa.int64()), pa.array(sums, pa.binary())], names=["key", "n", "total"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _complete(batches, 1):
            if sum(table.column("n").to_pylist()) < 2:
                continue
            total = _matrix(table.column("total")).sum(axis=0)
            length = np.sqrt((total**2).sum())
            if length > 0:
                unit = total / length
                sketch = _sketches(unit[None])
                yield pa.RecordBatch.from_arrays(
                    [table.column("key").slice(0, 1).combine_chunks(), pa.array([unit.tobytes()], pa.binary()), pa.array(sketch[:, 0].copy()), pa.array(sketch[:, 1].copy())],
                    names=["key", "center", "center_a", "center_b"],
                )

    sums = rows.select("key", "unit").mapInArrow(partial, "key bigint, n bigint, total binary")
    return sums.repartition("key").sortWithinPartitions("key").mapInArrow(finish, "key bigint, center binary, center_a bigint, center_b bigint")


def _angle_to(rows: DataFrame, one: str, other: str, output: str) -> DataFrame:
    """`rows` with the cosine and the angle of two columns of unit vectors in place of these: `output`_cosine and `output`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            cosines = np.array([np.frombuffer(a) @ np.frombuffer(b) for a, b in pairs], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(cosines), pa.array(_angles(cosines))], names=[*rest, f"{output}_cosine", output])

    rest = [c for c in rows.columns if c not in (one, other)]
    schema = ", ".join(f"{n} {t}" for n, t in rows.select(*rest).dtypes)
    return rows.select(one, other, *rest).mapInArrow(run, f"{schema}, {output}_cosine double, {output} double")


def _balls(marks: DataFrame, options: LatticeOptions) -> tuple[DataFrame, DataFrame]:
    """(node, ball) of nodes in balls, and (ball, center, center_a, center_b, radius). A ball is named by its smallest node."""
    half = float(np.arccos(options.cosine)) / 2 - _MARGIN
    home = marks.select("node", "unit", F.element_at("cells", 1).alias("key"))
    means = cut(_means(home))
    near = _angle_to(home.join(means.select("key", "center"), "key"), "unit", "center", "angle").where(F.col("angle") <= half)
    near = cut(near.select("node", "key", "angle"))
    balls = near.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("ball"), F.max("angle").alias("radius")).where("n > 1")
    balls = cut(balls.join(means, "key").drop("n"))
    return near.join(balls.select("key", "ball"), "key").select("node", "ball"), balls.drop("key")


def _met(visits: DataFrame, options: LatticeOptions) -> DataFrame:
    """Pairs (a, b) of groups, once each, that meet in a cell which is one's own and whose sketches do not rule a link out.

    visits: (cell, home, group, radius, sketch_a, sketch_b). Rows of a crowded cell are dealt into blocks, and each pair of blocks is
    a step of its own, so that no task holds a cell whole.
    """
    crowded = cut(visits.groupBy("cell").agg(F.count("*").alias("rows")).where(F.col("rows") > options.block))
    crowded = F.broadcast(crowded) if crowded.count() <= BROADCAST_IDS else crowded
    blocks = F.coalesce(F.ceil(F.col("rows") / options.block), F.lit(1)).cast("int")
    dealt = visits.join(crowded, "cell", "left").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("group"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "home", "group", "radius", "sketch_a", "sketch_b")
    threshold = float(np.arccos(options.cosine))

    def alike(table: pa.Table) -> Iterator[np.ndarray]:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        own, home, group, radius, a, b = (table.column(c).to_numpy() for c in ("own", "home", "group", "radius", "sketch_a", "sketch_b"))
        a, b = a.view(np.uint64), b.view(np.uint64)
        homes = np.flatnonzero(home)
        for start in range(0, len(homes), 256):
            i = homes[start : start + 256]
            apart = np.bitwise_count(a[i, None] ^ a[None]).astype(np.int16) + np.bitwise_count(b[i, None] ^ b[None])
            # of 128 signs the share angle / pi differs; five standard deviations more than at the largest angle of a link
            share = np.minimum(0.5, (threshold + radius[i, None] + radius[None]) / np.pi)
            hit = (apart <= 128 * share + 5 * np.sqrt(128 * share * (1 - share))) & (group[i, None] != group[None])
            if low != high:
                hit &= own[i, None] != own[None]
            one, other = np.nonzero(hit)
            one, other = group[i[one]], group[other]
            yield np.stack([np.minimum(one, other), np.maximum(one, other)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        size = 0
        for table in _complete(batches, 3):
            if table.num_rows > 1:
                for pairs in alike(table):
                    found.append(pairs)
                    size += pairs.shape[1]
                    if size > 1 << 16:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, np.concatenate(found, axis=1))), names=["a", "b"])
                        found, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, np.concatenate(found, axis=1))), names=["a", "b"])

    rows = dealt.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def _judged(pairs: DataFrame, groups: DataFrame, options: LatticeOptions) -> DataFrame:
    """(a, b, sure) of the pairs that link, whole (sure) or perhaps in part."""
    left, right = (groups.select(F.col("group").alias(x), F.col("center").alias(f"{x}_center"), F.col("radius").alias(f"{x}_radius")) for x in "ab")
    both = _angle_to(pairs.join(left, "a").join(right, "b"), "a_center", "b_center", "angle")
    spread = F.col("a_radius") + F.col("b_radius")
    threshold = float(np.arccos(options.cosine))
    sure = F.when(spread == 0, F.col("angle_cosine") >= options.cosine).otherwise(F.col("angle") + spread <= threshold - _MARGIN)
    perhaps = (spread > 0) & (F.col("angle") - spread <= threshold + _MARGIN)
    return both.withColumn("sure", sure).where(F.col("sure") | perhaps).select("a", "b", "sure")


def _between(pairs: DataFrame, placed: DataFrame, groups: DataFrame, options: LatticeOptions) -> DataFrame:
    """(node, group, add): for nodes of the pairs (a, b) of groups, the rows that they link to in the other group, and that group.

    The larger group of a pair is dealt into blocks, and so are the members of all groups that it is compared with; each
    pair of blocks is one step.
    """
    sizes = groups.select("group", "members")
    sized = pairs.join(sizes.select(F.col("group").alias("a"), F.col("members").alias("a_n")), "a").join(sizes.select(F.col("group").alias("b"), F.col("members").alias("b_n")), "b")
    first = F.col("a_n") >= F.col("b_n")
    sized = cut(sized.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("ball"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("group"),
        F.greatest("a_n", "b_n").alias("inside"), F.least("a_n", "b_n").alias("n"),
    ))
    shapes = sized.groupBy("ball").agg(F.max("inside").alias("inside"), F.sum("n").alias("outside"))
    shapes = shapes.select("ball", *[F.ceil(F.col(x) / options.block).cast("int").alias(x) for x in ("inside", "outside")])
    member = placed.select("group", "node", "weight", "unit")

    def dealt(rows: DataFrame, own: str, other: str, side: int) -> DataFrame:
        rows = rows.join(shapes, "ball").withColumn(own, F.pmod(F.xxhash64("node"), F.col(own)).cast("int"))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return rows.select("ball", "inside", "outside", F.lit(side).alias("side"), "group", "node", "weight", "unit")

    within = dealt(member.withColumn("ball", F.col("group")), "inside", "outside", 0)
    around = dealt(member.join(sized.select("ball", "group"), "group"), "outside", "inside", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _complete(batches, 3):
            side = table.column("side").to_numpy()
            cutoff = int(np.searchsorted(side, 1))
            if cutoff in (0, len(side)):
                continue
            group, node, weight = (table.column(c).to_numpy() for c in ("group", "node", "weight"))
            unit = _matrix(table.column("unit"))
            linked = unit[:cutoff] @ unit[cutoff:].T >= options.cosine
            # for those around: what they link to in the ball; for those in the ball: what they link to in each group around
            outer = np.flatnonzero(linked.any(axis=0))
            parts = [(node[cutoff:][outer], np.full(len(outer), group[0]), weight[:cutoff] @ linked[:, outer])]
            for other in np.unique(group[cutoff:][outer]).tolist():
                sums = linked[:, group[cutoff:] == other] @ weight[cutoff:][group[cutoff:] == other]
                inner = np.flatnonzero(sums)
                parts.append((node[:cutoff][inner], np.full(len(inner), other), sums[inner]))
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["node", "group", "add"])

    rows = within.unionByName(around).repartition("ball", "inside", "outside").sortWithinPartitions("ball", "inside", "outside", "side")
    return rows.mapInArrow(run, "node bigint, `group` bigint, add bigint")


def near_vectors(rows: DataFrame, options: LatticeOptions = LatticeOptions()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `rows` (vec_id, embedding).

    n_links counts the other rows with a cosine of at least `cosine` (double precision); component_id is the smallest
    vec_id that can be reached over links, the row's own included; kept says that it is the row's own.

    A vector that is null, zero, empty, or holds a null or a non-finite component has no links and is kept. Vectors of different
    lengths are not linked. Repeated rows, and rows that share a vec_id, are rows of their own: equal vectors are linked. A row without
    vec_id counts as a link of others; it is kept unless a row that it reaches has a vec_id. Other columns are ignored; an empty table gives no rows.
    """
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    own = rows.select(F.col("vec_id").cast("bigint"), F.when(usable(F.col("embedding")), vector).alias("vec"))
    # 128 bits of a vector name it
    own = own.withColumn("key_a", F.xxhash64("vec")).withColumn("key_b", F.xxhash64(F.lit(13), "vec"))
    equal = own.where("vec is not null").groupBy("key_a", "key_b").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.first("vec").alias("vec"))
    nodes = cut(equal.withColumn("node", F.monotonically_increasing_id()))
    marks = cut(signed(nodes, options))
    members, balls = _balls(marks, options)
    placed = marks.join(nodes.select("node", "vec_id", "weight"), "node").join(members, "node", "left")
    placed = cut(placed.withColumn("group", F.coalesce("ball", "node")))

    sums = placed.where("ball is not null").groupBy("ball").agg(F.sum("weight").alias("weight"), F.count("*").alias("members"))
    groups = placed.where("ball is null").select("group", F.col("unit").alias("center"), F.lit(0.0).alias("radius"), "weight", F.lit(1).cast("bigint").alias("members"), "sketch_a", "sketch_b")
    groups = cut(groups.unionByName(balls.join(sums, "ball").select(
        F.col("ball").alias("group"), "center", "radius", "weight", "members", F.col("center_a").alias("sketch_a"), F.col("center_b").alias("sketch_b")
    )))
    visits = placed.select("group", "ball", F.posexplode("cells").alias("at", "cell"), "sketch_a", "sketch_b")
    visits = visits.withColumn("home", F.col("at") % (1 + options.probes) == 0)
    single = visits.where("ball is null").select("cell", "home", "group", F.lit(0.0).alias("radius"), "sketch_a", "sketch_b")
    shared = visits.where("ball is not null").groupBy("cell", "group").agg(F.max("home").alias("home"))
    shared = shared.join(groups.select("group", "radius", "sketch_a", "sketch_b"), "group").select(single.columns)
    pairs = cut(_judged(cut(_met(cut(single.unionByName(shared)), options)), groups, options))

    whole = pairs.where("sure").select("a", "b")
    weights = groups.select("group", "weight")
    both = whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
    added = both.join(weights.withColumnRenamed("group", "b"), "b").groupBy(F.col("a").alias("group")).agg(F.sum("weight").alias("group_add"))
    between = cut(_between(pairs.where("not sure").select("a", "b"), placed, groups, options))
    single_add = between.groupBy("node").agg(F.sum("add").alias("node_add"))
    crossing = between.join(placed.select("node", F.col("group").alias("a")), "node").select("a", F.col("group").alias("b"))
    reached = components(cut(whole.unionByName(crossing.distinct()))).withColumnRenamed("node", "group")

    known = placed.select("node", "group", "vec_id").join(weights, "group").join(added, "group", "left").join(reached, "group", "left").join(single_add, "node", "left")
    links = F.col("weight") - 1 + F.coalesce("group_add", F.lit(0)) + F.coalesce("node_add", F.lit(0))
    known = cut(known.select("node", "vec_id", F.coalesce("component", "group").alias("component"), links.alias("n_links")))
    smallest = known.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    known = known.drop("vec_id").join(smallest, "component").join(nodes.select("node", "key_a", "key_b"), "node").select("key_a", "key_b", "n_links", "component_id")

    out = own.select("vec_id", *[F.when(F.col("vec").isNotNull(), F.col(k)).alias(k) for k in ("key_a", "key_b")]).join(known, ["key_a", "key_b"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), component.isNull()).alias("kept"),
    )
