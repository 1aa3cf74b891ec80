"""Hard negatives by inner product, from an R-tree that is packed by sort-tile-recursive partitioning.

Building: Spark sorts all vectors by their first coordinate into slabs and each slab by the second; runs of equal size
are the tiles. A tile is a row: its vectors, packed the same way by the next two coordinates into leaves, with
a minimum bounding box for each leaf. Consecutive tiles of a slab are a shard.

Searching: a box gives an interval of inner products, coordinate by coordinate. Queries first meet the boxes of all
tiles, which says what shards may hold results; the most promising shard of each query is searched, and then the others
whose boxes reach into the score window and are not strictly below the k-th result so far. Within a shard a best-first queue
goes from tiles to leaves and ends by the same rule. Ties are not cut, so the result is that of a full search.

Shards are held in memory, and queries stream past them: a shard with very many queries is given to several tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabledocs.llm.shared import cut

#: whole numbers up to here are exact in a double
_EXACT = 2.0**53


@dataclass(frozen=True)
class HardNegativeOptions:
    """positives: of each anchor; negatives: of each positive; low, high: hundredths of the positive's score between which a
    negative's lies; tile, leaf: vectors in each; shard: tiles of a shard; page: tiles whose boxes a task holds when it
    looks for shards; queries: that one task compares with a shard or a page."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    tile: int = 2048
    leaf: int = 128
    shard: int = 32
    page: int = 4096
    queries: int = 8192


def scored(vector: Column) -> Column:
    """Each component x as floor(256 x), a whole number in a double. From 2^53 on a double is whole; non-finite ones stay so."""
    whole = F.transform(vector.cast("array<double>"), lambda x: 256 * x)
    return F.transform(whole, lambda x: F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x))


def complete(vector: Column) -> Column:
    """Whether a vector is not null and holds neither null nor non-finite components; never null itself."""
    finite = F.forall(vector.cast("array<double>"), lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(finite, F.lit(False))


def _rows_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of one matrix; a shorter one is as if it went on with zeros."""
    parts = [np.frombuffer(x) for x in column.to_pylist()]
    matrix = np.zeros((len(parts), max(map(len, parts), default=0)))
    for row, part in zip(matrix, parts, strict=True):
        row[: len(part)] = part
    return matrix


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact: in doubles where all sums are small enough, else in whole numbers of any size."""
    size = min(left.shape[1], right.shape[1])
    left, right = left[:, :size], right[:, :size]
    if size == 0 or not left.size or not right.size:
        return np.zeros((len(left), len(right)))
    if np.abs(left).max() * np.abs(right).max() * size < _EXACT:
        return left @ right.T
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object) for m in (left, right)]
    return whole[0] @ whole[1].T


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) inner product of each query with any vector in each box."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return _products(up, low) + _products(down, high), _products(up, high) + _products(down, low)


def _parts(order: np.ndarray, matrix: np.ndarray, axis: int, pieces: int) -> list[np.ndarray]:
    """`order` sorted by a coordinate of the rows and cut into pieces."""
    if matrix.shape[1]:
        order = order[np.argsort(matrix[order, axis % matrix.shape[1]], kind="stable")]
    return np.array_split(order, pieces)


def tiles(points: DataFrame, options: HardNegativeOptions) -> DataFrame:
    """The tree of `points` (vec_id, label, vector): a row per tile.

    (shard, ids, labels, starts, data, low, high, box_low, box_high): `starts` are where leaves begin, low and high their boxes, box_low
    and box_high that of the tile.
    """
    count = points.count()
    slabs = max(1, round(np.sqrt(count / options.tile)))
    axes = [F.coalesce(F.try_element_at("vector", F.lit(k)), F.lit(0.0)) for k in (1, 2, 3)]

    def tile(number: int, part: pa.Table) -> pa.RecordBatch:
        vectors = part.column("vector").combine_chunks()
        lengths = np.diff(vectors.offsets.to_numpy())
        matrix = np.zeros((part.num_rows, int(lengths.max())))
        matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
        leaves = -(-part.num_rows // options.leaf)
        strips = max(1, round(np.sqrt(leaves)))
        found = [leaf for strip in _parts(np.arange(part.num_rows), matrix, 2, strips) for leaf in _parts(strip, matrix, 3, -(-len(strip) // options.leaf)) if len(leaf)]
        order = np.concatenate(found)
        matrix = matrix[order]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in found])])[:-1]
        low, high = (f.reduceat(matrix, starts, axis=0) if matrix.shape[1] else np.zeros((len(starts), 0)) for f in (np.minimum, np.maximum))
        shard = TaskContext.get().partitionId() << 32 | number // options.shard
        lists = [part.column(c).combine_chunks().take(pa.array(order)) for c in ("vec_id", "label")] + [pa.array(starts, pa.int32())]
        blobs = (matrix, low, high, low.min(axis=0), high.max(axis=0))
        return pa.RecordBatch.from_arrays(
            [pa.array([shard]), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)],
            names=["shard", "ids", "labels", "starts", "data", "low", "high", "box_low", "box_high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, kept = 0, None
        for batch in batches:
            kept = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            while kept.num_rows >= options.tile:
                yield tile(number, kept.slice(0, options.tile))
                kept, number = kept.slice(options.tile), number + 1
        if kept is not None and kept.num_rows:
            yield tile(number, kept)

    # equal first coordinates are told apart by the next ones, so that no value makes a slab of its own
    dealt = points.repartitionByRange(slabs, *axes, "vec_id").sortWithinPartitions(axes[1], axes[2], axes[0], "vec_id")
    schema = "shard bigint, ids array<bigint>, labels array<bigint>, starts array<int>, data binary, low binary, high binary, box_low binary, box_high binary"
    return cut(dealt.select("vec_id", F.col("label").cast("bigint").alias("label"), "vector").mapInArrow(run, schema))


def _streamed(index: DataFrame, queries: DataFrame, options: HardNegativeOptions, compare: Callable, schema: str) -> DataFrame:
    """compare(rows of `index`, queries) for each `key`, the queries of a key in batches.

    The index rows of a key are held in memory. A key with many queries is given to as many tasks as its count asks for,
    each with a copy of the index rows.
    """
    counts = queries.groupBy("key").agg(F.ceil(F.count("*") / options.queries).cast("int").alias("tasks"))
    held = index.join(counts, "key").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).drop("tasks")
    dealt = queries.join(counts, "key").withColumn("task", F.pmod(F.xxhash64("query"), F.col("tasks")).cast("int")).drop("tasks")
    held, dealt = held.withColumn("asks", F.lit(False)), dealt.withColumn("asks", F.lit(True))
    rows = held.unionByName(dealt, allowMissingColumns=True).repartition("key", "task").sortWithinPartitions("key", "task", "asks")
    names = [c for c in rows.columns if c not in ("key", "task", "asks")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept, ready = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2)], axis=1).astype(np.int64)
            starts = np.flatnonzero((np.diff(keys, axis=0, prepend=-1) != 0).any(axis=1)).tolist()
            for a, z in zip(starts, [*starts[1:], len(keys)], strict=True):
                if tuple(keys[a, :2]) != at:
                    at, kept, ready = tuple(keys[a, :2]), [], None
                part = pa.Table.from_batches([batch.slice(a, z - a)])
                if not keys[a, 2]:
                    kept.append(part)
                elif kept:
                    ready = pa.concat_tables(kept) if ready is None else ready
                    yield from compare(ready, part)

    return rows.select("key", "task", "asks", *names).mapInArrow(run, schema)


def _open(least: np.ndarray, most: np.ndarray, lows: np.ndarray, highs: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """Whether an interval reaches into some window and is not strictly below what that window has already."""
    return ((most >= lows) & (least <= highs) & (most >= floors)).any(axis=-1)


def _windows(part: pa.Table, row: int) -> list[list[int]]:
    return [part.column(c)[row].as_py() for c in ("lows", "highs", "floors")]


def _routes(tree: DataFrame, queries: DataFrame, options: HardNegativeOptions) -> DataFrame:
    """(query, shard, most): the shards with a tile that may hold results, and the most that one may score there."""

    def compare(boxes: pa.Table, part: pa.Table) -> Iterator[pa.RecordBatch]:
        shard = boxes.column("shard").to_numpy()
        order = np.argsort(shard, kind="stable")
        starts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        low, high = (_rows_of(boxes.column(c))[order] for c in ("box_low", "box_high"))
        for begin in range(0, part.num_rows, 64):
            some = part.slice(begin, 64)
            least, most = _bounds(_rows_of(some.column("vector")), low, high)
            for row in range(some.num_rows):
                lows, highs, floors = (np.array(w, dtype=object) for w in _windows(some, row))
                hit = _open(least[row][:, None], most[row][:, None], lows, highs, floors).astype(bool)
                best = np.maximum.reduceat(np.where(hit, most[row], -np.inf), starts)
                chosen = np.flatnonzero(best > -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some.column("query")[row].as_py()] * len(chosen), pa.int64()), pa.array(shard[order][starts][chosen]), pa.array(best[chosen].astype(float))],
                    names=["query", "shard", "most"],
                )

    pages = max(1, -(-tree.count() // options.page))
    index = tree.select(F.pmod(F.xxhash64("shard"), F.lit(pages)).alias("key"), "shard", "box_low", "box_high")
    asked = queries.withColumn("key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(pages - 1).cast("bigint"))))
    return _streamed(index, asked, options, compare, "query bigint, shard bigint, most double")


def _found(tree: DataFrame, queries: DataFrame, routes: DataFrame, same: bool, k: int, options: HardNegativeOptions) -> DataFrame:
    """(query, window, vec_id, score): the first k in each window of each query, shard by shard."""

    def best_first(leaves: list[tuple], spans: list[tuple[int, int]], bounds: tuple, query: int, label: int, vector: np.ndarray, windows: list) -> Iterator[tuple]:
        least, most, tile_least, tile_most = bounds
        lows, highs, floors = windows
        tops: list[list] = [[] for _ in lows]
        floors = list(floors)

        def opened(low: float, high: float) -> bool:
            return any(high >= a and low <= b and high >= f for a, b, f in zip(lows, highs, floors, strict=True))

        # of equally promising ones the tiles come first
        queue = [(-m, 0, t) for t, m in enumerate(tile_most)]
        heapq.heapify(queue)
        least_floor = min(max(a, f) for a, f in zip(lows, floors, strict=True)) if lows else 0
        while queue:
            bound, kind, at = heapq.heappop(queue)
            if -bound < least_floor:
                break
            if kind == 0:
                if opened(tile_least[at], -bound):
                    for leaf in range(*spans[at]):
                        if opened(least[leaf], most[leaf]):
                            heapq.heappush(queue, (-most[leaf], 1, leaf))
                continue
            if not opened(least[at], -bound):
                continue
            ids, labels, matrix = leaves[at]
            fits = (labels == label) & (ids != query) if same else labels != label
            if not fits.any():
                continue
            score = _products(vector[None], matrix)[0]
            for w, (low, high) in enumerate(zip(lows, highs, strict=True)):
                hit = np.flatnonzero(fits & (score >= max(low, floors[w])) & (score <= high))
                if len(hit):
                    tops[w] = sorted([*tops[w], *((-int(s), i) for s, i in zip(score[hit].tolist(), ids[hit].tolist(), strict=True))])[:k]
                    if len(tops[w]) == k:
                        floors[w] = max(floors[w], -tops[w][-1][0])
                        least_floor = min(max(a, f) for a, f in zip(lows, floors, strict=True))
        for w, top in enumerate(tops):
            for minus, i in top:
                yield query, w, i, -minus

    def compare(held: pa.Table, part: pa.Table) -> Iterator[pa.RecordBatch]:
        leaves, spans, boxes = [], [], [[], []]
        size = max(len(x) for x in held.column("box_low").to_pylist()) // 8
        for row in range(held.num_rows):
            ids, labels, starts = (held.column(c)[row].values.to_numpy() for c in ("ids", "labels", "starts"))
            matrix, low, high = (np.frombuffer(held.column(c)[row].as_py()) for c in ("data", "low", "high"))
            matrix, low, high = matrix.reshape(len(ids), -1), low.reshape(len(starts), -1), high.reshape(len(starts), -1)
            spans.append((len(leaves), len(leaves) + len(starts)))
            leaves += [(ids[a:z], labels[a:z], matrix[a:z]) for a, z in zip(starts, [*starts[1:], len(ids)], strict=True)]
            for box, x in zip(boxes, (low, high), strict=True):
                box.append(np.pad(x, ((0, 0), (0, size - x.shape[1]))))
        low, high = map(np.concatenate, boxes)
        begins = [a for a, _ in spans]
        tile_low, tile_high = np.minimum.reduceat(low, begins, axis=0), np.maximum.reduceat(high, begins, axis=0)
        for begin in range(0, part.num_rows, 64):
            some = part.slice(begin, 64)
            vectors = _rows_of(some.column("vector"))
            bounds = [x.tolist() for x in (*_bounds(vectors, low, high), *_bounds(vectors, tile_low, tile_high))]
            query, label = (some.column(c).to_pylist() for c in ("query", "label"))
            rows = [x for r in range(some.num_rows) for x in best_first(leaves, spans, [b[r] for b in bounds], query[r], label[r], vectors[r], _windows(some, r))]
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["query", "window", "vec_id", "score"])

    index = tree.withColumnRenamed("shard", "key").drop("box_high")
    asked = queries.join(routes.select("query", F.col("shard").alias("key")), "query")
    return _streamed(index, asked, options, compare, "query bigint, window int, vec_id bigint, score bigint")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query and window, ranked."""
    rank = F.row_number().over(Window.partitionBy("query", "window").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(tree: DataFrame, queries: DataFrame, same: bool, k: int, options: HardNegativeOptions) -> DataFrame:
    """(query, window, vec_id, score, rank): the first k rows in each score window of each query, highest scores first, ties by smaller vec_id.

    queries: (query, label, vector as binary, lows, highs), windows with both ends included; `same` asks for other rows of
    the query's label, else for rows of other labels.
    """
    none = -(2**63)
    queries = cut(queries.withColumn("floors", F.transform("lows", lambda x: F.lit(none).cast("bigint"))))
    routes = cut(_routes(tree, queries, options))
    best = routes.groupBy("query").agg(F.max(F.struct("most", "shard")).alias("best")).select("query", F.col("best.shard").alias("shard"))
    best = cut(best)
    begun = cut(_first(_found(tree, queries, best, same, k, options), k))
    full = begun.where(F.col("rank") == k).groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("scores"))
    raised = F.transform("floors", lambda f, i: F.coalesce(F.try_element_at("scores", i), f))
    queries = cut(queries.join(full, "query", "left").withColumn("floors", F.when(F.col("scores").isNull(), F.col("floors")).otherwise(raised)).drop("scores"))
    # the shards again, by what is known now
    rest = _routes(tree, queries, options).join(best, ["query", "shard"], "left_anti")
    later = _found(tree, queries, cut(rest), same, k, options)
    return _first(begun.drop("rank").unionByName(later), k)


def hard_negatives(points: DataFrame, anchor: Column, options: HardNegativeOptions = HardNegativeOptions()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    points: (vec_id, label, vector of whole numbers as doubles); `anchor` says which rows are anchors. A score is an inner
    product, exact. The positives of an anchor are its first other rows of the same label; its negatives for a positive are the
    first rows of other labels whose scores lie between `low` and `high` hundredths of the positive's, ranked from 1. First are higher
    scores, then smaller vec_ids. A positive without a negative gives no row; for a negative positive score there is none.

    Rows without vec_id or label, and vectors that are null or hold null or non-finite components, take no part. Empty and zero
    vectors do; shorter vectors are as if they went on with zeros. Rows that share a vec_id count once: that with the smallest label,
    then vector. A score beyond 64 bits is an error. Other columns are ignored; an empty table gives no rows.
    """
    usable = points.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & complete(F.col("vector")))
    usable = usable.select(F.col("vec_id").cast("bigint"), F.struct(F.col("label").cast("bigint").alias("label"), F.col("vector").cast("array<double>").alias("vector"), anchor.alias("anchor")).alias("row"))
    points = cut(usable.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*"))
    tree = tiles(points, options)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v.values).tobytes() for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.binary())], names=["query", "label", "vector"])

    anchors = cut(points.where("anchor").select("vec_id", "label", "vector").mapInArrow(packed, "query bigint, label bigint, vector binary"))
    all_scores = [F.array(F.lit(x).cast("bigint")).alias(n) for x, n in ((-(2**63), "lows"), (2**63 - 1, "highs"))]
    near = cut(search(tree, anchors.select("*", *all_scores), True, options.positives, options))

    def floored(x: Column) -> Column:
        return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))

    per_anchor = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))).alias("positives"))
    score = "positive_score"
    windows = per_anchor.select(
        "query", F.transform("positives", lambda p: -floored(-options.low * p[score])).alias("lows"), F.transform("positives", lambda p: floored(options.high * p[score])).alias("highs")
    )
    far = search(tree, anchors.join(windows, "query"), False, options.negatives, options)
    positives = near.select("query", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.join(positives, ["query", "window"])
    return out.select(
        F.col("query").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
