"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard similarity.

Two permutations make the whole signature. The first, a bijection of 64-bit
shingle hashes, sends each shingle to a slot. The second is a random order of
the slots that is shifted by one, two, three, ... places around the circle:
coordinate k of a document is the least place among its slots in the order
shifted by k. In memory a shingle's places under all shifts stand side by
side, so a signature is the minimum of a few contiguous stretches.

From the signatures:

1. documents with equal shingle sets become one representative;
2. every band of coordinates is a bucket; each member is compared exactly with
   one leading member, which joins large groups without listing pairs;
3. buckets that still hold several components are opened: their members meet in
   blocks of bounded size, where longer signatures keep only pairs that may pass,
   and these pairs are compared exactly. Every pair of different components that
   shares a bucket is covered.

A pair at the threshold 0.85 shares none of the 25 bands of 5 with a probability
of 4e-7; the longer signature errs by over five standard deviations for as few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabledocs.llm import textscan
from tabledocs.llm.links import components
from tabledocs.llm.shared import BROADCAST_IDS, cut, having

#: slots of the circle
SLOTS = 1 << 20
_FIRST = np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class NearCopyOptions:
    """width: words of a shingle; percent: least Jaccard similarity, in hundredths; bands of `rows` coordinates each;
    sketch: coordinates (one byte each) by which pairs in mixed buckets are screened, `slack` below the threshold;
    block: members of a bucket that meet others in one step."""

    width: int = 5
    percent: int = 85
    bands: int = 25
    rows: int = 5
    sketch: int = 1024
    slack: float = 0.055
    block: int = 256


class Circle:
    """Signatures of shingle sets: the two permutations."""

    def __init__(self, length: int) -> None:
        order = np.random.default_rng(11).permutation(SLOTS).astype(np.uint32)
        self.length = length
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:length]]), length)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        slots = (textscan.mixed(shingles ^ _FIRST) >> np.uint64(44)).astype(np.int64)
        least = np.full(self.length, 2**32 - 1, np.uint32)
        for k in range(0, len(slots), 2048):
            np.minimum(least, self.shifted[slots[k : k + 2048]].min(axis=0), out=least)
        return least


def signatures(docs: DataFrame, options: NearCopyOptions) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands): one row per row of `docs`; no bands for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circle = Circle(options.bands * options.rows)
        number = np.arange(1, options.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            for row, n, words in textscan.slices(batch.column(1)):
                sets = [shingles for shingles, _ in words.shingles(options.width)]
                bands = []
                for shingles in sets:
                    key = number[:0]
                    if len(shingles):
                        key = number.copy()
                        for column in circle.signature(shingles).reshape(options.bands, options.rows).T:
                            key = textscan.mixed(key ^ column)
                    bands.append(key)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(map(len, sets), pa.int64()), *textscan.set_digests(sets), textscan.list_array(bands)],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )

    schema = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def _shingle_sets(docs: DataFrame, options: NearCopyOptions) -> DataFrame:
    """(n_shingles, set_a, set_b, shingles, sketch) of every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circle = Circle(options.sketch)
        for batch in batches:
            for _, _, words in textscan.slices(batch.column(0)):
                sets = [shingles for shingles, _ in words.shingles(options.width)]
                sketches = pa.array([circle.signature(x).astype(np.uint8).tobytes() for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(len, sets), pa.int64()), *textscan.set_digests(sets), textscan.list_array(sets), sketches],
                    names=["n_shingles", "set_a", "set_b", "shingles", "sketch"],
                )

    return docs.select("text").mapInArrow(run, "n_shingles bigint, set_a bigint, set_b bigint, shingles array<bigint>, sketch binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, options: NearCopyOptions) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough."""
    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    sizes = F.size("set_a") + F.size("set_b")
    return both.where(
        # the smaller set is at most all of the intersection
        100 * F.least(F.size("set_a"), F.size("set_b")) >= options.percent * F.greatest(F.size("set_a"), F.size("set_b"))
    ).where(
        (100 + options.percent) * F.size(F.array_intersect("set_a", "set_b")) >= options.percent * sizes
    ).select("a", "b")


def _across(mixed: DataFrame, options: NearCopyOptions) -> DataFrame:
    """Pairs (a, b) of different components in one bucket that may be similar enough.

    mixed: (bucket, members, node, component, bands, sketch). A bucket's members
    are dealt into blocks; each pair of blocks is one group of at most about two blocks,
    so that no task holds a bucket whole. A pair is listed only in the first
    bucket that it shares.
    """
    blocks = F.ceil(F.col("members") / options.block).cast("int")
    dealt = mixed.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own",
        "node", "component", "bands", "sketch",
    )
    least = (options.percent / 100 - options.slack) * options.sketch

    def compare(bucket: int, own: np.ndarray, node: np.ndarray, component: np.ndarray, bands: np.ndarray, sketch: np.ndarray):
        low, high = own.min(), own.max()
        for i in range(len(node)):
            later = np.arange(i + 1, len(node)) if low == high else np.flatnonzero((own == high) & (own[i] == low))
            later = later[component[later] != component[i]]
            if len(later):
                shared = bands[later] == bands[i]
                later = later[bands[i][shared.argmax(axis=1)] == bucket]
            if len(later):
                later = later[(sketch[later] == sketch[i]).sum(axis=1) >= least]
            for j in later:
                yield node[i], node[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(table: pa.Table) -> pa.RecordBatch:
            key = np.stack([table.column(k).to_numpy() for k in (0, 1, 2)])
            starts = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
            own, node, component = (table.column(k).to_numpy() for k in (3, 4, 5))
            bands = table.column(6).combine_chunks().flatten().to_numpy().reshape(len(node), options.bands)
            sketch = np.frombuffer(b"".join(table.column(7).to_pylist()), np.uint8).reshape(len(node), options.sketch)
            found = []
            for a, z in zip(starts, [*starts[1:], len(node)], strict=True):
                # of two blocks, rows of both are needed
                if z - a > 1 and (key[1, a] == key[2, a] or own[a:z].min() != own[a:z].max()):
                    found += compare(key[0, a], own[a:z], node[a:z], component[a:z], bands[a:z], sketch[a:z])
            found = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(found.min(axis=1, initial=2**63 - 1)), pa.array(found.max(axis=1, initial=-(2**63)))], names=["a", "b"])

        kept = None  # the last group may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            if table.num_rows == 0:
                continue
            last = np.ones(table.num_rows, bool)
            for k in (0, 1, 2):
                column = table.column(k).to_numpy()
                last &= column == column[-1]
            stop = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            kept = table.slice(stop)
            if stop:
                yield pairs(table.slice(0, stop))
        if kept is not None:
            yield pairs(kept)

    rows = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def near_copies(docs: DataFrame, options: NearCopyOptions = NearCopyOptions()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id that can be reached over links, the row's own included; kept says that it is the
    row's own. Empty and null texts have no shingles and no links, and are kept. Rows that
    repeat a doc_id are linked by their texts only. A row without doc_id is kept; it has a component_id only if a text equal
    to its own has one. Other columns are ignored.
    """
    whole_set = ["n_shingles", "set_a", "set_b"]
    signed = cut(signatures(docs, options))
    grouped = signed.where("n_shingles > 0").groupBy(*whole_set).agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    nodes = cut(grouped.withColumn("node", F.monotonically_increasing_id()))
    buckets = nodes.where("doc_id is not null").select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    members = cut(buckets.join(shared, "bucket"))

    involved = nodes.drop("bands").join(members.select("node").distinct(), "node")
    texts = having(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), cut(involved.select("doc_id").distinct()), "doc_id")
    sets = _shingle_sets(texts, options).dropDuplicates(whole_set)
    sets = cut(sets.join(involved.drop("doc_id"), whole_set).select("node", "shingles", "sketch"))

    # the member that meets most others leads: a text that was copied with changes is nearer to each copy than they are to each other
    met = members.groupBy("node").agg(F.sum("members").alias("met"))
    leads = members.join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", "node")).alias("lead"))
    led = members.join(leads.select("bucket", F.col("lead.node").alias("hub")), "bucket").where("node <> hub")
    stars = led.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    labels = components(cut(_confirmed(stars, sets, options)))

    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = cut(labelled)
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    mixed = labelled.join(mixed.select("bucket"), "bucket", "left_semi")
    detail = nodes.select("node", "bands").join(sets.select("node", "sketch"), "node")
    across = cut(_across(mixed.join(detail, "node"), options))
    more = _confirmed(across, sets, options)

    # these links join components, so their own components come on top
    one, other = (labels.select(F.col("node").alias(x), F.col("component").alias(f"{x}_to")) for x in "ab")
    lifted = more.join(one, "a", "left").join(other, "b", "left").select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
    above = components(cut(lifted)).select(F.col("node").alias("component"), F.col("component").alias("top"))
    known = nodes.drop("bands").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = cut(known.join(above, "component", "left").withColumn("component", F.coalesce("top", "component")).drop("top", "node"))
    smallest = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = known.drop("doc_id").join(smallest, "component").drop("component")

    rows = signed.drop("bands").join(known, whole_set, "left")
    component = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def without_near_copies(docs: DataFrame, options: NearCopyOptions = NearCopyOptions()) -> DataFrame:
    """The rows of `docs` that near_copies keeps, with all their columns: of each group the one with the smallest doc_id.

    Rows that share a doc_id stay or go together, and equal texts among them stay once. Rows without doc_id stay.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    judged = cut(near_copies(docs, options).where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")))
    gone = judged.where("not kept").select("doc_id")
    few = gone.count() <= BROADCAST_IDS
    rest = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*own)
    repeated = judged.where("kept and rows > 1").select("doc_id")
    if repeated.isEmpty():
        return rest
    # equal texts of one id meet in a partial aggregate before they move
    single = rest.join(repeated, "doc_id", "left_anti").select(*own)
    return single.unionByName(rest.join(repeated, "doc_id", "left_semi").select(*own).dropDuplicates(["doc_id", "text"]))
