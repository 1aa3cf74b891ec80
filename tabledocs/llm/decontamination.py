"""Benchmark items inside documents, by SimHash fingerprints of item-sized windows.

Windows have as many words as some item. Each window and item has a 64-bit SimHash of its
word shingles, counted by bit planes. Fingerprints are cut into one block more than the
radius, so two that differ in at most `radius` bits agree in some block; windows and items of one size
meet on equal blocks, which therefore finds every pair within the radius. Those pairs are compared exactly by
their shingles, weighted by how often they occur.

A window as similar as asked holds a certain number of shingles of the items of its size. Windows with fewer
are not fingerprinted; that loses nothing, and leaves a few windows around each real passage. All of it
is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabledocs.llm.arrays import total
from tabledocs.llm.shared import BROADCAST_IDS, cut, having, text_of


@dataclass(frozen=True)
class DecontaminationOptions:
    """width: words of a shingle; percent: least similarity of a window and an item, in hundredths; radius: bits in which their fingerprints may differ.

    Windows exactly at 80 percent differ by 10 bits on average and by more than 23 with a probability of about 1e-6.
    """

    width: int = 5
    percent: int = 80
    radius: int = 23


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def _shingles(words: Column, width: int) -> Column:
    """Hashes of all runs of `width` words, in order."""
    places = F.sequence(F.lit(0), F.size(words) - width)
    return F.when(F.size(words) >= width, F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))).otherwise(
        F.array().cast("array<bigint>")
    )


def fingerprint(shingles: Column, planes: int) -> Column:
    """The bits that are set in more than half of the shingles. planes: binary digits of their number, at most."""
    zero = F.lit(0).cast("bigint")

    def add(sums: Column, shingle: Column) -> Column:
        carry, out = shingle, []
        for k in range(planes):
            plane = sums[f"p{k}"]
            out.append(plane.bitwiseXOR(carry).alias(f"p{k}"))
            carry = plane.bitwiseAND(carry)
        return F.struct(*out)

    def majority(sums: Column) -> Column:
        # for all 64 places at once: is the number in the planes at least half the shingles and one more
        least = F.floor(F.size(shingles) / 2).cast("bigint") + 1
        above, equal = zero, F.lit(-1).cast("bigint")
        for k in reversed(range(planes)):
            digit = -F.shiftright(least, k).bitwiseAND(F.lit(1).cast("bigint"))
            plane = sums[f"p{k}"]
            above = above.bitwiseOR(equal.bitwiseAND(plane).bitwiseAND(F.bitwise_not(digit)))
            equal = equal.bitwiseAND(F.bitwise_not(plane.bitwiseXOR(digit)))
        return above.bitwiseOR(equal)

    return F.aggregate(shingles, F.struct(*[zero.alias(f"p{k}") for k in range(planes)]), add, majority)


def blocks(bits: Column, radius: int) -> Column:
    """The fingerprint in radius + 1 blocks, of sizes as equal as can be."""
    borders = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *[F.shiftrightunsigned(bits, a).bitwiseAND(F.lit((1 << (z - a)) - 1).cast("bigint")) for a, z in zip(borders, borders[1:], strict=False)]
    )


def _common(left: Column, right: Column) -> Column:
    """Shingles in common, each as often as in the one that has it less often."""
    plain = (F.size(F.array_distinct(left)) == F.size(left)) & (F.size(F.array_distinct(right)) == F.size(right))

    def count(values: Column, x: Column) -> Column:
        return F.size(F.filter(values, lambda y: y == x)).cast("bigint")

    return F.when(plain, F.size(F.array_intersect(left, right)).cast("bigint")).otherwise(
        total(F.transform(F.array_distinct(right), lambda x: F.least(count(left, x), count(right, x))))
    )


def _few(rows: DataFrame) -> DataFrame:
    """Marked for broadcast where a count says that it is small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS // 10 else rows


def _digested(docs: DataFrame) -> DataFrame:
    """(doc_id, text, digest, chars): equal texts share digest and chars."""
    text = text_of(F.col("text"))
    return docs.select("doc_id", text.alias("text")).select("doc_id", "text", F.xxhash64("text").alias("digest"), F.length("text").alias("chars"))


def _passages(texts: DataFrame, items: DataFrame, width: int, options: DecontaminationOptions) -> DataFrame:
    """(digest, chars, item_id, start, words, hamming, common, size) of the items whose shingles have `width` words."""
    items = cut(items.where(F.col("width") == width).select("item_id", _shingles(F.col("words"), width).alias("item")).withColumn("size", F.size("item")))
    sizes = items.agg(F.max("size").alias("size")).head()["size"] or 1
    planes = int(sizes).bit_length()
    items = items.withColumn("mark", fingerprint(F.col("item"), planes))

    # where a text has shingles of items, by the size of the items
    known = cut(items.select(F.explode("item").alias("shingle"), "size").distinct())
    shingled = texts.withColumn("words", _words(F.col("text"))).select("digest", "chars", _shingles(F.col("words"), width).alias("shingles"))
    # the outer form keeps the optimizer from evaluating all shingles a second time to see whether there are any
    found = shingled.select("digest", "chars", F.posexplode_outer("shingles").alias("place", "shingle"))
    found = found.join(_few(known), "shingle")
    need = F.ceil(F.col("size") * (2 * options.percent) / (100 + options.percent)).cast("int")
    found = found.groupBy("digest", "chars", "size").agg(F.sort_array(F.collect_set("place")).alias("places")).withColumn("need", need)
    # a window that begins in [low, place j] holds the `need` places from j on
    ranges = F.transform(
        "places",
        lambda p, j: F.struct(F.greatest(F.get("places", j + F.col("need") - 1) - F.col("size") + 1, F.coalesce(F.get("places", j - 1) + 1, F.lit(0))).alias("low"), p.alias("high")),
    )
    ranges = F.filter(ranges, lambda r: F.coalesce(r["low"] <= r["high"], F.lit(False)))
    starts = F.flatten(F.transform(ranges, lambda r: F.sequence(r["low"], r["high"])))
    found = found.withColumn("starts", starts).where(F.size("starts") > 0).select("digest", "chars", "size", "starts")
    found = cut(found)

    hit = having(texts, cut(found.select("digest").distinct()), "digest").dropDuplicates(["digest", "chars"])
    hit = hit.withColumn("words", _words(F.col("text"))).select("digest", "chars", _shingles(F.col("words"), width).alias("shingles"))
    windows = found.join(hit, ["digest", "chars"]).withColumn("start", F.explode("starts")).where(F.col("start") + F.col("size") <= F.size("shingles"))
    windows = windows.select("digest", "chars", "size", "start", F.slice("shingles", F.col("start") + 1, F.col("size")).alias("window"))
    windows = windows.withColumn("own", fingerprint(F.col("window"), planes))

    cells = windows.withColumn("cells", blocks(F.col("own"), options.radius))
    cells = cells.select("digest", "chars", "size", "start", "window", "own", "cells", F.posexplode("cells").alias("block", "bits"))
    marks = items.withColumn("item_cells", blocks(F.col("mark"), options.radius))
    marks = marks.select("item_id", "item", "mark", "size", "item_cells", F.posexplode("item_cells").alias("block", "bits"))
    met = cells.join(_few(cut(marks)), ["size", "block", "bits"])
    # a pair counts at the first block in which it agrees
    first = F.array_position(F.zip_with("cells", "item_cells", lambda a, b: a == b), True)
    met = met.where(first == F.col("block") + 1).withColumn("hamming", F.bit_count(F.col("own").bitwiseXOR(F.col("mark"))))
    met = met.where(F.col("hamming") <= options.radius).withColumn("common", _common(F.col("window"), F.col("item")))
    met = met.where((100 + options.percent) * F.col("common") >= 2 * options.percent * F.col("size"))
    return met.select("digest", "chars", "item_id", "start", (F.col("size") + width - 1).alias("words"), "hamming", "common", "size")


def _found(docs: DataFrame, benchmark: DataFrame, options: DecontaminationOptions) -> DataFrame:
    """The best window of each item in each text: (digest, chars, item_id, best)."""
    items = benchmark.select("item_id", _words(text_of(F.col("text"))).alias("words")).where(F.size("words") > 0)
    items = cut(items.withColumn("width", F.least(F.size("words"), F.lit(options.width))))
    texts = _digested(docs).where(F.length("text") > 0).drop("doc_id")
    widths = [r["width"] for r in items.select("width").distinct().collect()]
    parts = [_passages(texts, items, w, options) for w in sorted(widths)]
    if not parts:
        empty = "struct<similarity:double,hamming:bigint,start:bigint,words:bigint>"
        return texts.select("digest", "chars", F.lit(0).cast("bigint").alias("item_id"), F.lit(None).cast(empty).alias("best")).where("false")
    # the most similar, then the nearest fingerprint, then the first
    similarity = F.col("common") / (2 * F.col("size") - F.col("common"))
    best = F.max(F.struct(similarity.alias("similarity"), (-F.col("hamming")).alias("hamming"), (-F.col("start")).alias("start"), "words"))
    return reduce(DataFrame.unionByName, parts).groupBy("digest", "chars", "item_id").agg(best.alias("best"))


def contamination(docs: DataFrame, benchmark: DataFrame, options: DecontaminationOptions = DecontaminationOptions()) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): each item of `benchmark` (item_id, text) that a row of `docs` (doc_id, text) holds, with its best window.

    Null and empty texts hold nothing and are no items. Items shorter than a shingle are looked for as a whole. Repeated rows are reported each; repeated
    items once. Rows without doc_id are reported without it. Other columns are ignored.
    """
    found = cut(_found(docs, benchmark, options))
    rows = _digested(docs).drop("text").join(_few(found), ["digest", "chars"])
    best = F.col("best")
    return rows.select(
        "doc_id", "item_id", (-best["start"]).cast("bigint").alias("start_word"), best["words"].cast("bigint").alias("n_words"),
        (-best["hamming"]).cast("bigint").alias("hamming"), best["similarity"].alias("similarity"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, options: DecontaminationOptions = DecontaminationOptions()) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns."""
    found = cut(_found(docs, benchmark, options).select("digest", "chars").distinct())
    text = text_of(F.col("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(text).alias("digest"), F.length(text).alias("chars"))
    return rows.join(_few(found), ["digest", "chars"], "left_anti").select("row.*")
