"""How the sources of a language differ in their words: an index of term counts made in one pass over the texts.

1. A task counts the terms of its documents per (lang, source) in memory. When the postings fill the given memory they
   are written as a run, sorted by shard hash and term, and counting starts anew: the texts are read once, in any amount.
2. The runs are counted, which fixes the number of hash shards. Each shard gets its slice of every run, and a heap
   merges the slices into the frequencies of each term; terms in too few documents of the language go.
3. The probability of a term that a source lacks is the same for all such terms. So the divergence of two sources is
   that of two sources without terms, corrected per source for the terms that it has (a histogram of its
   counts), and per term for the pairs of sources that both have it. The last corrections are streamed term by term
   and summed up inside the task: no pair of sources is listed per term.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabledocs.llm import textscan
from tabledocs.llm.shared import cut

#: letters A-Z as a-z, other letters and all of non-ASCII as they are, the rest as space
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: rough cost in memory of a term of a language besides its bytes, and of a term of a group
_TERM_COST, _POSTING_COST = 170, 110


@dataclass(frozen=True)
class DivergenceOptions:
    """least_documents: of a language, that a kept term occurs in; top: terms listed per group; memory: bytes of postings
    that a task holds before it writes a run; shard: postings of a hash shard, on average; chunk: terms in a row of a run;
    pairs: of sources whose corrections a task holds before it passes them on."""

    least_documents: int = 10
    top: int = 10
    memory: int = 128 << 20
    shard: int = 200_000
    chunk: int = 1 << 14
    pairs: int = 1 << 20


# a block of postings: terms in order of their hashes, the documents that each occurs in, how many sources it has, then
# the sources (as places in `names`) and counts of all terms, one after another
_BLOCK = "lang binary, run string, hash array<bigint>, term array<binary>, docs array<bigint>, n array<int>, source array<int>, count array<bigint>, names array<binary>"
_BLOCK_TYPES = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
_BLOCK_NAMES = ("lang", "run", "hash", "term", "docs", "n", "source", "count", "names")


def _single(values: pa.Array | np.ndarray, kind: pa.DataType) -> pa.Array:
    """One row that holds all values."""
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block(lang: bytes, run: str, lists: list) -> pa.RecordBatch:
    rows = [_single(x, k) for x, k in zip(lists, _BLOCK_TYPES, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([lang], pa.binary()), pa.array([run]), *rows], names=list(_BLOCK_NAMES))


def _run_blocks(lang: bytes, run: str, docs: Counter, counts: dict[bytes, Counter], chunk: int) -> Iterator[pa.RecordBatch]:
    """The postings of one language, in order of term hash and term."""
    terms = list(docs)
    joined = np.frombuffer(b" ".join(terms), np.uint8)
    # no term holds a space, and none but the group's own mark is empty, which is the first
    hashed = textscan.Words(joined, np.array([0, len(joined)])).hashes()
    value = np.concatenate([np.zeros(1, np.uint64), hashed]).view(np.int64)
    order = np.argsort(value, kind="stable")
    if len(terms) > 1 and (np.diff(value[order]) == 0).any():
        order = np.array(sorted(range(len(terms)), key=lambda k: (value[k], terms[k])))
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    place = dict(zip(terms, rank.tolist(), strict=True))
    names = sorted(counts)
    sizes = [len(counts[s]) for s in names]
    at = np.fromiter((place[t] for s in names for t in counts[s]), np.int64, sum(sizes))
    number = np.fromiter((c for s in names for c in counts[s].values()), np.int64, sum(sizes))
    source = np.repeat(np.arange(len(names), dtype=np.int32), sizes)
    by_term = np.argsort(at, kind="stable")
    source, number = source[by_term], number[by_term]
    n = np.bincount(at, minlength=len(terms)).astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(n)])
    with_term = np.fromiter(docs.values(), np.int64, len(terms))[order]
    bytes_of = pa.array(terms, pa.binary()).take(pa.array(order))
    for a in range(0, len(terms), chunk):
        z = min(len(terms), a + chunk)
        used, own = np.unique(source[ends[a] : ends[z]], return_inverse=True)
        yield _block(lang, run, [
            value[order[a:z]], bytes_of.slice(a, z - a), with_term[a:z], n[a:z], own.astype(np.int32), number[ends[a] : ends[z]], pa.array([names[k] for k in used], pa.binary()),
        ])


def runs(docs: DataFrame, options: DivergenceOptions = DivergenceOptions()) -> DataFrame:
    """Term-sorted runs of the texts' postings, in blocks of bounded size.

    A posting with an empty term stands for a group that occurs; no other term is empty.
    """

    def index_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per language: documents of each term, and occurrences of each term per source
        index: dict[bytes, tuple[Counter, dict[bytes, Counter]]] = {}
        held = 0

        def written() -> Iterator[pa.RecordBatch]:
            run = uuid.uuid4().hex
            for lang, (with_term, counts) in index.items():
                yield from _run_blocks(lang, run, with_term, counts, options.chunk)

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                lang, source, text = (value.as_py() or b"" for value in row)
                with_term, counts = index.setdefault(lang, (Counter({b"": 0}), {}))
                if source not in counts:
                    counts[source] = Counter({b"": 0})
                    held += _TERM_COST + len(lang) + len(source)
                terms = text.translate(_TERM_BYTES).split()
                own = set(terms)
                new = [t for t in own if t not in with_term]
                held += len(new) * _TERM_COST + sum(map(len, new)) - len(counts[source]) * _POSTING_COST
                with_term.update(own)
                counts[source].update(terms)
                held += len(counts[source]) * _POSTING_COST
                if held > options.memory:
                    yield from written()
                    index.clear()
                    held = 0
        yield from written()

    # as binary: a text that is no valid UTF-8 is read as its bytes are
    texts = docs.select(*[F.col(f"`{c}`").cast("string").cast("binary").alias(c) for c in ("lang", "source", "text")])
    return texts.mapInArrow(index_texts, _BLOCK)


def _lists(batch: pa.RecordBatch | pa.Table, row: int) -> list[pa.Array]:
    return [batch.column(name)[row].values for name in _BLOCK_NAMES[2:]]


def _slices(stored: DataFrame, shards: int) -> DataFrame:
    """The blocks cut at the borders of hash shards."""

    def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lang, run = batch.column("lang")[row].as_py(), batch.column("run")[row].as_py()
                hashed, term, docs, n, source, count, names = _lists(batch, row)
                # the high 31 bits, in the order of the signed hash
                shard = ((hashed.to_numpy() >> 33) + (1 << 30)) * shards >> 31
                starts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
                ends = np.concatenate([[0], np.cumsum(n.to_numpy())])
                codes = source.to_numpy()
                for a, z in zip(starts, [*starts[1:], len(shard)], strict=True):
                    low, high = int(ends[a]), int(ends[z])
                    used, own = np.unique(codes[low:high], return_inverse=True)
                    lists = [hashed.slice(a, z - a), term.slice(a, z - a), docs.slice(a, z - a), n.slice(a, z - a), own.astype(np.int32), count.slice(low, high - low), names.take(pa.array(used))]
                    block = _block(lang, run, lists)
                    yield pa.RecordBatch.from_arrays([pa.array([shard[a]], pa.int64()), *block.columns], names=["shard", *_BLOCK_NAMES])

    return stored.mapInArrow(cut_blocks, "shard bigint, " + _BLOCK)


def frequencies(stored: DataFrame, options: DivergenceOptions = DivergenceOptions()) -> DataFrame:
    """(lang, term, total, sources, counts) of the kept terms, merged from the runs shard by shard; the empty term has the groups."""
    size = stored.agg(F.sum(F.size("source").cast("bigint"))).head()[0] or 0
    shards = min(1 << 31, max(1, -(-size // options.shard)))

    def merged(table: pa.Table) -> pa.RecordBatch:
        """The frequencies of one language in one shard, whose rows are sorted by run and, in a run, by their first terms."""
        blocks = [_lists(table, row) for row in range(table.num_rows)]
        hashed, docs, n, count = (np.concatenate([b[k].to_numpy() for b in blocks]) for k in (0, 2, 3, 5))
        term = pa.concat_arrays([b[1] for b in blocks])
        names = sorted({x for b in blocks for x in b[6].to_pylist()})
        place = {x: k for k, x in enumerate(names)}
        source = np.concatenate([np.array([place[x] for x in b[6].to_pylist()], np.int64)[b[4].to_numpy()] for b in blocks])

        run = table.column("run").combine_chunks().dictionary_encode().indices.to_numpy()
        ends = np.cumsum([len(b[0]) for b in blocks])
        borders = [0, *ends[:-1][np.diff(run) != 0].tolist(), len(hashed)]
        whole, terms = hashed.tolist(), term.to_pylist()
        order = np.fromiter((p[2] for p in heapq.merge(*(zip(whole[a:z], terms[a:z], range(a, z), strict=True) for a, z in pairwise(borders)))), np.int64, len(whole))

        begins = np.ones(len(order), bool)
        term = term.take(pa.array(order))
        if len(order) > 1:
            begins[1:] = (np.diff(hashed[order]) != 0) | pa.compute.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(begins)
        kept = np.add.reduceat(docs[order], first) >= options.least_documents
        kept |= pa.compute.equal(term.take(pa.array(first)), b"").to_numpy(zero_copy_only=False)
        # the postings of the kept terms, source by source
        number = np.repeat(np.cumsum(begins) - 1, n[order])
        size = n[order].astype(np.int64)
        at = np.repeat((np.cumsum(n.astype(np.int64)) - n)[order] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        chosen = kept[number]
        key, same = np.unique(number[chosen] * len(names) + source[at[chosen]], return_inverse=True)
        counts = np.zeros(len(key), np.int64)
        np.add.at(counts, same, count[at[chosen]])
        own, which = np.divmod(key, max(1, len(names)))
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        offsets = pa.array(np.append(starts, len(own)), pa.int32())
        lang = pa.array([table.column("lang")[0].as_py()] * len(starts), pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                lang, term.take(pa.array(first[kept])), pa.array(np.add.reduceat(counts, starts) if len(starts) else counts),
                pa.ListArray.from_arrays(offsets, pa.array(names, pa.binary()).take(pa.array(which))), pa.ListArray.from_arrays(offsets, pa.array(counts)),
            ],
            names=["lang", "term", "total", "sources", "counts"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        at = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for row, key in enumerate(zip(table.column("shard").to_pylist(), table.column("lang").to_pylist(), strict=True)):
                if held and key != at:
                    yield merged(pa.concat_tables(held))
                    held = []
                at = key
                held.append(table.slice(row, 1))
        if held:
            yield merged(pa.concat_tables(held))

    dealt = _slices(stored, shards).repartition("shard").sortWithinPartitions("shard", "lang", "run", F.element_at("hash", 1), F.element_at("term", 1))
    found = dealt.mapInArrow(merge, "lang binary, term binary, total bigint, sources array<binary>, counts array<bigint>")
    text = [F.col(c).cast("string").alias(c) for c in ("lang", "term")]
    return found.select(*text, "total", F.transform("sources", lambda s: s.cast("string")).alias("sources"), "counts")


def _div(a: Column, b: Column) -> Column:
    """The whole quotient, exact."""
    return F.call_function("div", a, b)


def _probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), through decimals because the product may leave 64 bits; null without terms."""
    over, under = (x.cast("decimal(20,0)") for x in (count + 2, total + 2 * terms))
    return F.when(terms > 0, 1 + _div(over * F.lit(10**9).cast("decimal(10,0)"), under))


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)): both are at most 10^9 + 1, so the square fits 64 bits."""
    return _div((p - q) * (p - q), p + q)


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _both_have(entries: DataFrame, options: DivergenceOptions) -> DataFrame:
    """(lang, one, other, value), summed up per task: what terms that both sources have change, against each having them alone.

    entries: (lang, term, source, p, none), `none` the probability of a term that the source lacks. `one` is less than
    `other` by their UTF-8 bytes.
    """

    def rows(sums: dict, names: list) -> pa.RecordBatch:
        keys = list(sums)
        columns = ([names[k[0]][0] for k in keys], [names[k[0]][1] for k in keys], [names[k[1]][1] for k in keys])
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.binary()) for c in columns), pa.array(list(sums.values()), pa.int64())], names=["lang", "one", "other", "value"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        names: list = []
        sums: dict = {}

        def add(table: pa.Table) -> None:
            """All entries of some terms, in order of language, term and source."""
            coded = [table.column(c).combine_chunks().dictionary_encode() for c in ("lang", "term", "source")]
            lang, term, source = (c.indices.to_numpy().astype(np.int64) for c in coded)
            pairs, where = np.unique(lang * (len(coded[2].dictionary) + 1) + source, return_inverse=True)
            own = []
            for pair in pairs.tolist():
                name = tuple(c.dictionary[k].as_py() for c, k in zip((coded[0], coded[2]), divmod(pair, len(coded[2].dictionary) + 1), strict=True))
                if name not in groups:
                    groups[name] = len(names)
                    names.append(name)
                own.append(groups[name])
            group = np.array(own, np.int64)[where]
            p, none = (table.column(c).to_numpy() for c in ("p", "none"))
            begins = (np.diff(lang, prepend=-1) != 0) | (np.diff(term, prepend=-1) != 0)
            number = np.cumsum(begins)
            # entries that are `step` apart in one term, for each step there is
            at = np.arange(len(group))
            step = 1
            while len(at := at[at + step < len(group)]) and len(at := at[number[at] == number[at + step]]):
                i, j = at, at + step
                value = _distances(p[i], p[j]) - _distances(p[i], none[j]) - _distances(none[i], p[j]) + _distances(none[i], none[j])
                key, place = np.unique(group[i] << 32 | group[j], return_inverse=True)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, place, value)
                for k, v in zip(key.tolist(), total.tolist(), strict=True):
                    pair = (k >> 32, k & 0xFFFFFFFF)
                    sums[pair] = sums.get(pair, 0) + v
                step += 1

        kept = None  # the last term may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            if not table.num_rows:
                continue
            last = np.logical_and(*(pa.compute.equal(table.column(c), table.column(c)[-1]).to_numpy() for c in ("lang", "term")))
            stop = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            kept = table.slice(stop)
            if stop:
                add(table.slice(0, stop))
            if len(sums) > options.pairs:
                yield rows(sums, names)
                sums.clear()
        if kept is not None:
            add(kept)
        if sums:
            yield rows(sums, names)

    columns = [F.col(c).cast("binary").alias(c) for c in ("lang", "term", "source")]
    dealt = entries.select(*columns, "p", "none").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    found = dealt.mapInArrow(stream, "lang binary, one binary, other binary, value bigint")
    return found.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "one", "other")], "value")


def source_divergence(docs: DataFrame, options: DivergenceOptions = DivergenceOptions()) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of `docs` (lang, source, text).

    Terms are runs of letters A-Z, a-z and non-ASCII characters, A-Z counted as a-z. A language keeps the terms in at least
    `least_documents` of its documents. A group, and the language as a whole, gives each kept term the probability
    p = 1 + floor(10^9 (count + 2) / (N + 2 V)), V being the kept terms and N their occurrences. The distance of two
    probabilities is floor((p - q)^2 / (p + q)).

    Part `pair`: for each other source of the language the distances of all kept terms, summed (0 where no term is kept).
    Part `term`: the terms of the group that are likelier there than in the language, with their distance to it; the first `top`.
    Ranks are by value, descending, then by the item's UTF-8 bytes.

    Null lang, source and text are empty ones. A row is a document: repeated rows count as often as they occur. An empty table gives
    no rows; a language with one source no pairs. Other columns are ignored.
    """
    found = cut(frequencies(cut(runs(docs, options)), options))
    each = found.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("s"))
    each = each.select("lang", "term", "total", F.col("s.sources").alias("source"), F.col("s.counts").alias("count"))
    terms = found.where("term <> ''").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("everywhere"))
    # the empty term stands for the group itself, with no occurrence
    groups = each.groupBy("lang", "source").agg(F.sum("count").alias("size")).join(terms, "lang", "left")
    groups = groups.withColumn("terms", F.coalesce("terms", F.lit(0))).withColumn("none", _probability(F.lit(0), F.col("size"), F.col("terms")))
    groups = cut(groups)

    entries = each.where("term <> ''").join(groups, ["lang", "source"])
    entries = entries.withColumn("p", _probability(F.col("count"), F.col("size"), F.col("terms")))
    entries = cut(entries.withColumn("q", _probability(F.col("total"), F.col("everywhere"), F.col("terms"))).select("lang", "source", "term", "p", "q", "none"))

    one, other = (groups.select("lang", F.col("source").alias(s), F.col("none").alias(f"{s}_none"), "terms") for s in ("one", "other"))
    f = _distance
    base = one.join(other.drop("terms"), "lang").where("one < other")
    base = base.select("lang", "one", "other", F.coalesce(F.col("terms") * f(F.col("one_none"), F.col("other_none")), F.lit(0)).alias("value"))
    # the terms of one source alone, by probability: as many as occur, not as many as there are terms
    alone = entries.groupBy("lang", "source", "p", "none").count()
    alone = alone.join(other.drop("terms"), "lang").where("source <> other")
    alone = alone.withColumn("value", F.col("count") * (f(F.col("p"), F.col("other_none")) - f(F.col("none"), F.col("other_none"))))
    alone = alone.select("lang", F.least("source", "other").alias("one"), F.greatest("source", "other").alias("other"), "value")
    sums = base.unionByName(alone).unionByName(_both_have(entries, options)).groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    sums = cut(sums)
    pairs = sums.select("lang", F.col("one").alias("source"), F.lit("pair").alias("part"), F.col("other").alias("item"), "value").unionByName(
        sums.select("lang", F.col("other").alias("source"), F.lit("pair").alias("part"), F.col("one").alias("item"), "value")
    )
    likelier = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), f(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(likelier.withColumn("rank", rank).where(F.col("rank") <= options.top))
