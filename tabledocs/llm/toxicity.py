"""Toxicity scores by a classifier that treats groups alike.

Logistic regression on the words of a text and on their beginnings. Besides the
usual loss there is a counterfactual one: in sentences of the labelled texts each
identity term is swapped for the others of its group, and the squared
change of the score's log-odds is penalised. So a neutral mention of a group, which
happens to be frequent in toxic texts, does not make a text toxic.

The model is fitted on a bounded sample of labelled rows: `per_class` of each class,
the least by a hash of doc_id. Everything else covers all rows; scoring is one pass
without shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabledocs.llm import textscan
from tabledocs.llm.shared import cut

#: Terms that may stand for each other, by group.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("women", "men"),
    ("woman", "man"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
)
_BEGINNINGS = (None, 4, 5, 7)
#: a feature that makes up so large a share of a text's words has its full density
_DENSE = 0.04
_SENTENCE_ENDS = ".!?\n"


@dataclass(frozen=True)
class ToxicityOptions:
    """per_class: labelled rows of each class that the model is fitted on; features: words and beginnings with a weight;
    least_texts: a feature occurs in so many sampled texts; decay: L2 penalty; fairness: weight of the counterfactual penalty;
    sentences: those with identity terms that are taken of each sampled text; steps: of gradient descent."""

    per_class: int = 4000
    features: int = 1024
    least_texts: int = 5
    decay: float = 1e-4
    fairness: float = 1.0
    sentences: int = 4
    steps: int = 500
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


@dataclass
class ToxicityModel:
    """keys: sorted hashes of the features; weights: of their presence, then of their density; bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of doc_id as text is a multiple of 5; a row without doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("bigint").cast("string")) % 5 == 0, F.lit(False))


def _features(words: textscan.Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature): each word and its beginnings; may repeat."""
    hashes = [words.hashes(k) for k in _BEGINNINGS]
    return np.tile(words.document, len(hashes)), np.concatenate(hashes)


def _known(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the values are keys, their places). A bitmap of the high bits spares most look-ups."""
    seen = np.zeros(1 << 20, bool)
    seen[(keys >> np.uint64(44)).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(values >> np.uint64(44)).astype(np.int64)])
    place = np.searchsorted(keys, values[maybe])
    hit = (place < len(keys)) & (keys[np.minimum(place, len(keys) - 1)] == values[maybe]) if len(keys) else np.zeros(0, bool)
    return maybe[hit], place[hit]


def _values(words: textscan.Words, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, density) of the features in each text: their share of its words, up to 1 for `_DENSE` or more."""
    document, value = _features(words)
    at, place = _known(keys, value)
    pairs, counts = np.unique(document[at].astype(np.int64) * max(1, len(keys)) + place, return_counts=True)
    own, place = np.divmod(pairs, max(1, len(keys)))
    sizes = np.bincount(words.document, minlength=words.documents)
    return own, place, np.minimum(1.0, counts / (_DENSE * np.maximum(sizes[own], 1)))


def _sample(docs: DataFrame, labels: DataFrame, options: ToxicityOptions) -> tuple[DataFrame, float]:
    """(text, toxic) of the sampled rows, and the log-odds of a toxic row among all that may be learned from."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = cut(known)
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [known.where(F.col("toxic") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(options.per_class) for x in (0, 1)]
    # at most 2 * per_class rows
    chosen = F.broadcast(cut(parts[0].unionByName(parts[1])))
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(chosen, "doc_id").select("text", "toxic")
    # an id that repeats must not make the sample larger than stated; a limit leaves one partition, so it is dealt out again
    texts = texts.limit(2 * options.per_class).repartition(32)
    return cut(texts), float(np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)))


def _frequent(sample: DataFrame, options: ToxicityOptions) -> np.ndarray:
    """Hashes of the features that tell the classes apart best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for row, n, words in textscan.slices(batch.column(0)):
                document, value = _features(words)
                label = toxic[row : row + n]
                for x in (0, 1):
                    own = label[document] == x
                    each = np.unique(np.stack([document[own].astype(np.uint64), value[own]]), axis=1)[1]
                    keys, counts = np.unique(each, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), x, np.int32)), pa.array(counts.astype(np.int64))],
                        names=["feature", "toxic", "texts"],
                    )

    counts = sample.mapInArrow(run, "feature bigint, toxic int, texts bigint").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("texts")).otherwise(0)).alias("one"),
        F.sum(F.when(F.col("toxic") == 0, F.col("texts")).otherwise(0)).alias("zero"),
    )
    counts = counts.where(F.col("one") + F.col("zero") >= options.least_texts)
    of = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = F.lit(float(of.get(1, 0) + 1)), F.lit(float(of.get(0, 0) + 1))
    one, zero = F.col("one"), F.col("zero")
    apart = (one / n1 - zero / n0) * (one / n1 - zero / n0) / ((one + zero + 1) / (n1 + n0))
    best = counts.orderBy(apart.desc(), "feature").limit(options.features).select("feature").collect()
    return np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))


def _hash_of(term: str) -> list[np.uint64]:
    """Features of one word."""
    data = np.frombuffer(term.encode(), np.uint8)
    return list(_features(textscan.Words(data, np.array([0, len(data)])))[1])


def swapped_sentences(text: str, options: ToxicityOptions) -> Iterator[tuple[str, str]]:
    """(sentence, the same with one identity term swapped) for all other terms of the term's group."""
    group_of = {t: g for g in options.terms for t in g}
    for end in _SENTENCE_ENDS:
        text = text.replace(end, "\n")
    left = options.sentences
    for sentence in text.split("\n"):
        words = sentence.split()
        marked = [(k, w) for k, w in enumerate(words) if w.lower().strip(",;:\"'()") in group_of]
        if marked and left:
            left -= 1
            for k, word in marked:
                term = word.lower().strip(",;:\"'()")
                for other in group_of[term]:
                    if other != term:
                        yield sentence, " ".join([*words[:k], other, *words[k + 1 :]])


def fit(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> ToxicityModel:
    """The model. Without rows of both classes it knows only how frequent toxic rows are."""
    sample, prior = _sample(docs, labels, options)
    keys = _frequent(sample, options)
    named = [h for group in options.terms for t in group for h in _hash_of(t)]
    keys = np.unique(np.concatenate([keys, np.array(named, np.uint64)]))
    size = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def described(texts: list[str]) -> list[list[tuple[int, float]]]:
            out: list[list[tuple[int, float]]] = [[] for _ in texts]
            for row, _, words in textscan.slices(pa.array(texts, pa.large_string())):
                for d, f, x in zip(*_values(words, keys), strict=True):
                    out[row + d].append((int(f), float(x)))
            return out

        def record(toxic: pa.Array, signs: list[list[tuple[int, list[tuple[int, float]]]]]) -> pa.RecordBatch:
            places = [[f for _, part in row for f, _ in part] for row in signs]
            values = [[sign * x for sign, part in row for _, x in part] for row in signs]
            ones = [[float(sign) for sign, part in row for _ in part] for row in signs]
            kinds = pa.list_(pa.int32()), pa.list_(pa.float32()), pa.list_(pa.float32())
            arrays = [pa.array(x, kind) for x, kind in zip((places, ones, values), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([toxic, *arrays], names=["toxic", "places", "presence", "density"])

        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            yield record(batch.column(1), [[(1, x)] for x in described(texts)])
            pairs = [p for t in texts for p in swapped_sentences(t, options)]
            here, there = (described([p[k] for p in pairs]) for k in (0, 1))
            yield record(pa.nulls(len(pairs), pa.int32()), [[(1, a), (-1, b)] for a, b in zip(here, there, strict=True)])

    # bounded by the sample and its sentences
    table = sample.mapInArrow(run, "toxic int, places array<int>, presence array<float>, density array<float>").toArrow()
    label = table.column("toxic")
    texts, swaps = table.filter(label.is_valid()), table.filter(label.is_null())
    toxic = texts.column("toxic").to_numpy().astype(float)
    weights, bias = _descend(_matrix(texts, size), toxic, _matrix(swaps, size), 2 * size, options)
    share = toxic.mean() if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return ToxicityModel(keys, np.zeros(2 * size), prior)
    # the classes were sampled apart; the bias is set back to their true shares
    return ToxicityModel(keys, weights, float(bias + prior - np.log(share / (1 - share))))


def _matrix(rows: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows, columns and values of the entries, and the number of rows."""
    rows = rows.combine_chunks()
    places, presence, density = (rows.column(x).combine_chunks() for x in ("places", "presence", "density"))
    row = np.repeat(np.arange(len(rows)), places.value_lengths().to_numpy(zero_copy_only=False))
    place = places.flatten().to_numpy().astype(np.int64)
    values = np.concatenate([presence.flatten().to_numpy(), density.flatten().to_numpy()]).astype(float)
    return np.tile(row, 2), np.concatenate([place, place + size]), values, len(rows)


def _descend(texts: tuple, toxic: np.ndarray, swaps: tuple, size: int, options: ToxicityOptions) -> tuple[np.ndarray, float]:
    """Weights and bias at the least of log loss, L2 and counterfactual penalty, by Adam."""
    weights, bias = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    row, column, value, n = texts
    srow, scolumn, svalue, pairs = swaps
    for step in range(1, options.steps + 1 if n else 1):
        odds = np.bincount(row, value * weights[column], n) + bias
        error = (1 / (1 + np.exp(-odds)) - toxic) / n
        gradient = np.append(np.bincount(column, value * error[row], size) + options.decay * weights, error.sum())
        if pairs:
            change = np.bincount(srow, svalue * weights[scolumn], pairs)
            gradient[:-1] += options.fairness * np.bincount(scolumn, 2 * svalue * change[srow] / pairs, size)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs` (doc_id, text).

    A null or empty text gets the score of a text without known words. Rows that repeat a doc_id or have none are scored alike; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for _, n, words in textscan.slices(batch.column(1)):
                own, place, density = _values(words, model.keys)
                weight = model.weights[place] + density * model.weights[place + len(model.keys)]
                scores.append(np.bincount(own, weight, n) + model.bias)
            odds = np.clip(np.concatenate(scores), -500, 500)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-odds)))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    scored = rows.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> DataFrame:
    """Fits on the labelled rows that are not held out, and scores all of `docs`."""
    return score(docs, fit(docs, labels, options))
