import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from tabledocs.llm.packing import PackingOptions, best_length, pack, packed, packed_tokens
from tabledocs.llm.queries import op7_best_fit_packing
from tabledocs.llm.token_counts import TokenOptions, WordCounter


def test_bins():
    rng = random.Random(7)
    options = PackingOptions(lengths=(16, 64, 32), overhead=4, attention=100)
    for _ in range(50):
        sizes = np.array(sorted((rng.randint(1, 64) for _ in range(rng.randint(0, 80))), reverse=True), np.int64)
        own, place, lengths = pack(sizes, options)
        held = {}
        for k, p, s in zip(own.tolist(), place.tolist(), sizes.tolist(), strict=True):
            assert p == held.get(k, 0)  # pieces stand side by side
            held[k] = p + s
        for k, filled in held.items():
            assert lengths[k] == min(x for x in options.lengths if x >= filled)
        assert len(lengths) == len(held)
    # best fit: the piece of 20 goes where it leaves least room
    own, _, _ = pack(np.array([50, 40, 24, 12]), PackingOptions(lengths=(64,), overhead=0))
    assert own.tolist() == [0, 1, 1, 0]


def test_opening_price():
    options = PackingOptions(lengths=(512, 1024, 8192), overhead=256, attention=32_768)
    assert best_length(500, 0, options) == 512
    assert best_length(500, 10**6, options) == 1024
    assert best_length(2000, 0, options) == 8192


def test_rows(documents):
    rows = [(d, "w " * (d * 37 % 900)) for d in range(300)] + [(5, "w " * 185), (None, "a"), (None, "a"), (400, None), (401, "w " * 20_000)]
    options = PackingOptions(shard=50)
    got = packed(documents(*rows), options).toPandas()
    spread = packed(documents(*rows).repartition(7), options).toPandas()
    key = ["doc_id", "copy", "piece"]
    assert got.sort_values(key).reset_index(drop=True).equals(spread.sort_values(key).reset_index(drop=True))
    assert got["n_tokens"].sum() == sum(len((t or "").split()) + 1 for _, t in rows)
    sizes = got.groupby("sequence").agg(n=("n_tokens", "sum"), length=("sequence_length", "first"))
    assert (sizes["n"] <= sizes["length"]).all()
    assert sorted(got[got["doc_id"] == 401]["start"]) == [0, 8192, 16384]
    assert packed(documents()).count() == 0
    assert packed(documents((1, "a")), length=F.lit(None).cast("int")).collect()[0]["sequence"] is None


def test_lengths_are_tokens(spark, documents):
    """No sequence of the query holds more tokens than its length, nor is a long text without white space one piece."""
    path = public_tokenizers.path("word_bpe_49k.json")
    counter = WordCounter(path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").toPandas()
    tokens = {d: counter.count(t) + 1 for d, t in zip(docs["doc_id"], docs["text"], strict=True)}
    got = op7_best_fit_packing(spark, "/root/testdata/sf0.001").toPandas()
    assert got.groupby("doc_id")["n_tokens"].sum().to_dict() == tokens
    held = got.groupby("sequence").agg(n=("n_tokens", "sum"), length=("sequence_length", "first"))
    assert (held["n"] <= held["length"]).all()
    long = "x1" * 20_000
    pieces = packed_tokens(documents((1, long)), TokenOptions(path)).toPandas()
    assert pieces["n_tokens"].sum() == counter.count(long) + 1 > 8192 and pieces["n_tokens"].max() == 8192
