import random

from tabledocs.llm.decontamination import DecontaminationOptions, blocks, contamination, decontaminated, fingerprint
from pyspark.sql import functions as F


def grams(words, width):
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]


def similarity(a, b):
    from collections import Counter

    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def brute(docs, items, percent=80):
    found = {}
    for d, text in docs:
        words = (text or "").lower().split()
        for i, item in items:
            own = (item or "").lower().split()
            width = min(5, len(own))
            scores = [similarity(grams(words[s : s + len(own)], width), grams(own, width)) for s in range(len(words) - len(own) + 1)] if own else []
            if scores and max(scores) >= percent / 100 - 1e-12:
                found[d, i] = max(scores)
    return found


def test_like_all_windows(spark):
    rng = random.Random(2)
    vocabulary = [f"v{k}" for k in range(60)] + ["Das", "ist"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([6, 12, 40, 41, 90])))) for k in range(12)]
    items += [(50, "two words"), (51, None), (52, ""), (53, "a a a a a a a a a b a a a a a a a"), (3, items[3][1])]
    docs = []
    for d in range(60):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.8:
            part = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                if part:
                    part[rng.choice([0, -1, rng.randrange(len(part))])] = rng.choice(vocabulary)
            at = rng.randint(0, len(body))
            body[at:at] = part
        docs.append((d, " ".join(body).upper() if d % 5 == 0 else " ".join(body)))
    docs += [(100, None), (101, ""), (None, "x two words y"), (102, "two words"), (102, "two words")]
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    rows = contamination(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows} == {k: round(v, 9) for k, v in brute(docs, items).items()}
    assert sum(r["doc_id"] == 102 for r in rows) == 2
    left = decontaminated(frame.withColumn("digest", F.lit(1)), bench)
    hit = {d for d, _ in brute(docs, items)}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(d for d, _ in docs if d not in hit)
    assert left.columns == ["doc_id", "text", "digest"]


def test_empty(spark):
    docs, none = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(docs, none).count() == 0 and decontaminated(docs, none).count() == 1
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert contamination(docs.where("false"), items).count() == 0
    assert contamination(docs, items).select("similarity", "hamming", "start_word", "n_words").collect() == [(1.0, 0, 0, 3)]


def test_fingerprint_and_blocks(spark):
    rng = random.Random(3)
    sets = [[rng.getrandbits(64) - 2**63 for _ in range(n)] for n in (1, 2, 3, 31, 32, 33)]
    frame = spark.createDataFrame([(s,) for s in sets], "s array<bigint>")
    got = [r[0] for r in frame.select(fingerprint(F.col("s"), 6)).collect()]
    for values, bits in zip(sets, got, strict=True):
        expected = sum(1 << k for k in range(64) if sum(v >> k & 1 for v in values) > len(values) / 2)
        assert bits & (2**64 - 1) == expected
    radius = DecontaminationOptions().radius
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), radius):
            b ^= 1 << k
        pairs.append((a - 2**63, b - 2**63))
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    same = F.exists(F.zip_with(blocks(F.col("a"), radius), blocks(F.col("b"), radius), lambda x, y: x == y), lambda x: x)
    assert frame.where(~same).count() == 0
