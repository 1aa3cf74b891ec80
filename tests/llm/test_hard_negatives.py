import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabledocs.llm.hard_negatives import HardNegativeOptions, hard_negatives, scored, tiles

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, shard int, query double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, "s", 1, 0.5) for i, v, g in rows], SCHEMA)


def mined(spark, rows, options=HardNegativeOptions()):
    points = frame(spark, rows).withColumn("vector", scored(F.col("embedding")))
    return sorted(tuple(r) for r in hard_negatives(points, F.col("vec_id") % 100 == 0, options).collect())


def brute(rows, positives=5, negatives=10):
    """All scores, in whole numbers."""
    whole = {}
    for i, v, g in rows:
        if i is None or g is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (g, [math.floor(256 * x) for x in v])
        whole[i] = min(whole.get(i, row), row)
    out = []
    for a, (label, vector) in whole.items():
        if a % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(vector, v)), i) for i, (_, v) in whole.items() if i != a)
        for best, p in [s for s in scores if whole[s[1]][0] == label][:positives]:
            fits = [(s, i) for s, i in scores if whole[i][0] != label and 30 * -best <= 100 * -s <= 90 * -best]
            out += [(a, p, k + 1, i, -best, -s) for k, (s, i) in enumerate(fits[:negatives])]
    return sorted(out)


def vectors(seed, n, size, spread=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, size))
    found = [centers[k % 5] + spread * rng.normal(size=size) for k in range(n)]
    return [(k * 5, [float(x) for x in v / np.linalg.norm(v)], int(rng.integers(4))) for k, v in enumerate(found)]


@pytest.mark.parametrize("options", [HardNegativeOptions(), HardNegativeOptions(tile=40, leaf=6, shard=2, page=3, queries=4)])
@pytest.mark.parametrize("size", [2, 3, 64])
def test_like_all_scores(spark, options, size):
    """One large tile, and many small tiles, shards, pages and tasks."""
    rows = vectors(size, 900, size)
    assert mined(spark, rows, options) == brute(rows)


def test_ties(spark):
    """Many equal rows: ties go to smaller ids, and boxes level with the last result are still opened."""
    rows = [(k, [1.0, 0.25 * (k % 3)], k % 2) for k in range(400)] + [(k, [0.5, 0.0], k % 3) for k in range(400, 700)]
    assert mined(spark, rows, HardNegativeOptions(tile=32, leaf=4, shard=1, queries=2)) == brute(rows)


def test_tree(spark):
    """Tiles and leaves hold every row once, within their boxes and sizes."""
    rows = vectors(4, 1000, 8)
    points = frame(spark, rows).select("vec_id", "label", scored(F.col("embedding")).alias("vector"))
    tree = tiles(points, HardNegativeOptions(tile=100, leaf=9)).collect()
    assert sorted(i for t in tree for i in t["ids"]) == [i for i, _, _ in rows]
    whole = {i: np.floor(256 * np.array(v)) for i, v, _ in rows}
    for t in tree:
        low, high = (np.frombuffer(t[c]).reshape(-1, 8) for c in ("low", "high"))
        ends = [*t["starts"][1:], len(t["ids"])]
        assert len(t["ids"]) <= 100
        for a, z, lo, hi in zip(t["starts"], ends, low, high, strict=True):
            leaf = np.array([whole[i] for i in t["ids"][a:z]])
            assert 0 < z - a <= 9 and (leaf.min(axis=0) == lo).all() and (leaf.max(axis=0) == hi).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [2.0, 0.5], 1), (1, [0.9, 0.1], 1), (2, None, 1), (3, [None, 1.0], 2), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, [1.0, 1.0], None),
        (None, [1.0, 1.0], 2), (7, [0.5, 0.2], 2), (8, [], 2), (9, [0.4], 2), (10, [0.0, 0.0], 2), (11, [0.4, 0.1, 5.0], 3), (100, [0.0, 0.0], 2), (200, [-1.0, -1.0], 1), (300, [], 3),
        (-100, [0.3, 0.3], 1), (12, [0.5, 0.2], 2),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and {r[0] for r in got} >= {0, -100, 100}
    assert mined(spark, []) == [] and mined(spark, [(2, None, 1)]) == [] and mined(spark, [(0, [1.0], 1)]) == []


def test_scores_beyond_doubles(spark):
    """Scores that a double cannot hold are still exact."""
    rows = [(100 * k if k < 2 else k, [1e5 + k / 256, 1e5 + k * 3 / 256, 5e5], k % 2) for k in range(60)]
    rows += [(1000 + k, [5e4 + k / 256, 5e4, 2e5 + k / 256], 2) for k in range(30)]
    got = mined(spark, rows, HardNegativeOptions(tile=16, leaf=4))
    assert got == brute(rows) and max(r[4] for r in got) > 2**53
