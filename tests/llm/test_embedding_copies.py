import numpy as np
import pytest
from pyspark.sql import functions as F

from tabledocs.llm import lattice
from tabledocs.llm.embedding_copies import LatticeOptions, _met, near_vectors, signed, usable

SCHEMA = "vec_id bigint, embedding array<double>, label int, node bigint, `group` string, n_links double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, "g", 0.5) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.9):
    """All cosines, and components by search."""
    ids = [i for i, _ in rows]
    units = []
    for _, v in rows:
        good = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        w = np.array(v, np.float64) / np.abs(np.array(v, np.float64)).max() if good else None
        units.append(None if w is None else w / np.sqrt((w * w).sum()))
    linked = [[j for j, u in enumerate(units) if j != i and u is not None and w is not None and len(u) == len(w) and u @ w >= threshold] for i, w in enumerate(units)]
    out, seen = [None] * len(rows), {}
    for i in range(len(rows)):
        if i not in seen:
            found, stack = {i}, [i]
            while stack:
                for j in linked[stack.pop()]:
                    if j not in found:
                        found.add(j)
                        stack.append(j)
            own = [ids[j] for j in found if ids[j] is not None]
            seen |= dict.fromkeys(found, min(own) if own else None)
        out[i] = (ids[i], len(linked[i]), seen[i], ids[i] == seen[i])
    return sorted(out, key=repr)


def clusters(seed, plan, size=64):
    """For each (rows, noise) in the plan as many vectors around one direction, then unlike ones."""
    rng = np.random.default_rng(seed)
    found = []
    for n, noise in plan:
        center = rng.normal(size=size)
        center /= np.linalg.norm(center)
        found += [center + noise * rng.normal(size=size) / np.sqrt(size) for _ in range(n)]
    found += list(rng.normal(size=(150, size)))
    order = rng.permutation(len(found))
    return [(int(3 * k + 5), [float(x) for x in found[i]]) for k, i in enumerate(order)]


def test_lattice():
    """Nearest points against a search of all points around, and neighbours in order of distance."""
    rng = np.random.default_rng(1)
    points = rng.normal(size=(300, 8)) * 3
    near = lattice.nearest(points)
    doubled = 2 * near
    assert np.all(np.rint(doubled) == doubled) and np.all(near.sum(axis=1) % 2 == 0)
    assert np.all((doubled % 2 == doubled[:, :1] % 2))
    assert len(np.unique(lattice.NEIGHBOURS, axis=0)) == 240 and np.allclose((lattice.NEIGHBOURS**2).sum(axis=1), 2)
    around = near[:, None] + lattice.NEIGHBOURS[None]
    distance = ((points[:, None] - around) ** 2).sum(axis=2)
    assert np.all(((points - near) ** 2).sum(axis=1)[:, None] <= distance + 1e-9)
    probed = lattice.probed(points, 8)
    assert np.allclose(np.sort(((points[:, None] - probed[:, 1:]) ** 2).sum(axis=2)), np.sort(distance)[:, :8])
    assert len(np.unique(lattice.keys(probed, 1))) == len(np.unique(probed.reshape(-1, 8), axis=0))


@pytest.mark.parametrize("options", [LatticeOptions(), LatticeOptions(block=16)])
def test_like_all_pairs(spark, options):
    """Tight groups, groups around the threshold, chains through it, and exact copies: like all pairs, in small blocks too."""
    rows = clusters(5, [(90, 0.1), (40, 0.25), (3, 0.1), (2, 0.05), (25, 0.0)])
    got = sorted((tuple(r) for r in near_vectors(frame(spark, rows), options).collect()), key=repr)
    assert got == brute(rows)


def test_balls_that_touch_in_part(spark):
    """Two tight groups whose centres are about as far apart as the threshold: some members link, some do not."""
    rng = np.random.default_rng(8)
    a, b = np.eye(64)[0], 0.9 * np.eye(64)[0] + np.sqrt(1 - 0.81) * np.eye(64)[1]
    found = [c + 0.12 * rng.normal(size=64) / 8 for c in (a, b) for _ in range(120)]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(found)]
    truth = brute(rows)
    got = sorted((tuple(r) for r in near_vectors(frame(spark, rows), LatticeOptions(block=50)).collect()), key=repr)
    across = sum(r[1] for r in truth) - 2 * 120 * 119
    assert 0 < across < 2 * 120 * 120
    assert {r[0]: r[2] for r in got} == {r[0]: r[2] for r in truth}
    found_across = sum(r[1] for r in got) - 2 * 120 * 119
    assert 0.95 * across <= found_across <= across
    assert all(g[1] <= t[1] for g, t in zip(got, truth, strict=True))


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine of exactly 0.9 and a little more, far from all others."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(1500):
        u, w = rng.normal(size=(2, 64))
        u /= np.linalg.norm(u)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        rows += [(2 * k, [float(x) for x in u]), (2 * k + 1, [float(x) for x in 0.9001 * u + np.sqrt(1 - 0.9001**2) * w])]
    links = sum(r["n_links"] for r in near_vectors(frame(spark, rows)).collect()) / 2
    assert 0.97 * 1500 <= links <= 1500


def test_crowded_cells_are_split(spark):
    """The same pairs come from blocks of any size."""
    rows = frame(spark, clusters(6, [(30, 0.2)], size=16))
    nodes = rows.select("vec_id", "embedding").toDF("node", "vec")
    marks = signed(nodes, LatticeOptions())
    visits = marks.selectExpr("node as `group`", "posexplode(cells) as (at, cell)", "sketch_a", "sketch_b", "0D as radius")
    visits = visits.selectExpr("cell", "at % 9 = 0 as home", "`group`", "radius", "sketch_a", "sketch_b")
    whole, split = ({tuple(r) for r in _met(visits, LatticeOptions(block=b)).collect()} for b in (10_000, 3))
    assert whole == split and len(whole) >= 30


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (None, [2.0, 0.0]), (9, [1e200, 1e190]),
        (10, [1e-320, 0.0]), (11, [-1.0, -0.0]), (12, [-1.0, 0.0]), (13, [1.0]), (14, [1.0, 0.0, 0.0]), (None, [0.0, 1.0]), (None, None), (16, [-0.0, 0.0]), (0, [3.0]),
    ]
    good = [r["vec_id"] for r in frame(spark, rows).where(usable(F.col("embedding"))).collect()]
    assert good == [7, 7, None, 9, 10, 11, 12, 13, 14, None, 0]
    got = sorted((tuple(r) for r in near_vectors(frame(spark, rows)).collect()), key=repr)
    assert got == brute(rows)
    assert near_vectors(frame(spark, [])).count() == 0
    assert near_vectors(frame(spark, [(1, None)])).collect()[0][1:] == (0, 1, True)
