import random

from tabledocs.llm.links import components
from tabledocs.llm.near_copies import NearCopyOptions, near_copies, without_near_copies

GAPS = " \t\n\x0b\x0c\r"


def words(text):
    for gap in GAPS:
        text = text.replace(gap, " ")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in text.split(" ") if w]


def shingles(text):
    w = words(text or "")
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows):
    """doc_id to (size, component, kept) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def corpus(seed=5):
    """Originals, exact copies, copies with changes around the threshold, chains of copies, and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 200))]
        rows.append(base)
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(copy)
            if rng.random() < 0.5:
                base = copy
    texts = [rng.choice([" ", "\n", " \t"]).join(x) for x in rows] + ["", None, "  \n", "one two", "One two", "one\x0btwo", "two one", "É é É é É", "é é é é é"]
    rng.shuffle(texts)
    return [(10 + 3 * k, t) for k, t in enumerate(texts)]


def test_like_all_pairs(documents):
    rows = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_copies(documents(*rows)).collect()}
    assert got == brute(rows)


def test_blocks_find_what_leads_miss(documents):
    """Blocks of a few rows: every pair of components in a bucket is still compared."""
    rows = corpus(6)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_copies(documents(*rows), NearCopyOptions(block=2)).collect()}
    assert got == brute(rows)


def test_odd_rows(documents, spark):
    long = " ".join(f"x{k}" for k in range(20_000))
    rows = [(1, long), (2, long + " y"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None), (4, ""), (4, ""), (3, "a b c d e f")]
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0, r["kept"]) for r in near_copies(documents(*rows)).collect())
    assert got == [
        (0, 0, 0, True), (0, 2, 2, True), (1, 19996, 1, True), (2, 2, 2, True), (2, 2, 2, True), (2, 19997, 1, False), (3, 2, 2, False), (4, 0, 4, True), (4, 0, 4, True),
    ]
    assert near_copies(documents()).count() == 0
    left = without_near_copies(documents(*rows))
    assert left.columns == documents().columns
    # rows of one id stay together; equal texts of one id stay once
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:3]) for r in left.collect()) == [(0, ""), (0, "a b"), (1, "x0 "), (2, "a b"), (2, "x0 "), (4, "")]


def test_components(spark):
    path = [(k, k + 1) for k in range(0, 300)] + [(1000, 1001), (1001, 1000), (7, 7), (2000, 2000)]
    random.Random(1).shuffle(path)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(301)}, 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
