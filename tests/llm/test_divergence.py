import random
import re
from collections import Counter, defaultdict

import pytest

from tabledocs.llm.divergence import DivergenceOptions, runs, source_divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, count bigint, p string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, g, s, "x", 1, "y") for k, (t, g, s) in enumerate(rows)], SCHEMA)


def terms(text):
    found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def brute(rows, least=10, top=10):
    """Every term of every pair of sources, one by one."""
    groups, documents = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = terms(text)
        groups[lang or "", source or ""].update(words)
        documents[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in documents[lang].items() if n >= least]

        def chances(counts, kept=kept):
            n, v = sum(counts[t] for t in kept), len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * v) for t in kept}

        mine = {s: chances(c) for (g, s), c in groups.items() if g == lang}
        whole = chances(sum((c for (g, _), c in groups.items() if g == lang), Counter()))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for source, p in mine.items():
            pairs = [(-sum(f(p[t], q[t]) for t in kept), s.encode()) for s, q in mine.items() if s != source]
            own = [(-f(p[t], whole[t]), t.encode()) for t in kept if groups[lang, source][t] and p[t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                out += [(lang, source, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def corpus(seed, n=400, sources=7, words=120):
    rng = random.Random(seed)
    vocabulary = [f"Wort{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(words)] + ["É", "é", "naïve", "ſ", "K", "ⅫK", "中文"]
    rows = []
    for _ in range(n):
        # one source holds a third of all rows
        source = "hot" if rng.random() < 1 / 3 else f"s{rng.randrange(sources)}"
        text = rng.choice([" ", "1", "\n_", "@["]).join(rng.choice(vocabulary[: 1 + int(words * rng.random() ** 2)]) for _ in range(rng.randrange(40)))
        rows.append((text, rng.choice(["en", "en", "en", "de", None]), source))
    return rows


@pytest.mark.parametrize("options", [DivergenceOptions(), DivergenceOptions(memory=2000, shard=50, chunk=7, pairs=3)])
def test_like_all_terms_of_all_pairs(spark, options):
    """With very little memory there are many runs, shards and rows; the result is the same."""
    rows = corpus(3)
    got = [tuple(r) for r in source_divergence(frame(spark, rows).repartition(5), options).collect()]
    assert sorted(got) == brute(rows)


def test_runs(spark):
    options = DivergenceOptions(memory=3000, chunk=5)
    rows = runs(frame(spark, corpus(4, n=60)).coalesce(1), options).collect()
    by_run = defaultdict(list)
    for r in rows:
        assert len(r["hash"]) == len(r["term"]) == len(r["n"]) <= 5 and sum(r["n"]) == len(r["source"]) == len(r["count"])
        by_run[r["run"], r["lang"]].append([*zip(r["hash"], r["term"])])
    assert len(by_run) > 10
    assert all(sum(sorted(parts), []) == sorted(sum(parts, [])) for parts in by_run.values())
    # all occurrences are there
    assert sum(sum(r["count"]) for r in rows) == sum(len(terms(t)) for t, _, _ in corpus(4, n=60))


def test_odd_rows(spark):
    long = "lang " * 300_000 + "x" * 2_000_000
    rows = [(long, "xx", "a"), (None, None, None), ("", "", ""), ("12 34", "yy", "only")]
    rows += [("one two TWO", "xx", s) for s in ("a", "b", "b", "a", None) for _ in range(4)]
    rows += [("one two TWO", "xx", "empty words")] * 2 + [("9", "xx", "none")]
    got = sorted(tuple(r) for r in source_divergence(frame(spark, rows)).collect())
    assert got == brute(rows)
    assert {r[1] for r in got if r[0] == "xx"} == {"a", "b", "", "empty words", "none"}
    # ties are in order of their bytes
    assert [r[3] for r in got if r[:3] == ("xx", "none", "pair")]
    assert source_divergence(frame(spark, [])).count() == 0
    # no kept term: pairs have the value 0
    few = sorted(tuple(r) for r in source_divergence(frame(spark, [("a b", "q", "x"), ("c", "q", "y")])).collect())
    assert few == [("q", "x", "pair", "y", 0, 1), ("q", "y", "pair", "x", 0, 1)]
