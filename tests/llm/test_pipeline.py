import random

import corpus_pipeline
from tabledocs.llm.decontamination import decontaminated
from tabledocs.llm.near_copies import without_near_copies
from tabledocs.llm.quality import cleaned
from tabledocs.llm.queries import ORACLE, QUERIES
from tabledocs.llm.secrets import without_secrets

SMALL = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and set(QUERIES) <= names and set(ORACLE) <= set(QUERIES)
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]


def test_stages(spark, tmp_path):
    rng = random.Random(10)

    def prose(n):
        return ".\n".join(" ".join(f"w{rng.randrange(9999)}" for _ in range(12)) for _ in range(n)) + "."

    item = " ".join(f"item{k}" for k in range(30))
    base = prose(20)
    rows = [
        (1, base), (2, base + " one more"), (3, f"{prose(8)} {item} {prose(3)}"), (4, prose(9) + " token = abcdefgh12345 end."), (5, "junk"),
        (6, "Home | News | Sport | Contact\n" + prose(10)), (7, None), (8, prose(12)), (8, None),
    ]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen = {}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = {r["doc_id"]: r["text"] if name != "packing" else r for r in docs.collect()}
    assert sorted(seen["quality_rules"]) == [1, 2, 3, 4, 6, 8] and "Home" not in seen["quality_rules"][6]
    assert sorted(seen["near_dedup"]) == [1, 3, 4, 6, 8]
    assert sorted(seen["decontamination"]) == [1, 4, 6, 8]
    assert "abcdefgh" not in seen["secret_scan"][4] and seen["secret_scan"][8] == rows[7][1]
    assert sorted(seen["packing"]) == [1, 4, 6, 8]
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [1, 4, 6, 8]


def test_queries_run(spark):
    for name in ("op1_decontamination", "op2_toxicity", "op5_main_text", "op7_best_fit_packing", "op9_secret_scan"):
        assert QUERIES[name](spark, SMALL).count() > 0, name


def test_near_copies_from_80_percent(spark):
    """A pair at a similarity of 0.82 is one document after the stage; a pair at 0.78 stays."""

    def pair(name, shared, own):
        words = [f"{name}{k}" for k in range(shared + 4)]
        return " ".join(words + [f"{name}x{k}" for k in range(own)]), " ".join(words + [f"{name}y{k}" for k in range(own)])

    # shared shingles, and those that each text has besides: 820 of 1000, 780 of 1000
    (a, b), (c, d) = pair("a", 820, 90), pair("c", 780, 110)
    docs = spark.createDataFrame(list(enumerate([a, b, c, d])), "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SMALL).collect()) == [0, 2, 3]


def test_columns_of_any_name(spark):
    """Columns whose names clash with those of the operators, or hold a dot, come back as they were."""
    names = ("q_kept", "q_text", "secret_spans", "flags", "row", "own", "a.b", "digest", "chars", "node")
    text = "One line of words that is long enough for the rules to keep it as it is, and more.\n" * 3 + " ".join(f"w{k} and" for k in range(60)) + "."
    docs = spark.createDataFrame([(k, text.replace("One", f"One{k}"), "en", "s", 7, *[f"{n}-{k}" for n in names]) for k in range(3)], ["doc_id", "text", "lang", "source", "n_chars", *names])
    item = spark.createDataFrame([(1, " ".join(f"i{k}" for k in range(20)))], "item_id bigint, text string")
    expected = sorted(tuple(r[5:]) for r in docs.collect())
    for out in (cleaned(docs), without_secrets(docs), decontaminated(docs, item), without_near_copies(docs)):
        assert out.columns == docs.columns and len(out.collect()) in (1, 3)
        assert {tuple(r[5:]) for r in out.collect()} <= set(expected)
    assert sorted(tuple(r[5:]) for r in cleaned(docs).collect()) == expected
