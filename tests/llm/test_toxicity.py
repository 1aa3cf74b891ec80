import random
import zlib

from tabledocs.llm.toxicity import ToxicityOptions, fit, score, swapped_sentences, toxicity


def data(spark, seed=1, n=600):
    rng = random.Random(seed)
    plain = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for d in range(n):
        toxic = d % 4 == 0
        text = [rng.choice(plain) for _ in range(30)]
        if toxic:
            text[rng.randrange(30)] = rng.choice(["scumbag", "moronic"])
            # toxic texts mention one group more often
            if rng.random() < 0.7:
                text[rng.randrange(30)] = "muslims"
        elif rng.random() < 0.1:
            text[rng.randrange(30)] = "muslims"
        rows.append((d, " ".join(text)))
        labels.append((d, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels)


def test_held_out(spark):
    docs, labels, truth = data(spark)
    rows = toxicity(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_neutral_mentions(spark):
    """The counterfactual penalty takes the weight from a group that toxic texts mention often."""
    docs, labels, _ = data(spark)
    neutral = spark.createDataFrame([(1, "the muslims of our town met friends"), (2, "the hindus of our town met friends")], "doc_id bigint, text string")

    def scores(fairness):
        model = fit(docs, labels, ToxicityOptions(fairness=fairness))
        return {r["doc_id"]: r["score"] for r in score(neutral, model).collect()}

    without, fair = scores(0.0), scores(30.0)
    assert without[1] - without[2] > 4 * abs(fair[1] - fair[2])
    assert fair[1] < without[1]


def test_swaps():
    got = list(swapped_sentences("No one. The women, here! Men", ToxicityOptions(terms=(("women", "men", "people"),))))
    assert got == [(" The women, here", "The men here"), (" The women, here", "The people here"), (" Men", "women"), (" Men", "people")]


def test_odd_rows(spark):
    docs, labels, _ = data(spark, n=120)
    odd = spark.createDataFrame([(None, "scumbag"), (1, None), (1, ""), (2, "word1 " * 50_000)], "doc_id bigint, text string")
    rows = toxicity(docs, labels).unionByName(score(odd, fit(docs, labels))).where("doc_id is null or doc_id < 3").collect()
    assert any(r["doc_id"] is None and not r["held_out"] for r in rows) and all(r["score"] is not None for r in rows)
    empty = labels.where("false")
    assert {r["predicted"] for r in toxicity(odd, empty).collect()} <= {0, 1}
    assert toxicity(docs.where("false"), labels).count() == 0
