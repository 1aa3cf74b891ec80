import random

from pyspark.sql import functions as F

from tabledocs.llm.chat import format_chats, read_loss, read_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, turns string, formatted string"


def test_round_trip(spark):
    rng = random.Random(6)
    marks = ["### ", "</turn>\n", "<+>", ": ", "\\", "\\s", "\\l", "\\h", "\\c", "é", "\n", "text", "😀", ""]
    rows = []
    for c in [*range(40), None]:
        for t in range(rng.choice([1, 2, 3, 8, 300 if c == 3 else 5])):
            role = rng.choice(["user", "assistant", "assistant", "sys: <#>", None])
            rows.append((c, t, role, rng.choice([None, *["".join(rng.choice(marks) for _ in range(6)) for _ in range(5)]]), "x", "y"))
    shuffled = list(rows)
    rng.shuffle(shuffled)
    chats = format_chats(spark.createDataFrame(shuffled, SCHEMA))
    read = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(read) == 41
    for r in read:
        own = [(x[2] or "", x[3] or "") for x in rows if x[0] == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == own
        assert r["loss"] == [t for role, t in own if role == "assistant"]
        # adjacent turns of one role share a block
        assert r["formatted"].count("### ") == sum(k == 0 or own[k][0] != own[k - 1][0] for k in range(len(own)))


def test_ties_and_empty(spark):
    rows = [(1, 0, "user", "b", "", ""), (1, 0, "user", "a", "", ""), (1, None, "user", "c", "", ""), (1, 0, "user", "a", "", "")]
    assert format_chats(spark.createDataFrame(rows, SCHEMA)).head()["formatted"] == "### user: c<+>a<+>a<+>b</turn>\n"
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
