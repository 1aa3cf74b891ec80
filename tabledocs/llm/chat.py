"""Conversations as training texts, formatted relationally.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role merge into a
block, which is an array of their texts; blocks are concatenated. Only Spark expressions are used.

A block reads ``### role: text</turn>`` and a line end; merged texts are parted by ``<+>``. In
texts and roles the three characters that marks are made of are written as
``\\s`` (backslash), ``\\l`` (less than) and ``\\h`` (hash), and in roles the colon as ``\\c``, so that no mark can occur inside them and
everything can be read back. Text under the loss mask is that of the assistant, given as spans of code points
of the formatted text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabledocs.llm.arrays import sums_before
from tabledocs.llm.shared import text_of

_HEAD, _COLON, _PART, _END = "### ", ": ", "<+>", "</turn>\n"
#: What stands for the characters of marks; the backslash comes first on the way there and last on the way back.
_ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"))


@dataclass(frozen=True)
class ChatOptions:
    """learned: texts of these roles are under the loss mask."""

    learned: tuple[str, ...] = ("assistant",)


def escaped(text: Column) -> Column:
    """The text without any character of a mark."""
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """The text that was escaped."""
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chats(turns: DataFrame, options: ChatOptions = ChatOptions()) -> DataFrame:
    """(conv_id, formatted, loss_spans) of `turns` (conv_id, turn, role, text): one row per conv_id; the rows without one make one conversation.

    Turns are sorted by turn, nulls first, then role and text, so ties have one order; repeated rows are turns of their own. A null text or role is empty. loss_spans are
    (start, length) of each learned text in turn. A conversation is one row of the result, and must fit in a task as such; other columns are ignored.
    """
    role = text_of(F.col("role"))
    entry = F.struct(
        F.col("turn").cast("bigint").alias("turn"), role.alias("role"), escaped(text_of(F.col("text"))).alias("text"), role.isin(*options.learned).alias("learned")
    )
    chats = turns.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    # blocks begin where the role changes
    first = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    chats = chats.withColumn("first", first)
    chats = chats.withColumn(
        "blocks", F.transform("first", lambda f, k: F.slice("turns", f + 1, F.coalesce(F.get("first", k + 1), F.size("turns")) - f))
    )

    def head(block: Column) -> Column:
        # in a role the colon is a mark too
        role = F.replace(escaped(F.get(block, F.lit(0))["role"]), F.lit(":"), F.lit("\\c"))
        return F.concat(F.lit(_HEAD), role, F.lit(_COLON))

    def written(block: Column) -> Column:
        return F.concat(head(block), F.array_join(F.transform(block, lambda t: t["text"]), _PART), F.lit(_END))

    chats = chats.withColumn("formatted", F.array_join(F.transform("blocks", written), ""))
    # what stands before each text, the texts, and what follows the last
    lead = F.flatten(
        F.transform("blocks", lambda b, k: F.transform(b, lambda t, j: F.when(j > 0, F.lit(len(_PART))).otherwise(F.length(head(b)) + F.when(k > 0, len(_END)).otherwise(0))))
    )
    chats = chats.withColumn("lead", lead)
    sizes = F.zip_with("lead", "turns", lambda a, t: (a + F.length(t["text"])).cast("bigint"))
    chats = chats.withColumn("before", sums_before(sizes))
    spans = F.transform(
        "turns",
        lambda t, i: F.when(t["learned"], F.struct((F.get("before", i) + F.get("lead", i)).alias("start"), F.length(t["text"]).cast("bigint").alias("length"))),
    )
    return chats.select("conv_id", "formatted", F.filter(spans, lambda s: s.isNotNull()).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Structs (role, text) of the turns in a formatted text."""
    blocks = F.filter(F.split(formatted, _END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        cut = F.instr(block, _COLON)
        role = unescaped(F.replace(F.substring(block, F.lit(len(_HEAD) + 1), cut - len(_HEAD) - 1), F.lit("\\c"), F.lit(":")))
        body = F.substring(block, cut + len(_COLON), F.length(block))
        return F.transform(F.split(body, r"<\+>", -1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
