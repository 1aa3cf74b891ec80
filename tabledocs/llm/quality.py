"""Quality rules, line first: lines are judged and removed one by one, then documents that lost too much text go.

Everything is a column expression of the document's own row: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabledocs.llm.arrays import total
from tabledocs.llm.shared import text_of

#: what separates words, as a pattern
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: signs that stand between the entries of menus and breadcrumbs
_SEPARATORS = "|»›·•>"
#: phrases of notices that sites add to their texts
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "use of cookies", "sign up for our newsletter", "click here to", "skip to content", "powered by wordpress",
)


@dataclass(frozen=True)
class QualityOptions:
    """least_words, repeat_percent: a document with fewer words, or with a larger share of words in repeated windows, fails at once.

    line rules: symbols, separators and emphasis marks per 100 words; boilerplate phrases count in lines of fewer than `boilerplate_words` words;
    a line of at least `unended_words` words must end in punctuation, and repeat itself less than `line_repeat_percent`.
    lost_percent: a document that loses a larger share of its word characters is rejected.
    """

    least_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 30
    separator_percent: int = 30
    emphasis_percent: int = 50
    boilerplate_words: int = 40
    unended_words: int = 200
    line_repeat_percent: int = 70
    lost_percent: int = 60


def words_of(text: Column) -> Column:
    """The words of a text that is not null."""
    return F.array_remove(F.split(text, GAP), "")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words, from `words`: the words in windows of three that occur twice or more."""
    docs = docs.withColumn(
        "grams",
        F.when(
            F.size("words") > 3,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - 3),
                lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
            ),
        ),
    )
    docs = docs.withColumn("repeats", F.size(F.array_distinct("grams")) < F.size("grams"))
    # positions in the order of their hashes: high bits of the hash, then the position
    docs = docs.withColumn("bits", F.length(F.bin(F.size("words"))))
    high = F.expr("transform(grams, (g, i) -> shiftleft(g, bits) | cast(i as bigint))")
    docs = docs.withColumn("ordered", F.when(F.col("repeats"), F.sort_array(high)))
    docs = docs.withColumn("ordered", F.expr("transform(ordered, k -> cast(k & (shiftleft(1L, bits) - 1) as int))"))
    docs = docs.withColumn("hashes", F.transform("ordered", lambda p: F.get("grams", p)))

    def twice(_: Column, j: Column) -> Column:
        own = F.get("hashes", j)
        return F.coalesce(own == F.get("hashes", j - 1), F.lit(False)) | F.coalesce(own == F.get("hashes", j + 1), F.lit(False))

    docs = docs.withColumn("marked", F.sort_array(F.filter("ordered", twice)))
    steps = F.transform("marked", lambda p, i: F.coalesce(F.least(F.lit(3), F.get("marked", i + 1) - p), F.lit(3)))
    docs = docs.withColumn("n_repeat_words", F.when(F.col("repeats"), total(steps)).otherwise(F.lit(0)).cast("bigint"))
    return docs.drop("grams", "repeats", "bits", "ordered", "hashes", "marked")


def _line_fails(line: Column, options: QualityOptions) -> Column:
    """Whether the line is navigation, a notice, noise, or prose without punctuation. `line` is a struct of text and words."""
    text, words = line["text"], line["words"]
    n = F.size(words)
    folded = F.lower(text)
    notice = F.lit(False)
    for phrase in BOILERPLATE:
        notice = notice | F.contains(folded, F.lit(phrase))
    ended = F.substring(F.rtrim(text), -1, 1).isin(*".!?…:;,\"')]}»”’。！？")
    return (
        (_count(text, _SEPARATORS) * 100 > options.separator_percent * n)
        | (_count(text, SYMBOLS) * 100 > options.symbol_percent * n)
        | (_count(text, "!¡") * 100 > options.emphasis_percent * n)
        | ((n < options.boilerplate_words) & notice)
        | ((n >= options.unended_words) & ~ended)
        | ((n >= 10) & ((n - F.size(F.array_distinct(words))) * 100 > options.line_repeat_percent * n))
    )


def quality(docs: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """The rows of `docs` (text, and any other columns) with columns q_n_words, q_word_chars, q_n_symbols, q_n_dup_lines, q_n_repeat_words (bigint),
    q_base_failed, q_kept (boolean), q_lines_removed, q_chars_lost (bigint) and q_text, the lines that remain.

    A null or empty text has no words and fails. Ties do not matter; repeated rows are judged alike. Columns of `docs`
    that are named like these are replaced.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lines_removed", "chars_lost", "text")
    own = [c for c in docs.columns if c not in {f"q_{x}" for x in names}]
    # the caller's columns travel in one struct, so that no name can clash
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), text_of(F.col("text")).alias("text"))
    work = work.withColumn("words", words_of(F.col("text")))
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), words_of(x).alias("words")))
    work = work.withColumn("lines", F.filter(lines, lambda x: F.size(x["words"]) > 0))
    work = _with_repeats(work)
    # what follows needs the text and the lines only
    work = work.select(
        "row", "lines", F.size("words").cast("bigint").alias("n_words"), "n_repeat_words",
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct(F.col("lines.text")))).cast("bigint").alias("n_dup_lines"),
    )
    work = work.withColumn("left", F.filter("lines", lambda x: ~_line_fails(x, options)))
    work = work.withColumn("left_chars", total(F.transform("left", lambda x: F.length(F.array_join(x["words"], "")).cast("bigint"))))
    base = (F.col("n_words") < options.least_words) | (100 * F.col("n_repeat_words") > options.repeat_percent * F.col("n_words"))
    lost = F.col("word_chars") - F.col("left_chars")
    values = {
        "n_words": F.col("n_words"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.col("n_dup_lines"), "n_repeat_words": F.col("n_repeat_words"), "base_failed": base,
        "kept": ~base & (100 * lost <= options.lost_percent * F.col("word_chars")),
        "lines_removed": (F.size("lines") - F.size("left")).cast("bigint"), "chars_lost": lost,
        "text": F.array_join(F.col("left.text"), "\n"),
    }
    # one struct of one row: else a filter on the verdict would pull all these expressions into itself
    verdict = F.inline_outer(F.array(F.struct(*[v.alias(f"q_{k}") for k, v in values.items()])))
    return work.select("row", verdict).select("row.*", *[f"q_{k}" for k in values])


def cleaned(docs: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns; where lines were removed, the text is what remains, and n_chars, if there is one, its length."""
    # the caller's columns in one struct, so that they come back as they are, whatever their names
    judged = quality(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), "text"), options).where("q_kept")
    changed = F.col("q_lines_removed") > 0
    values = {"text": F.when(changed, F.col("q_text")).otherwise(F.col("own.text")).alias("text")}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(changed, F.length("q_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("own.n_chars")).alias("n_chars")
    return judged.select(*[values.get(c, F.col(f"own.`{c}`").alias(c)) for c in docs.columns])
