"""Secrets in texts, by an inverted index of the trigrams that the rules need.

A Boolean query of trigrams is derived from each rule. The index holds postings
(trigram, doc_id) for the trigrams that occur in any query. Each clause
intersects its postings; documents of some clause are candidates of the rule,
and only there the expression runs. A rule without mandatory trigrams runs on
every text. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabledocs.llm.arrays import sums_before
from tabledocs.llm.shared import BROADCAST_IDS, cut, text_of
from tabledocs.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """kind: name of its spans; pattern: the expression; group, least: this group of a match must have so many characters;
    first: masked before the other rules, whose masks could hide where its matches begin or go on."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    first: bool = False


#: the three base kinds, in their order
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # runs are maximal, so a run of 32 or more is found as a whole
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: a block of a private key: its first line, then all up to its last line, which may hold a few single dashes (headers do), or,
#: where that is missing, headers and the base64 lines that follow. What all engines read alike: no looking ahead, no possessive repeats
_KEY = r"[A-Z0-9\x20]{0,20}PRIVATE\x20KEY(?:\x20BLOCK)?-----"
_TO_END = rf"(?:[^-]+-{{1,4}}){{0,64}}[^-]*-----END\x20{_KEY}"
_HEADERS = r"(?:[\r\n]+[A-Z][A-Za-z-]{2,20}:\x20[^\n]*){0,4}"
# loops over single characters only, which need no stack; after lines comes a line that is prose, of which nothing is taken
_LINES = r"""[\x20\t\r\n\\]*[A-Za-z0-9+/=]{20}(?:[A-Za-z0-9+/=\r\n\\]*(?:[\r\n"']|\\n|$)|[A-Za-z0-9+/=]*(?:\x20+[A-Za-z0-9+/=]{20,}){0,40})"""
_KEY_BLOCK = rf"-----BEGIN\x20{_KEY}(?:{_TO_END}|{_HEADERS}{_LINES})?"
#: further kinds: public formats of credentials
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{24,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("keyblock", _KEY_BLOCK, first=True),
)
RULES = BASE + MORE
MASK = "[removed]"


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id): which of the trigrams a text holds in any case; a row per row of `docs` that holds it."""
    folded = docs.select("doc_id", F.lower(text_of(F.col("text"))).alias("folded"))
    held = F.array(*[F.when(F.contains(F.col("folded"), F.lit(t)), F.lit(t)) for t in trigrams])
    return folded.select("doc_id", F.explode(held).alias("trigram")).where("trigram is not null")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): bit k stands for rule k; documents that hold all trigrams of some clause. Rules without clauses are left out."""
    spark = docs.sparkSession
    wanted = []
    for k, rule in enumerate(rules):
        clauses = trigram_query(rule.pattern)
        for c, clause in enumerate(clauses if all(clauses) else []):
            wanted += [(k, c, t, 1 << i, (1 << len(clause)) - 1) for i, t in enumerate(sorted(clause))]
    if not wanted:
        return docs.select("doc_id", F.lit(0).cast("bigint").alias("rules")).where("false")
    names = ("rule", "clause", "trigram", "bit", "whole")
    types = ("int", "int", "string", "bigint", "bigint")
    entries = [F.struct(*[F.lit(v).cast(t).alias(n) for n, t, v in zip(names, types, w, strict=True)]) for w in wanted]
    clauses = spark.range(1).select(F.inline(F.array(*entries)))
    found = postings(docs, sorted({w[2] for w in wanted}))
    # the rules' own table is a few dozen rows
    met = found.join(F.broadcast(clauses), "trigram").groupBy("doc_id", "rule", "clause", "whole").agg(F.bit_or("bit").alias("bits"))
    bit = F.expr("shiftleft(1L, rule)")
    return met.where("bits = whole").groupBy("doc_id").agg(F.bit_or(bit).alias("rules"))


def _flagged(docs: DataFrame, rules: tuple[Rule, ...], row: list[str]) -> DataFrame:
    """(row, text, flags): the columns `row` in one struct, the text, and the rules that have to run on it as bits."""
    always = sum(1 << k for k, rule in enumerate(rules) if not all(trigram_query(rule.pattern)))
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in row]).alias("row"), F.col("doc_id").alias("id"), text_of(F.col("text")).alias("text"))
    marks = cut(candidates(docs.select("doc_id", "text"), rules)).withColumnRenamed("doc_id", "marked")
    if marks.count() <= BROADCAST_IDS:
        marks = F.broadcast(marks)
    work = work.join(marks, F.col("id").eqNullSafe(F.col("marked")), "left")
    return work.select("row", "text", F.coalesce("rules", F.lit(0).cast("bigint")).bitwiseOR(F.lit(always).cast("bigint")).alias("flags"))


def _matches(text: Column, k: int, rule: Rule) -> Column:
    runs = F.col("flags").bitwiseAND(F.lit(1 << k).cast("bigint")) != 0
    return F.when(runs, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _passes(match: Column, rule: Rule) -> Column:
    return F.length(F.regexp_extract(match, rule.pattern, rule.group)) >= rule.least if rule.least else F.lit(True)


def _spans(text: Column, matches: Column, k: int, rule: Rule) -> Column:
    """Structs (start, rule, end) of the matches that pass, in code points."""
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g).cast("bigint"))
    lengths = F.transform(matches, lambda m: F.length(m).cast("bigint"))
    # where a match starts: all gaps up to it and all matches before it
    before = F.zip_with(sums_before(gaps), sums_before(F.concat(lengths, F.array(F.lit(0).cast("bigint")))), lambda g, m: g + m)
    starts = F.zip_with(before, gaps, lambda b, g: b + g)

    def span(m: Column, i: Column) -> Column:
        start = F.get(starts, i)
        return F.when(
            _passes(m, rule),
            F.struct(start.alias("start"), F.lit(k).alias("rule"), (start + F.length(m)).alias("end")),
        )

    found = F.filter(F.transform(matches, span), lambda s: s.isNotNull())
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>"))


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` (doc_id, text, and any other columns) with secret_spans: array of (start, kind, end), by start and order of the rules.

    Positions are code points, the end exclusive. A null or empty text has none.
    Matches of one rule do not overlap; those of several may. Rows that repeat a doc_id, or have none,
    are each searched in full. A column of that name is replaced.
    """
    row = [c for c in docs.columns if c != "secret_spans"]
    work = _flagged(docs, rules, row)
    for k, rule in enumerate(rules):
        work = work.withColumn(f"m{k}", _matches(F.col("text"), k, rule))
    for k, rule in enumerate(rules):
        work = work.withColumn(f"m{k}", _spans(F.col("text"), F.col(f"m{k}"), k, rule))
    ordered = F.sort_array(F.concat(*[F.col(f"m{k}") for k in range(len(rules))]))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    named = F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), F.get(kinds, s["rule"]).alias("kind"), s["end"].alias("end")))
    return work.select("row.*", named.alias("secret_spans"))


def _masked(text: Column, matches: Column, rule: Rule) -> Column:
    masked = F.transform(matches, lambda m: F.when(_passes(m, rule), F.lit(MASK)).otherwise(m))
    pieces = F.zip_with(F.split(text, rule.pattern, -1), F.concat(masked, F.array(F.lit(""))), lambda g, m: F.concat(g, m))
    return F.array_join(pieces, "")


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs`, with every secret in `text` replaced by a mask, rule after rule, those that are `first` before the others; other rows and columns stay as they are, null texts too."""
    work = _flagged(docs, rules, docs.columns).withColumn("clean", F.col("text"))
    for k, rule in sorted(enumerate(rules), key=lambda x: not x[1].first):
        work = work.withColumn("found", _matches(F.col("clean"), k, rule))
        work = work.withColumn("clean", F.when(F.size("found") > 0, _masked(F.col("clean"), F.col("found"), rule)).otherwise(F.col("clean")))
    columns = [F.col(f"row.`{c}`").alias(c) if c != "text" else F.when(F.col("row.text").isNotNull(), F.col("clean")).alias("text") for c in docs.columns]
    return work.select(*columns)
