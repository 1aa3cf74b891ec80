"""Token counts of texts by byte-pair merging; only counts are made, no identifiers.

A word is a linked list of symbols. A heap holds its adjacent pairs by rank and
place; the lowest is popped, merged if it still stands, and the pairs on either
side of the new symbol are pushed. A word of n symbols with m merges has n - m tokens.
Memory is bounded: short words are remembered in two generations of fixed size, nothing else stays.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: words remembered per generation, and the length up to which a word is remembered
REMEMBERED = 400_000
REMEMBERED_LENGTH = 48


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(hidden)) for b in range(256)]


def count_merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left when no pair with a rank stands side by side."""
    n = len(symbols)
    if n < 2:
        return n
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(rank, k, k + 1, pair) for k in range(n - 1) if (rank := ranks.get(pair := (symbols[k], symbols[k + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, k, j, pair = heapq.heappop(heap)
        if after[k] != j or j >= n or (symbols[k], symbols[j]) != pair:
            continue  # one of the two has been merged since
        symbols[k] = pair[0] + pair[1]
        symbols[j] = ""
        left -= 1
        end = after[k] = after[j]
        if end < n:
            before[end] = k
            if (rank := ranks.get(new := (symbols[k], symbols[end]))) is not None:
                heapq.heappush(heap, (rank, k, end, new))
        if (start := before[k]) >= 0 and (rank := ranks.get(new := (symbols[start], symbols[k]))) is not None:
            heapq.heappush(heap, (rank, start, k, new))
    return left


class WordCounter(dict):
    """Counts tokens of a text as a vocabulary file of the `tokenizers` library says: the kind with NFC, lower case, a split pattern, bytes and word ends."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        model = spec["model"]
        if steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or level["type"] != "ByteLevel" or model["type"] != "BPE":
            raise ValueError(f"{path} holds another kind of tokenizer")
        self._pieces = regex.compile(split["pattern"]["Regex"]).findall
        self._end = model["end_of_word_suffix"]
        self._ranks = {tuple(x): k for k, x in enumerate(model["merges"])}
        special = [regex.escape(x["content"]) for x in spec["added_tokens"]]
        self._special = regex.compile("|".join(special)) if special else None
        self._symbol = _byte_symbols()
        self._old: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        n = self._old.get(word)
        if n is None:
            pieces = self._pieces(word)
            # pieces are words of their own, met in other company before
            n = self._tokens(word) if pieces == [word] else sum(map(self.__getitem__, pieces))
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self._old = dict(self)
                self.clear()
            self[word] = n
        return n

    def _tokens(self, piece: str) -> int:
        symbols = [self._symbol[b] for b in piece.encode("utf-8")]
        symbols[-1] += self._end
        return count_merged(symbols, self._ranks)

    def count(self, text: str | None) -> int:
        """Tokens of the whole text; 0 for none. The strings of special tokens inside it are one token each, as by default."""
        if not text:
            return 0
        if self._special and "<|" in text:
            parts = self._special.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        # one capital has two small forms by context; here it always becomes the first
        text = text.replace("Σ", "σ").lower()
        return sum(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> WordCounter:
    return WordCounter(path)


@dataclass(frozen=True)
class TokenOptions:
    """path: the vocabulary file, which every executor can read; limit: a text with more tokens is over it."""

    path: str
    limit: int = 2048


def token_counts(docs: DataFrame, options: TokenOptions) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of `docs` (doc_id, text).

    A null or empty text has no bytes and no tokens. Repeated rows and rows without doc_id are counted like others; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(options.path)
        for batch in batches:
            counts = [counter.count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
    counted = rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > options.limit)
