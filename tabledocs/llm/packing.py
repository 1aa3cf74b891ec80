"""Documents packed into training sequences of several permitted lengths.

Pieces are dealt to shards of bounded size by a hash, and each shard is packed by best fit, longest
piece first: a piece goes into the open bin that it fills most. If none has room, a bin is opened, of the length
whose price per token is least: the price of the bin over what it will hold, as far as
the pieces still to come can fill it. When all are placed, each bin shrinks to the shortest permitted length
that holds its contents. A document longer than the longest sequence is cut into
pieces; nothing is dropped.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabledocs.llm.shared import cut, text_of
from tabledocs.llm.token_counts import TokenOptions, token_counts


@dataclass(frozen=True)
class PackingOptions:
    """lengths: permitted tokens of a sequence; overhead: what each sequence costs besides its tokens; attention: tokens at which
    attention, which grows with the square of the length, costs as much as the rest; shard: pieces that are packed together, on average, which bounds a task's memory."""

    lengths: tuple[int, ...] = (512, 1024, 2048, 4096, 8192)
    overhead: int = 256
    attention: int = 32_768
    shard: int = 20_000


def best_length(size: int, to_come: int, options: PackingOptions) -> int:
    """The permitted length that costs the piece least, if pieces of `to_come` tokens can still fill it."""

    def price(length: int) -> tuple[float, int]:
        return (options.overhead + length * (1 + length / options.attention)) / min(length, size + to_come), length

    return min((x for x in options.lengths if x >= size), key=price)


def pack(sizes: np.ndarray, options: PackingOptions) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin of each piece, its place in the bin, final length of each bin) for pieces in descending order."""
    own, place = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    opened: list[int] = []
    rooms: list[int] = []  # the distinct rooms of open bins, ascending
    bins: dict[int, list[int]] = {}  # room to bins, the last opened first used
    to_come = int(sizes.sum())

    def offer(room: int, k: int) -> None:
        if room not in bins:
            rooms.insert(bisect_left(rooms, room), room)
            bins[room] = []
        bins[room].append(k)

    for i, size in enumerate(sizes.tolist()):
        to_come -= size
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            k = bins[room].pop()
            if not bins[room]:
                del bins[room]
                del rooms[at]
        else:
            k = len(filled)
            room = best_length(size, to_come, options)
            filled.append(0)
            opened.append(room)
        own[i], place[i] = k, filled[k]
        filled[k] += size
        if room > size:
            offer(room - size, k)
    shortest = sorted(options.lengths)
    return own, place, [next(x for x in shortest if x >= f) for f in filled]


def word_count(text: Column) -> Column:
    """A length in tokens where no other is at hand: words, and one mark of the end."""
    return (F.size(F.array_remove(F.split(text_of(text), r"[\x20\x09-\x0D]+"), "")) + 1).cast("bigint")


def packed(docs: DataFrame, options: PackingOptions = PackingOptions(), length: Column | None = None) -> DataFrame:
    """(doc_id, copy, piece, start, n_tokens, sequence, place, sequence_length): one row per piece of each row of `docs` (doc_id, text).

    start is the piece's first token in its document, place its first in the sequence `sequence`. length: tokens of a row, word_count of the text by default;
    a row of none or null tokens has no piece and is one row without sequence. Rows that repeat doc_id and length are told
    apart by copy (0, 1, ...); so the result depends on the rows alone, not on their partitions. Rows without doc_id are packed like others.
    """
    tokens = F.greatest(F.coalesce(length if length is not None else word_count(F.col("text")), F.lit(0)).cast("bigint"), F.lit(0).cast("bigint"))
    # repeated rows are counted before anything moves
    sizes = cut(docs.select(F.col("doc_id").cast("bigint"), tokens.alias("tokens")).groupBy("doc_id", "tokens").count())
    rows = sizes.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1)).alias("copy"))
    longest = max(options.lengths)
    pieces = F.greatest(F.ceil(F.col("tokens") / longest).cast("bigint"), F.lit(1))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)))
    rows = rows.withColumn("start", F.col("piece") * longest).withColumn("n_tokens", F.least(F.col("tokens") - F.col("start"), F.lit(longest))).drop("tokens")
    # the number of shards follows from a count of pieces; the hash spreads every document, copy and piece by itself
    total = sizes.agg(F.sum(pieces * F.col("count"))).head()[0] or 0
    shards = max(1, -(-int(total) // options.shard))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece", "n_tokens"), F.lit(shards)))
    schema = "doc_id bigint, copy bigint, piece bigint, start bigint, n_tokens bigint, sequence string, place bigint, sequence_length bigint"

    def run(part: pd.DataFrame) -> pd.DataFrame:
        shard = part["shard"].iloc[0]
        part = part.drop(columns="shard").sort_values(["n_tokens", "doc_id", "copy", "piece"], ascending=[False, True, True, True], kind="stable")
        held = part["n_tokens"].to_numpy() > 0
        own, place, lengths = pack(part["n_tokens"].to_numpy()[held], options)
        part["sequence"] = pd.Series([None] * len(part), index=part.index, dtype=object)
        part["place"] = pd.Series(pd.NA, index=part.index, dtype="Int64")
        part["sequence_length"] = pd.Series(pd.NA, index=part.index, dtype="Int64")
        part.loc[held, "sequence"] = [f"{shard}-{k}" for k in own]
        part.loc[held, "place"] = place
        part.loc[held, "sequence_length"] = np.array(lengths, np.int64)[own] if len(own) else []
        part["doc_id"] = part["doc_id"].astype("Int64")
        return part

    return rows.groupBy("shard").applyInPandas(run, schema)


def packed_tokens(docs: DataFrame, tokens: TokenOptions, options: PackingOptions = PackingOptions()) -> DataFrame:
    """`packed` by the tokens of each text and one mark of the end."""
    return packed(token_counts(docs, tokens), options, F.col("n_tokens") + 1)
