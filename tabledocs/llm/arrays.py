"""Column expressions over arrays within a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabledocs.functions.text import let

_CHUNK = 128


def total(values: Column) -> Column:
    """Sum of an array of numbers; 0 for an empty one."""
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a + v)


def sums_before(values: Column) -> Column:
    """For each element the sum of those before it, in chunks, so that the work stays near linear."""

    def finish(v: Column, bases: Column) -> Column:
        def place(_: Column, i: Column) -> Column:
            chunk = F.floor(i / _CHUNK).cast("int")
            return F.get(bases, chunk) + total(F.slice(v, chunk * _CHUNK + 1, i % _CHUNK))

        return F.transform(v, place)

    def by_chunk(v: Column) -> Column:
        chunks = F.floor((F.size(v) - 1) / _CHUNK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), chunks), lambda c: total(F.slice(v, c * _CHUNK + 1, _CHUNK)))
        bases = F.aggregate(
            sums, F.array(F.lit(0).cast("bigint")), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s))
        )
        return let(bases, lambda b: finish(v, b))

    return F.when(F.size(values) > 0, let(values, by_chunk)).otherwise(F.array().cast("array<bigint>"))
