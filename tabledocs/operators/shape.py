"""Sorting and projecting records, as DataFrame columns or as array columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tabledocs.functions.text import as_column, let, numeric_value
from tabledocs.plans.options import ShapeOptions

_NAME_PART = re.compile(r"\"([^\"]*)\"?|'([^']*)'?|([^,\"']+)|(,)")


def parse_field_list(text: str | None) -> list[str]:
    """Comma-separated names; names with spaces or commas may be quoted."""
    names, current = [], ""
    for double, single, plain, comma in _NAME_PART.findall(text or ""):
        if comma:
            names.append(current.strip())
            current = ""
        else:
            current += double + single + plain
    names.append(current.strip())
    return [n for n in names if n]


def resolve_column(names: list[str], wanted: str) -> str | None:
    """The first name that equals ``wanted`` without regard to case."""
    return next((n for n in names if n.lower() == wanted.strip().lower()), None)


def _resolved(names: list[str], wanted: list[str]) -> list[str]:
    found = [resolve_column(names, w) for w in wanted]
    return list(dict.fromkeys(f for f in found if f is not None))


def project(df: DataFrame, wanted: str | list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Select columns in the asked order, ignoring unknown names; none given keeps all."""
    names = parse_field_list(wanted) if isinstance(wanted, str) else wanted
    if not names:
        return df
    return df.select(*keep, *[F.col(f"`{c}`") for c in _resolved(df.columns, names) if c not in keep])


def sort_keys(value: Column) -> list[Column]:
    """Nulls first, then numbers by value, then other text by lower case."""
    text = value.cast("string")
    number = numeric_value(text)
    return [
        F.when(value.isNull(), 0).when(number.isNotNull(), 1).otherwise(2),
        number,
        F.when(number.isNull(), F.lower(text)),
    ]


def sort_by_field(df: DataFrame, field: str, order: str = "ascending", ordinal: str | None = None) -> DataFrame:
    """Total order by one field; a range-partitioned sort, stable by ``ordinal``."""
    ShapeOptions(sort_by=field, order=order)
    name = resolve_column(df.columns, field) if field.strip() else None
    if name is None:
        return df
    keys = sort_keys(F.col(f"`{name}`"))
    ordered = [k.asc() if order == "ascending" else k.desc() for k in keys]
    return df.orderBy(*ordered, *([F.col(ordinal).asc()] if ordinal else []))


def manipulate(df: DataFrame, options: ShapeOptions, ordinal: str | None = None) -> DataFrame:
    """Sort, then project; the sort column may be one that is dropped."""
    if options.sort_by.strip():
        df = sort_by_field(df, options.sort_by, options.order, ordinal)
    return project(df, options.fields) if options.fields.strip() else df


# -- the same on an array of maps: no shuffle, each array sorted in its row ------


def _value_of(record: Column, name: str) -> Column:
    """Value of the first key equal to ``name`` without regard to case."""
    wanted = name.strip().lower()
    return F.get(F.filter(F.map_entries(record), lambda e: F.lower(e["key"]) == wanted), F.lit(0))["value"]


def sort_records(records: Column | str, field: str, order: str = "ascending") -> Column:
    """Stable sort of an array of maps by one field."""
    ShapeOptions(sort_by=field, order=order)
    descending = order == "descending"
    if not field.strip():
        return as_column(records)

    def sort(recs: Column) -> Column:
        keyed = F.transform(
            recs,
            lambda r, i: let(
                _value_of(r, field).cast("string"),
                lambda text: let(
                    numeric_value(text),
                    lambda number: F.struct(
                        F.when(text.isNull(), 0).when(number.isNotNull(), 1).otherwise(2).alias("kind"),
                        number.alias("number"),
                        F.when(number.isNull(), F.lower(text)).alias("text"),
                        (-i if descending else i).alias("tie"),
                        i.alias("at"),
                    ),
                ),
            ),
        )
        ordered = F.reverse(F.sort_array(keyed)) if descending else F.sort_array(keyed)
        return F.transform(ordered, lambda k: F.get(recs, k["at"]))

    return let(as_column(records), sort)


def project_records(records: Column | str, wanted: str | list[str]) -> Column:
    """Keep the asked keys of each map, in the asked order and original spelling."""
    names = parse_field_list(wanted) if isinstance(wanted, str) else wanted
    if not names:
        return as_column(records)
    lowered = F.array(*[F.lit(n) for n in dict.fromkeys(n.strip().lower() for n in names)])

    def one(record: Column) -> Column:
        entries = F.map_entries(record)
        picked = let(
            entries,
            lambda es: F.filter(
                F.transform(lowered, lambda n: F.get(F.filter(es, lambda e: F.lower(e["key"]) == n), F.lit(0))),
                lambda e: e.isNotNull(),
            ),
        )
        return F.map_from_entries(picked)

    return F.transform(as_column(records), one)


def manipulate_records(records: Column | str, options: ShapeOptions) -> Column:
    out = as_column(records)
    if options.sort_by.strip():
        out = sort_records(out, options.sort_by, options.order)
    return project_records(out, options.fields) if options.fields.strip() else out
