"""Tables of one page as JSON nested by heading.

Tables are ordered so that those sharing the start of a path are neighbours, in
order of first appearance; the brackets between two neighbours follow from how
much of their paths they share.  Sorting keeps this at n log n per page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from tabledocs.functions.text import let, running_count

_SEP, _NEXT = "\ufdd0", "\ufdd1"
# Up to this many tables of a page, looking each path up among all is cheaper than sorting; above, paths are sorted.
_FEW = 32
_LEVELS = range(1, 7)          # five headings and one level for ``_data``


# Texts whose words are plain and one space apart need no cleaning.
_PLAIN = "^[A-Za-z0-9\\-]++(?:[ _][A-Za-z0-9\\-]++)*+$"


def heading_key(text: Column) -> Column:
    """Heading text as an object key: letters, digits, ``_`` and ``-``."""
    kept = F.regexp_replace(text, "[^\\p{L}\\p{N}_\\s\\u00A0\\-]", "")
    cleaned = F.regexp_replace(F.regexp_replace(kept, "[\\s\\u00A0]+", "_"), "^_+|_+$", "")
    return F.when(F.rlike(text, F.lit(_PLAIN)), F.replace(text, F.lit(" "), F.lit("_"))).otherwise(cleaned)


def heading_keys(table: Column) -> Column:
    """Path of keys of a table; ``table_n`` where there is no usable heading."""
    keys = F.transform(table["heading_path"], lambda h: heading_key(h["text"]))
    return let(
        F.filter(keys, lambda k: k != ""),
        lambda ks: F.when(F.size(ks) > 0, ks).otherwise(
            F.array(F.concat(F.lit("table_"), table["table_no"]))
        ),
    )


def _prefix(path: Column, level: int) -> Column:
    return F.when(F.size(path) >= level, F.array_join(F.slice(path, F.lit(1), F.lit(level)), _SEP))


def _groups(items: Column, key) -> Column:
    """Per item (in item order): first member, rank in group, longest path of its group."""
    entries = F.sort_array(
        F.transform(
            items,
            lambda x, i: F.struct(key(x).alias("key"), i.alias("i"), F.size(x["path"]).alias("n")),
        )
    )

    def starts(es: Column) -> Column:
        flags = F.transform(
            es,
            lambda e, j: F.when((j > 0) & F.coalesce(F.get(es, j - 1)["key"] == e["key"], F.lit(False)), ".").otherwise("S"),
        )
        return F.array_join(flags, "")

    longest = F.sort_array(
        F.transform(items, lambda x: F.struct(key(x).alias("key"), (-F.size(x["path"])).alias("i")))
    )

    def number(es: Column, sig: Column, sig_longest: Column, ls: Column) -> Column:
        group = running_count(sig, "S")
        first_at = F.filter(F.transform(F.arrays_zip(es.alias("e"), F.regexp_extract_all(sig, F.lit("."), F.lit(0)).alias("s")),
                            lambda z, j: F.when(z["s"] == "S", F.struct(j.alias("j"), z["e"]["i"].alias("i")))), lambda x: x.isNotNull())
        deepest = F.filter(F.transform(F.arrays_zip(ls.alias("e"), F.regexp_extract_all(sig_longest, F.lit("."), F.lit(0)).alias("s")),
                           lambda z: F.when(z["s"] == "S", F.struct((-z["e"]["i"]).alias("n")))), lambda x: x.isNotNull())
        return let(
            F.struct(first_at.alias("f"), deepest.alias("d")),
            lambda known: F.sort_array(
                F.transform(
                    F.arrays_zip(es.alias("e"), group.alias("g")),
                    lambda z, j: F.struct(
                        z["e"]["i"].alias("i"),
                        F.when(z["e"]["key"].isNotNull(), F.get(known["f"], z["g"] - 1)["i"]).alias("first"),
                        (j - F.get(known["f"], z["g"] - 1)["j"] + 1).alias("rank"),
                        F.get(known["d"], z["g"] - 1)["n"].alias("longest"),
                    ),
                )
            ),
        )

    return let(
        entries,
        lambda es: let(
            longest,
            lambda ls: let(starts(es), lambda sig: let(starts(ls), lambda sl: number(es, sig, sl, ls))),
        ),
    )


def with_paths(tables: Column, duplicates: str = "append") -> Column:
    """``struct<path, data>`` per table, where ``data`` is JSON array content."""

    def plain(ts: Column) -> Column:
        return F.transform(
            ts, lambda t: F.struct(heading_keys(t).alias("path"), t["data"].alias("data"))
        )

    def numbered(items: Column, ranks: Column) -> Column:
        return F.zip_with(
            items, ranks,
            lambda x, rank: F.struct(
                F.when(
                    rank > 1,
                    F.concat(
                        F.slice(x["path"], F.lit(1), F.size(x["path"]) - 1),
                        F.array(F.concat(F.element_at(x["path"], -1), F.lit("_"), rank)),
                    ),
                ).otherwise(x["path"]).alias("path"),
                x["data"].alias("data"),
            ),
        )

    def suffixed(items: Column) -> Column:
        def of_few(all_paths: Column) -> Column:
            # how many of the paths so far are not left when those equal to the last are removed
            return F.transform(all_paths, lambda p, i: i + 1 - F.size(F.array_remove(F.slice(all_paths, F.lit(1), i + 1), p)))

        ranks = F.when(F.size(items) <= _FEW, let(_joined(items), of_few)).otherwise(
            F.transform(_groups(items, lambda x: F.array_join(x["path"], _SEP)), lambda r: r["rank"])
        )
        return numbered(items, ranks)

    items = let(tables, plain)
    return let(items, suffixed) if duplicates == "suffix" else items


def mark_own_data(items: Column) -> Column:
    """A node with rows and children keeps its rows under ``_data``."""

    def own(x: Column, below: Column) -> Column:
        return F.struct(
            F.when(below, F.concat(x["path"], F.array(F.lit("_data")))).otherwise(x["path"]).alias("path"), x["data"].alias("data")
        )

    def by_search(xs: Column) -> Column:
        def write(all_paths: Column, text: Column) -> Column:
            return F.zip_with(xs, all_paths, lambda x, p: own(x, F.contains(text, F.concat(F.lit(_NEXT), p, F.lit(_SEP)))))

        return let(_joined(xs), lambda ps: let(F.concat(F.lit(_NEXT), F.array_join(ps, _NEXT)), lambda text: write(ps, text)))

    def by_sorting(xs: Column) -> Column:
        # only below the longest path can a node have both
        info = let(_deepest(xs), lambda n: F.struct(*[F.when(n > k, _level_groups(xs, k)).alias(f"g{k}") for k in range(1, 6)]))

        def write(known: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                longest = F.coalesce(
                    *[F.when(F.size(x["path"]) == k, F.get(known[f"g{k}"], i)["longest"]) for k in range(1, 6)]
                )
                return own(x, longest > F.size(x["path"]))

            return F.transform(xs, one)

        return let(info, write)

    def extend(xs: Column) -> Column:
        return F.when(F.size(xs) <= _FEW, by_search(xs)).otherwise(by_sorting(xs))

    return let(items, extend)


def order_by_path(items: Column) -> Column:
    """Items ordered by the first appearance of each step of their path."""

    def arranged(xs: Column, firsts: Callable[[Column, Column], list[Column]]) -> Column:
        keys = F.sort_array(
            F.transform(xs, lambda x, i: F.struct(*[f.alias(f"k{k}") for k, f in zip(_LEVELS, firsts(x, i), strict=True)], i.alias("i")))
        )
        return F.transform(keys, lambda s: F.get(xs, s["i"]))

    def by_search(xs: Column) -> Column:
        def starts(n: Column, paths: Column) -> Column:
            def level(k: int) -> Column:
                return F.when(n >= k, F.transform(paths, lambda p: F.substring_index(p, _SEP, k)))

            return F.struct(*[level(k).alias(f"g{k}") for k in _LEVELS])

        def write(known: Column) -> Column:
            return arranged(
                xs,
                lambda x, i: [
                    F.when(F.size(x["path"]) >= k, F.array_position(known[f"g{k}"], F.get(known[f"g{k}"], i))).otherwise(F.lit(-1).cast("bigint")) for k in _LEVELS
                ],
            )

        return let(_joined(xs), lambda ps: let(_deepest(xs), lambda n: let(starts(n, ps), write)))

    def by_sorting(xs: Column) -> Column:
        info = let(_deepest(xs), lambda n: F.struct(*[F.when(n >= k, _level_groups(xs, k)).alias(f"g{k}") for k in _LEVELS]))
        return let(info, lambda known: arranged(xs, lambda x, i: [F.coalesce(F.get(known[f"g{k}"], i)["first"], F.lit(-1)) for k in _LEVELS]))

    def sort(xs: Column) -> Column:
        return F.when(F.size(xs) <= _FEW, by_search(xs)).otherwise(by_sorting(xs))

    return let(items, sort)


def _joined(xs: Column) -> Column:
    return F.transform(xs, lambda x: F.array_join(x["path"], _SEP))


def _deepest(xs: Column) -> Column:
    return F.array_max(F.transform(xs, lambda x: F.size(x["path"])))


def _level_groups(xs: Column, level: int) -> Column:
    return _groups(xs, lambda x: _prefix(x["path"], level))


def _key(name: Column) -> Column:
    # keys hold letters, digits, "_" and "-" only, so there is nothing to escape
    return F.concat(F.lit('"'), name, F.lit('":'))


def nested_json(ordered: Column) -> Column:
    """The JSON object of items that are ordered by path."""

    def shared(a: Column, b: Column) -> Column:
        count = F.lit(len(_LEVELS))
        for k in reversed(range(len(_LEVELS))):
            count = F.when(F.coalesce(F.get(a, F.lit(k)) == F.get(b, F.lit(k)), F.lit(False)), count).otherwise(F.lit(k))
        return count

    def opening(path: Column, start: Column) -> Column:
        """Open the path from step ``start`` (0-based) down to the array."""
        return F.array_join(
            F.transform(
                F.slice(path, start + 1, F.size(path) - start),
                lambda k, i: F.concat(_key(k), F.when(start + i + 1 == F.size(path), "[").otherwise("{")),
            ),
            "",
        )

    def write(xs: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            path = x["path"]
            before = F.get(xs, i - 1)["path"]

            def joined(c: Column) -> Column:
                size_before = F.size(before)
                again = (c == F.size(path)) & (c == size_before)
                return (
                    F.when(i == 0, F.concat(F.lit("{"), opening(path, F.lit(0))))
                    .when(again, F.lit(""))
                    .otherwise(
                        F.concat(
                            F.lit("]"), F.repeat(F.lit("}"), size_before - c - 1), F.lit(","), opening(path, c)
                        )
                    )
                )

            data = F.when(x["data"] != "", F.concat(F.lit(_NEXT), x["data"])).otherwise(F.lit(""))
            return F.concat(let(shared(path, before), joined), data)

        last = F.get(xs, F.size(xs) - 1)["path"]
        return F.when(F.size(xs) == 0, F.lit("{}")).otherwise(
            F.concat(
                F.replace(
                    F.replace(F.array_join(F.transform(xs, one), ""), F.lit("[" + _NEXT), F.lit("[")),
                    F.lit(_NEXT), F.lit(","),
                ),
                F.lit("]"), F.repeat(F.lit("}"), F.size(last)),
            )
        )

    return let(ordered, write)
