"""CSV and JSON payload columns as nested columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabledocs.functions.text import as_column, let, trim_text

_FIELD_END, _RECORD_END = "\ufdd0", "\ufdd1"
_OBJECT, _TYPED_OBJECT = "map<string,string>", "map<string,variant>"


def _java_literal(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and ord(c) < 128 else c for c in text)


def _fields(csv: Column, delimiter: str) -> Column:
    """Fields of a payload, each with the delimiter or line end that closes it."""
    d = _java_literal(delimiter)
    char = f"[^{d}\\r\\n]" if len(delimiter) == 1 else f"(?:(?!{d})[^\\r\\n])"
    quoted = '"(?:[^"]++|"")*+"'
    end = f"{d}|\\r\\n|\\n|\\r"
    return F.regexp_extract_all(
        csv,
        F.lit(f"(?s){quoted}(?:{end}|\\z)|{char}*+(?:{end})|{char}++\\z|(?<={d})\\z"),
        F.lit(0),
    )


def csv_quote_error(csv: Column, delimiter: str = ",") -> Column:
    """True when a quoted field is not closed or is followed by other text."""
    d = _java_literal(delimiter)

    def broken(field: Column) -> Column:
        return field.startswith('"') & ~F.rlike(
            field, F.lit(f'(?s)^"(?:[^"]++|"")*+"(?:{d}|\\r\\n|\\n|\\r|\\z)$')
        )

    return F.when(
        F.contains(csv, F.lit('"')), F.exists(_fields(csv, delimiter), broken)
    ).otherwise(F.lit(False))


def csv_cells(csv: Column, delimiter: str = ",", skip_empty: bool = True) -> Column:
    """A CSV payload as an array of rows; quoted fields may hold line breaks."""
    d = _java_literal(delimiter)

    def quoted(text: Column) -> Column:
        def mark(field: Column) -> Column:
            ended = F.regexp_replace(field, f"(?s)(?:{d}|\\r\\n|\\n|\\r)\\z", "")
            literal = F.rlike(field, F.lit('(?s)^"(?:[^"]++|"")*+"'))
            last = F.when(
                F.rlike(F.regexp_replace(field, '(?s)^"(?:[^"]++|"")*+"', ""), F.lit("[\\r\\n]\\z")),
                F.lit(_RECORD_END),
            ).otherwise(F.lit(_FIELD_END))
            value = let(
                ended,
                lambda e: F.when(
                    literal & e.endswith('"'),
                    F.replace(F.substr(e, F.lit(2), F.length(e) - F.lit(2)), F.lit('""'), F.lit('"')),
                ).otherwise(e),
            )
            return F.concat(value, last)

        joined = F.array_join(F.transform(_fields(text, delimiter), mark), "")
        # the empty match at the end of the text closes the last field
        closed = F.regexp_replace(joined, f"{_FIELD_END}\\z", "")
        return F.transform(F.split(closed, _RECORD_END), lambda r: F.split(r, _FIELD_END))

    def plain(text: Column) -> Column:
        lines = F.split(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), "\n")
        return F.transform(lines, lambda line: F.split(line, d))

    def rows(text: Column) -> Column:
        parsed = F.when(F.contains(text, F.lit('"')), quoted(text)).otherwise(plain(text))
        if not skip_empty:
            return parsed
        return F.filter(parsed, lambda r: ~((F.size(r) == 1) & (F.get(r, F.lit(0)) == "")))

    marks = f"[{_FIELD_END}{_RECORD_END}]"
    clean = let(csv, lambda t: F.when(F.rlike(t, F.lit(marks)), F.regexp_replace(t, marks, "")).otherwise(t))
    return let(clean, rows)


def zip_record(headers: Column, cells: Column) -> Column:
    """Headers and cells as a map, cut to the shorter side; the last of equal
    headers wins and keeps the place of the first."""

    def pair(n: Column) -> Column:
        keys, values = F.slice(headers, F.lit(1), n), F.slice(cells, F.lit(1), n)

        def build(k: Column, v: Column) -> Column:
            unique = F.array_distinct(k)
            last = F.transform(
                unique, lambda key: F.get(v, F.size(k) - F.array_position(F.reverse(k), key).cast("int"))
            )
            return F.when(F.size(unique) == F.size(k), F.map_from_arrays(k, v)).otherwise(
                F.map_from_arrays(unique, last)
            )

        return let(keys, lambda k: let(values, lambda v: build(k, v)))

    return let(F.least(F.size(headers), F.size(cells)), pair)


def csv_records(csv: Column, delimiter: str = ",") -> Column:
    """A CSV payload with a header row as an array of maps."""
    return let(
        csv_cells(csv, delimiter),
        lambda rows: let(
            F.get(rows, F.lit(0)),
            lambda head: F.transform(F.slice(rows, F.lit(2), F.size(rows)), lambda r: zip_record(head, r)),
        ),
    )


def json_shape(json: Column) -> Column:
    """'objects', 'arrays', 'values', 'empty', 'object' or 'scalar'."""
    return let(
        json,
        lambda j: F.when(F.rlike(j, F.lit("^\\s*\\[\\s*\\{")), F.lit("objects"))
        .when(F.rlike(j, F.lit("^\\s*\\[\\s*\\[")), F.lit("arrays"))
        .when(F.rlike(j, F.lit("^\\s*\\[\\s*\\]")), F.lit("empty"))
        .when(F.rlike(j, F.lit("^\\s*\\[")), F.lit("values"))
        .when(F.rlike(j, F.lit("^\\s*\\{")), F.lit("object"))
        .otherwise(F.lit("scalar")),
    )


def json_invalid(json: Column | str) -> Column:
    """Whether a text is no JSON value.  Values are only stepped over, so that size and repeated keys do not matter."""
    c = as_column(json)
    # a second item that must be reached shows that the text is one value, and nothing more
    pair = F.from_json(
        F.concat(F.lit("["), c, F.lit(',"\\u0001"]')), "array<string>",
        {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"},
    )
    return let(pair, lambda p: F.coalesce((F.size(p) != 2) | (F.get(p, F.lit(1)) != "\u0001"), F.lit(True)))


def last_wins(record: Column) -> Column:
    """A map without repeated keys: a key stays at its first place and has its last value."""

    def merged(m: Column) -> Column:
        keys = F.array_distinct(F.map_keys(m))
        entries = F.reverse(F.map_entries(m))
        return F.map_from_arrays(
            keys, F.transform(keys, lambda k: F.get(F.filter(entries, lambda e: e["key"] == k), F.lit(0))["value"])
        )

    return let(record, lambda m: F.when(F.size(F.array_distinct(F.map_keys(m))) < F.size(m), merged(m)).otherwise(m))


def json_records(json: Column, typed: bool = False) -> Column:
    """Array of maps: the objects of an array, or a single object as one record.
    Values are text, or VARIANT when ``typed``."""
    kind = _TYPED_OBJECT if typed else _OBJECT
    return let(
        json,
        lambda j: F.when(F.rlike(j, F.lit("^\\s*\\{")), F.array(last_wins(F.from_json(j, kind)))).otherwise(
            F.transform(F.from_json(j, f"array<{kind}>"), last_wins)
        ),
    )


def json_rows(json: Column) -> Column:
    """An array of arrays, with every value as text."""
    return F.from_json(json, "array<array<string>>")


def object_items(payload: Column, unwrap: str = "convertedData", typed: bool = False) -> Column:
    """The objects an item stands for: an already converted value is unwrapped,
    internal ``__`` keys are dropped, arrays are flattened, and what is not an
    object is left out.  Text that is not JSON becomes ``{"value": text}``.
    Values are text, or VARIANT when ``typed``."""
    kind = _TYPED_OBJECT if typed else _OBJECT

    def of_value(v: Column) -> Column:
        return (
            F.when(F.rlike(v, F.lit("^\\s*\\[")), F.transform(
                F.filter(F.from_json(v, "array<string>"), lambda x: F.rlike(x, F.lit("^\\s*\\{"))),
                lambda x: last_wins(F.from_json(x, kind)),
            ))
            .when(F.rlike(v, F.lit("^\\s*\\{")), F.array(last_wins(F.from_json(v, kind))))
            .otherwise(F.array().cast(f"array<{kind}>"))
        )

    def of_item(p: Column) -> Column:
        inner = F.from_json(p, _OBJECT)
        single = let(
            inner,
            lambda m: F.when(F.map_contains_key(m, unwrap), let(m[unwrap], of_value)).otherwise(
                F.array(F.map_filter(last_wins(F.from_json(p, kind)), lambda k, _: ~k.startswith("__")))
            ),
        )
        text = F.parse_json(F.to_json(F.array(p))).try_cast("array<variant>")[0] if typed else p
        return (
            F.when(json_invalid(p), F.array(F.create_map(F.lit("value"), text)))
            .when(F.rlike(p, F.lit("^\\s*\\{")), single)
            .otherwise(of_value(p))
        )

    return let(payload, of_item)


def key_value_rows(json: Column, qualified: bool = False) -> Column:
    """A single object as (key, value) pairs; a nested object contributes its
    own keys (prefixed with the parent key when ``qualified``)."""
    typed = F.map_entries(last_wins(F.from_json(json, "map<string,variant>")))
    texts = F.map_entries(last_wins(F.from_json(json, _OBJECT)))

    def pairs(entry: Column) -> Column:
        kind, key, text = entry["kind"], entry["key"], entry["text"]
        nested = F.transform(
            F.map_entries(F.from_json(text, _OBJECT)),
            lambda e: F.struct(
                (F.concat(key, F.lit("."), e["key"]) if qualified else e["key"]).alias("key"),
                F.coalesce(e["value"], F.lit("null")).alias("value"),
            ),
        )
        own = F.array(F.struct(key.alias("key"), F.coalesce(text, F.lit("null")).alias("value")))
        return F.when(kind.startswith("OBJECT"), nested).otherwise(own)

    entries = F.zip_with(
        texts, typed,
        lambda t, v: F.struct(
            t["key"].alias("key"), t["value"].alias("text"),
            F.coalesce(F.schema_of_variant(v["value"]), F.lit("VOID")).alias("kind"),
        ),
    )
    return F.flatten(F.transform(entries, pairs))
