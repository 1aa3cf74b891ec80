"""Headers, rows and records as HTML, CSV or JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabledocs.functions.text import escape_text, let, running_count, trim_text


def minify(html: Column) -> Column:
    """Remove white space between tags and around the page."""
    return trim_text(F.regexp_replace(html, ">\\s+<", "><"))


def html_row(cells: Column, tag: str = "td") -> Column:
    body = F.array_join(
        F.transform(
            cells,
            lambda c: F.concat(F.lit(f"<{tag}>"), escape_text(F.coalesce(c, F.lit(""))), F.lit(f"</{tag}>")),
        ),
        "",
    )
    return F.concat(F.lit("<tr>"), body, F.lit("</tr>"))


def html_head(headers: Column) -> Column:
    return F.concat(F.lit("<thead>"), html_row(headers, "th"), F.lit("</thead>"))


def html_caption(caption: Column) -> Column:
    return F.when(
        caption.isNotNull() & (caption != ""),
        F.concat(F.lit("<caption>"), escape_text(caption), F.lit("</caption>")),
    ).otherwise(F.lit(""))


def html_table(headers: Column, rows: Column, caption: Column | None = None) -> Column:
    """A table element; no head when ``headers`` is empty."""
    head = F.when(F.size(headers) > 0, html_head(headers)).otherwise(F.lit(""))
    return F.concat(
        F.lit("<table>"),
        html_caption(caption) if caption is not None else F.lit(""),
        head,
        F.lit("<tbody>"),
        F.array_join(F.transform(rows, lambda r: html_row(r)), ""),
        F.lit("</tbody></table>"),
    )


def csv_field(value: Column, delimiter: str = ",") -> Column:
    """Quote a field when it holds the delimiter, a quote, a line break or outer spaces."""

    def write(text: Column) -> Column:
        special = (
            F.contains(text, F.lit(delimiter))
            | F.contains(text, F.lit('"'))
            | F.contains(text, F.lit("\n"))
            | F.contains(text, F.lit("\r"))
            | F.contains(text, F.lit("\ufeff"))
            | text.startswith(" ")
            | text.endswith(" ")
        )
        return F.when(
            special, F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        ).otherwise(text)

    return let(F.coalesce(value, F.lit("")), write)


def csv_line(cells: Column, delimiter: str = ",") -> Column:
    return F.array_join(F.transform(cells, lambda c: csv_field(c, delimiter)), delimiter)


def csv_text(headers: Column, rows: Column, delimiter: str = ",", newline: str = "\n") -> Column:
    """CSV text; with headers, every row is padded or cut to their number."""

    def lines(h: Column) -> Column:
        fitted = F.when(
            F.size(h) > 0,
            F.transform(
                rows,
                lambda r: F.transform(h, lambda _, i: F.get(r, i)),
            ),
        ).otherwise(rows)
        head = F.when(F.size(h) > 0, F.array(h)).otherwise(F.array().cast("array<array<string>>"))
        return F.array_join(F.transform(F.concat(head, fitted), lambda r: csv_line(r, delimiter)), newline)

    return let(headers, lines)


def record_headers(records: Column) -> Column:
    """Keys of the first record."""
    return F.coalesce(F.map_keys(F.get(records, F.lit(0))), F.array().cast("array<string>"))


def record_rows(records: Column, headers: Column) -> Column:
    """Records as cells in the order of the headers; a missing key is NULL."""
    return F.transform(
        records,
        lambda r: F.transform(headers, lambda h: F.try_element_at(r, h).cast("string")),
    )


def records_html(records: Column, include_headers: bool = True, caption: Column | None = None) -> Column:
    def write(recs: Column) -> Column:
        return let(
            record_headers(recs),
            lambda h: html_table(
                h if include_headers else F.array().cast("array<string>"), record_rows(recs, h), caption
            ),
        )

    return let(records, write)


def records_csv(records: Column, delimiter: str = ",", include_headers: bool = True, newline: str = "\n") -> Column:
    def write(recs: Column) -> Column:
        return let(
            record_headers(recs),
            lambda h: csv_text(
                h if include_headers else F.array().cast("array<string>"), record_rows(recs, h), delimiter, newline
            ),
        )

    return let(records, write)


def key_value_html(pairs: Column, include_headers: bool = True) -> Column:
    rows = F.transform(pairs, lambda p: F.array(p["key"], p["value"]))
    headers = F.array(F.lit("Key"), F.lit("Value")) if include_headers else F.array().cast("array<string>")
    return html_table(headers, rows)


def key_value_csv(pairs: Column, delimiter: str = ",", include_headers: bool = True) -> Column:
    rows = F.transform(pairs, lambda p: F.array(p["key"], p["value"]))
    headers = F.array(F.lit("Key"), F.lit("Value")) if include_headers else F.array().cast("array<string>")
    return csv_text(headers, rows, delimiter)


def pretty_json(json: Column, indent: int = 2) -> Column:
    """Re-indent compact JSON the way a two-space stringify does."""
    token = '(?s)"(?:[^"\\\\]++|\\\\.)*+"|[\\[\\]{},:]|[^\\[\\]{},:"]++'

    def layout(tokens: Column, symbols: Column) -> Column:
        depth = F.zip_with(
            running_count(symbols, "o"), running_count(symbols, "c"), lambda up, down: up - down
        )

        def line(d: Column) -> Column:
            return F.concat(F.lit("\n"), F.repeat(F.lit(" " * indent), d))

        kinds = F.regexp_extract_all(symbols, F.lit("."), F.lit(0))
        z = F.arrays_zip(tokens.alias("t"), depth.alias("d"), kinds.alias("k"))

        def write(ks: Column) -> Column:
            return F.array_join(
                F.transform(
                    z,
                    lambda e, i: F.when(
                        e["k"] == "o",
                        F.when(F.get(ks, i + 1) == "c", e["t"]).otherwise(F.concat(e["t"], line(e["d"]))),
                    )
                    .when(
                        e["k"] == "c",
                        F.when((i > 0) & (F.get(ks, i - 1) == "o"), e["t"]).otherwise(F.concat(line(e["d"]), e["t"])),
                    )
                    .when(e["t"] == ",", F.concat(F.lit(","), line(e["d"])))
                    .when(e["t"] == ":", F.lit(": "))
                    .otherwise(e["t"]),
                ),
                "",
            )

        return let(kinds, write)

    def start(tokens: Column) -> Column:
        symbols = F.array_join(
            F.transform(
                tokens,
                lambda t: F.when(t.isin("{", "["), "o").when(t.isin("}", "]"), "c").otherwise("x"),
            ),
            "",
        )
        return let(symbols, lambda s: layout(tokens, s))

    return let(F.regexp_extract_all(json, F.lit(token), F.lit(0)), start)
