"""Restyling the tables of a page.

Only opening tags of tables, rows, cells and captions are rewritten; all other
text is passed through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabledocs.functions.markdown import attribute
from tabledocs.functions.markup import ANY_TAG, ATTRS, balanced_levels, lossless_units
from tabledocs.functions.text import ATTRIBUTE, as_column, decode_entities, let, running_count
from tabledocs.operators.quality import sanitize_html
from tabledocs.plans.options import StyleOptions

# The text that counts as a number for alignment, and the row shade.
NUMBER = "^\\s*[+-]?(?:\\d{1,3}(?:,\\d{3})*|\\d+)(?:\\.\\d+)?\\s*%?\\s*$"
BAND_COLOR = "#f9f9f9"

# One symbol per structural tag.
_SYMBOLS = (
    ("<td", "D"), ("<tr", "R"), ("<th", "H"), ("<table", "T"), ("</table", "t"), ("<caption", "C"),
    ("<thead", "A"), ("<tfoot", "A"), ("</thead", "a"), ("</tfoot", "a"), ("<tbody", "a"), ("</tbody", "a"),
)
_TAGS = "/?table|/?thead|/?tbody|/?tfoot|caption|tr|td|th"
_WHITE_SPACE = {"wrap": "normal", "nowrap": "nowrap"}

Style = list[tuple[str, str]]


def parse_style(text: str) -> Style:
    """Declarations of a style text, split at the first colon of each."""
    out = []
    for declaration in text.split(";"):
        name, colon, value = declaration.partition(":")
        if colon and name.strip() and value.strip():
            out.append((name.strip(), value.strip()))
    return out


def merge_style(style: Style) -> dict[str, str]:
    merged: dict[str, str] = {}
    for name, value in style:
        merged[name] = value
    return merged


def table_style(o: StyleOptions) -> Style:
    out = parse_style(o.table_style)
    out += border_style(o)
    align = o.table_text_align or o.body_text_align
    if align:
        out.append(("text-align", align))
    if o.table_width:
        out.append(("width", "100%" if o.table_width == "full" else "auto"))
    return out


def border_style(o: StyleOptions) -> Style:
    pairs = (
        ("border-style", o.border_style), ("border-color", o.border_color),
        ("border-width", "" if o.border_width is None else f"{o.border_width}px"),
        ("border-radius", o.border_radius), ("border-collapse", o.border_collapse),
    )
    return [p for p in pairs if p[1]]


def row_style(o: StyleOptions) -> Style:
    return parse_style(o.row_style) + ([("text-align", o.row_text_align)] if o.row_text_align else [])


def cell_style(o: StyleOptions, header: bool) -> Style:
    align, vertical, wrap = (
        (o.header_text_align, o.header_vertical_align, o.header_wrap) if header
        else (o.body_text_align, o.body_vertical_align, o.body_wrap)
    )
    out: Style = []
    if align:
        out.append(("text-align", align))
    if vertical:
        out.append(("vertical-align", vertical))
    if wrap:
        out.append(("white-space", _WHITE_SPACE[wrap]))
    if o.border_cells:
        out += [p for p in border_style(o) if p[0] in ("border-style", "border-color", "border-width")]
    out += parse_style(o.cell_style)
    if o.cell_text_align:
        out.append(("text-align", o.cell_text_align))
    return out


def caption_style(o: StyleOptions) -> Style:
    out = parse_style(o.caption_style)
    return out + ([("caption-side", o.caption_position)] if o.caption_position else [])


def _quoted(text: str) -> str:
    return text.replace('"', "&quot;")


def _set_attribute(tag: Column, name: str, value: Column) -> Column:
    """Set an attribute of an opening tag, replacing the one it has."""
    value_of = "(?:\"[^\"]*\"|'[^']*'|[^\\s>\"']+)"
    has = f"(?is)^(<[a-z][^\\s/>]*+(?:{ATTRIBUTE})*?)([\\s/]+{name}\\s*=\\s*{value_of})"
    written = F.concat(F.lit(f' {name}="'), value, F.lit('"'))
    parts = F.struct(F.regexp_extract(tag, has, 1).alias("before"), F.regexp_extract(tag, has, 2).alias("old"))
    return let(
        parts,
        lambda p: F.when(
            p["old"] != "",
            F.concat(p["before"], written, F.substr(tag, F.length(p["before"]) + F.length(p["old"]) + F.lit(1))),
        ).otherwise(
            F.concat(F.regexp_replace(tag, "\\s*/?>\\z", ""), written, F.regexp_extract(tag, "\\s*/?>\\z", 0))
        ),
    )


def _declared(style: Style) -> str:
    return " ".join(f"{_quoted(n)}: {_quoted(v)};" for n, v in merge_style(style).items())


def _bare(name: str, style: Style) -> Column:
    """What ``_add_style`` makes of a tag without attributes."""
    return F.lit(f'<{name} style="{_declared(style)}">' if style else f"<{name}>")


def _add_style(tag: Column, style: Style) -> Column:
    """Merge declarations into the style of a tag: later ones win, and a
    declaration keeps the place where its name first stood."""
    if not style:
        return tag
    fresh = _declared(style)
    added = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(_quoted(v)).alias("v")) for n, v in style])

    def merged(present: Column) -> Column:
        own = F.filter(
            F.transform(
                F.split(present, ";"),
                lambda d: F.struct(
                    F.trim(F.substring_index(d, ":", 1)).alias("n"),
                    F.trim(F.substr(d, F.instr(d, ":") + 1)).alias("v"),
                    F.contains(d, F.lit(":")).alias("ok"),
                ),
            ),
            lambda d: d["ok"] & (d["n"] != "") & (d["v"] != ""),
        )
        every = F.concat(F.transform(own, lambda d: F.struct(d["n"].alias("n"), d["v"].alias("v"))), added)
        return let(
            every,
            lambda es: F.array_join(
                F.transform(
                    F.array_distinct(F.transform(es, lambda d: d["n"])),
                    lambda n: F.concat(
                        n, F.lit(": "), F.element_at(F.filter(es, lambda d: d["n"] == n), -1)["v"], F.lit(";")
                    ),
                ),
                " ",
            ),
        )

    # most tags have no style yet: write it before the closing bracket
    simple = F.concat(F.substr(tag, F.lit(1), F.length(tag) - 1), F.lit(f' style="{fresh}">'))
    general = let(
        attribute(tag, "style"),
        lambda present: _set_attribute(
            tag, "style", F.when(present == "", F.lit(fresh)).otherwise(merged(present))
        ),
    )
    return F.when(F.rlike(tag, F.lit("(?i)\\sstyle\\s*=|/>\\z|\\s>\\z")), general).otherwise(simple)


def _add_class(tag: Column, names: str) -> Column:
    wanted = F.array(*[F.lit(_quoted(n)) for n in names.split()])
    return let(
        attribute(tag, "class"),
        lambda present: _set_attribute(
            tag, "class",
            F.array_join(
                F.array_union(F.filter(F.split(present, "\\s+"), lambda c: c != ""), wanted), " "
            ),
        ),
    )


def _restyle_unit(unit: Column, symbol: Column, row_index: Column, caption_index: Column,
                  inner_text: Column, o: StyleOptions) -> Column:
    def on(tag_rewrite, name: str = "", bare: Column | None = None) -> Column:
        general = let(
            F.regexp_extract(unit, "(?is)^<[a-z]+" + ATTRS, 0),
            lambda tag: F.concat(tag_rewrite(tag), F.substr(unit, F.length(tag) + 1)),
        )
        if bare is None:
            return general
        # most tags have no attributes: what becomes of them is known beforehand
        return F.when(
            unit.startswith(f"<{name}>"), F.concat(bare, F.substr(unit, F.lit(len(name) + 3)))
        ).otherwise(general)

    def table(tag: Column) -> Column:
        if o.table_class.split():
            tag = let(tag, lambda t: _add_class(t, o.table_class))
        tag = let(tag, lambda t: _add_style(t, table_style(o)))
        if o.border_width is not None:
            tag = let(tag, lambda t: _set_attribute(t, "border", F.lit(str(o.border_width))))
        return tag

    base = row_style(o)

    def shade(even: bool) -> Style:
        color = (o.even_row_color if even else o.odd_row_color) if o.zebra else ""
        return base + ([("background-color", color)] if color else [])

    def bare_row() -> Column:
        if not (o.zebra or o.banded_rows == "on"):
            return _bare("tr", base)
        even = shade(True)
        if o.banded_rows == "on" and not any(n.startswith("background-color") for n, _ in even):
            even = even + [("background-color", BAND_COLOR)]
        return (
            F.when(row_index < 0, _bare("tr", base)).when(row_index % 2 == 0, _bare("tr", even))
            .otherwise(_bare("tr", shade(False)))
        )

    def row(tag: Column) -> Column:
        plain = let(tag, lambda t: _add_style(t, base))

        def shaded(even: bool) -> Column:
            style = shade(even)
            result = let(tag, lambda t: _add_style(t, style))
            if even and o.banded_rows == "on" and not any(n.startswith("background-color") for n, _ in style):
                band = let(tag, lambda t: _add_style(t, style + [("background-color", BAND_COLOR)]))
                result = F.when(F.contains(attribute(tag, "style"), F.lit("background-color")), result).otherwise(band)
            return result

        if not (o.zebra or o.banded_rows == "on"):
            return plain
        return (
            F.when(row_index < 0, plain).when(row_index % 2 == 0, shaded(True)).otherwise(shaded(False))
        )

    def data_cell(tag: Column) -> Column:
        style = cell_style(o, header=False)
        plain = let(tag, lambda t: _add_style(t, style))
        if not o.numeric_alignment:
            return plain
        aligned = let(tag, lambda t: _add_style(t, style + [("text-align", o.numeric_alignment)]))
        return F.when(F.rlike(inner_text, F.lit(NUMBER)), aligned).otherwise(plain)

    def bare_cell() -> Column:
        style = cell_style(o, header=False)
        if not o.numeric_alignment:
            return _bare("td", style)
        aligned = _bare("td", style + [("text-align", o.numeric_alignment)])
        return F.when(F.rlike(inner_text, F.lit(NUMBER)), aligned).otherwise(_bare("td", style))

    def header_cell(tag: Column) -> Column:
        return let(tag, lambda t: _add_style(t, cell_style(o, header=True)))

    out = F.when(symbol == "T", on(table))
    if base or o.zebra or o.banded_rows == "on":
        out = out.when(symbol == "R", on(row, "tr", bare_row()))
    if cell_style(o, False) or o.numeric_alignment:
        out = out.when(symbol == "D", on(data_cell, "td", bare_cell()))
    if cell_style(o, True):
        out = out.when(symbol == "H", on(header_cell, "th", _bare("th", cell_style(o, True))))
    if caption_style(o):
        out = out.when(
            (symbol == "C") & (caption_index == 1), on(lambda tag: let(tag, lambda t: _add_style(t, caption_style(o))))
        )
    return out.otherwise(unit)


def _symbol(unit: Column) -> Column:
    def choose(name: Column) -> Column:
        out = F.when(F.lit(False), F.lit("."))
        for start, symbol in _SYMBOLS:
            out = out.when(name == start, F.lit(symbol))
        return out.otherwise(F.lit("."))

    general = let(F.lower(F.regexp_extract(unit, "^</?[a-zA-Z]+(?=[\\s/>])", 0)), choose)
    return (
        F.when(unit.startswith("<td>"), F.lit("D")).when(unit.startswith("<tr>"), F.lit("R"))
        .when(unit.startswith("<th>"), F.lit("H")).otherwise(general)
    )


def _cut_tags(o: StyleOptions) -> str:
    """The tags that are rewritten, or that rows, captions and the text of cells are told by."""
    if o.numeric_alignment:
        return _TAGS
    tags = ["table"]
    if o.zebra or o.banded_rows == "on":
        tags += ["tr", "/table", "/?thead", "/?tbody", "/?tfoot"]
    elif row_style(o):
        tags.append("tr")
    if caption_style(o):
        tags += ["/table", "caption"]
    tags += ["td"] if cell_style(o, False) else []
    tags += ["th"] if cell_style(o, True) else []
    return "|".join(dict.fromkeys(tags))


def _placed(units: Column) -> Column:
    """Units as ``struct<level, pos, s, u>`` with those of one table together."""

    def place(signature: Column) -> Column:
        flat = F.array_repeat(F.lit(0), F.length(signature))
        nested = F.rlike(signature, F.lit("T[^t]*T"))
        levels = F.when(
            nested, balanced_levels(F.translate(F.regexp_replace(signature, "[^Tt]", "x"), "Tt", "Oc"))
        ).otherwise(flat)
        symbols = F.regexp_extract_all(signature, F.lit("."), F.lit(0))
        entries = F.transform(
            F.arrays_zip(
                levels.alias("level"), symbols.alias("s"),
                F.concat(F.slice(symbols, F.lit(2), F.size(symbols)), F.array(F.lit("."))).alias("after"),
                units.alias("u"),
            ),
            lambda z, i: F.struct(
                z["level"].alias("level"), i.alias("pos"), z["s"].alias("s"),
                z["after"].alias("after"), z["u"].alias("u"),
            ),
        )
        return F.when(nested, F.sort_array(entries)).otherwise(entries)

    return let(F.array_join(F.transform(units, _symbol), ""), place)


def _counted(entries: Column) -> Column:
    """Body row number and caption number within the table, per unit."""

    def by_section(sig: Column) -> Column:
        # the last section mark before a row tells whether it stands in a head or foot
        marks = F.regexp_extract_all(F.regexp_replace(sig, "[^AaT]", ""), F.lit("."), F.lit(0))
        seen = running_count(F.translate(sig, "AaT", "MMM"), "M")
        body = let(
            marks,
            lambda ms: F.array_join(
                F.zip_with(
                    F.regexp_extract_all(sig, F.lit("."), F.lit(0)), seen,
                    lambda s, n: F.when((s == "R") & F.coalesce(F.get(ms, n - 1) == "A", F.lit(False)), "h").otherwise(s),
                ),
                "",
            ),
        )
        return let(body, number)

    def number(sig: Column) -> Column:
        counts = F.arrays_zip(
            running_count(sig, "T").alias("t"), running_count(sig, "R").alias("r"),
            running_count(sig, "C").alias("c"), F.regexp_extract_all(sig, F.lit("."), F.lit(0)).alias("s"),
        )
        return let(
            counts,
            lambda cs: let(
                F.filter(cs, lambda c: c["s"] == "T"),
                lambda starts: F.transform(
                    cs,
                    lambda c: F.struct(
                        F.when(c["s"] == "h", -1).otherwise(c["r"] - F.get(starts, c["t"] - 1)["r"] - 1).alias("row"),
                        (c["c"] - F.get(starts, c["t"] - 1)["c"]).alias("caption"),
                    ),
                ),
            ),
        )

    return let(F.array_join(F.transform(entries, lambda e: e["s"]), ""), by_section)


def style_tables(
    df: DataFrame, options: StyleOptions, html: str = "html", *, sanitize: bool = True, output: str = "html"
) -> DataFrame:
    """Restyle every table of each page.  Narrow: one page, one row, no shuffle."""
    o = options
    columns = [c for c in df.columns if c != output]
    page = sanitize_html(html) if sanitize else as_column(html)
    staged = df.withColumn("__units", lossless_units(page, _cut_tags(o)))
    counted = o.zebra or o.banded_rows == "on" or caption_style(o)
    if not (counted or o.numeric_alignment):
        # no tag depends on another one
        none = F.lit(None).cast("int")
        styled = F.transform(
            "__units", lambda u: let(_symbol(u), lambda s: _restyle_unit(u, s, none, none, F.lit(""), o))
        )
        return staged.select(*columns, F.coalesce(F.array_join(styled, ""), F.col(html)).alias(output))
    staged = staged.withColumn("__placed", _placed(F.col("__units")))
    if counted:
        counts = _counted(F.col("__placed"))
    else:
        counts = F.array().cast("array<struct<row:int,caption:int>>")
    staged = staged.withColumn("__counts", counts)

    def rewrite(known: Column) -> Column:
        def one(e: Column, i: Column) -> Column:
            at = F.get(known["counts"], i)
            text = F.when(
                e["after"] != "T",
                decode_entities(F.regexp_replace(e["u"], "(?s)" + ANY_TAG, "")),
            ) if o.numeric_alignment else F.lit("")
            return F.struct(
                e["pos"].alias("pos"),
                _restyle_unit(e["u"], e["s"], at["row"], at["caption"], text, o).alias("u"),
            )

        return F.transform(known["placed"], one)

    styled = let(F.struct(F.col("__placed").alias("placed"), F.col("__counts").alias("counts")), rewrite)
    staged = staged.withColumn("__styled", styled)
    joined = let(
        F.col("__styled"),
        lambda done: F.array_join(
            F.transform(
                F.when(F.exists("__placed", lambda e: e["level"] > 0), F.sort_array(done)).otherwise(done),
                lambda x: x["u"],
            ),
            "",
        ),
    )
    return staged.select(*columns, F.coalesce(joined, F.col(html)).alias(output))
