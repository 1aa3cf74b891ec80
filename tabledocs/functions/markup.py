"""HTML tables as nested columns.

One document is one row, so reading its tables is a projection: the page text is
normalised by one regular expression pass into a string whose structure is
marked by bracketed tag names, and that string is split into tables,
rows and cells.  No explode, window or shuffle is involved, whatever the number
of documents, and the cost is linear in the size of the page.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabledocs.functions.markdown import INLINE_TAGS, inline_to_markdown, known_to_markdown, number_lists, write_lists
from tabledocs.functions.text import NONCHARACTERS, decode_entities, let, running_count, trim_short, trim_text

# Brackets (Unicode noncharacters) around the name of a structural tag in a normalised page.
OPEN, SHUT = "\ufdd0", "\ufdd1"
# Used only where nested tables are told apart.
TABLE_MARK, TABLE_END_MARK = "\ufdd2", "\ufdd3"
NUMBERED = "\ufddb"                    # ends the number given to an un-nested table

# The attribute part of a tag.  Possessive, so it neither backtracks nor recurses;
# an unquoted "<" ends it, so an unclosed tag does not search the rest of the page.
ATTRS = "(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
NAME_END = "(?=[\\s/>])"
RAW = (
    "<!--.*?(?:-->|\\z)"
    "|<script(?=[\\s/>])" + ATTRS + ".*?(?:</script\\s*>|\\z)"
    "|<style(?=[\\s/>])" + ATTRS + ".*?(?:</style\\s*>|\\z)"
)
ANY_TAG = "</?[a-zA-Z]" + ATTRS + "|<[!?]" + ATTRS

TABLE_RESULT = (
    "array<struct<table_no:int,depth:int,caption:string,headers:array<string>,"
    "rows:array<array<string>>>>"
)


def drop_noncharacters(html: Column) -> Column:
    return let(
        html,
        lambda h: F.when(
            # pages of ASCII are not searched
            (F.octet_length(h) != F.length(h)) & F.rlike(h, F.lit("[\ufdd0-\ufdef]")), F.translate(h, NONCHARACTERS, "")
        ).otherwise(h),
    )


def keep_tags(html: Column, names: str, *, also: str = "") -> Column:
    """Bracket the tags in ``names``, keep those in ``also``, remove all others."""
    spare = f"(?!/?(?:{also})[\\s/>])" if also else ""
    # one "<" before all alternatives, so that other characters are passed by at once
    raw = RAW.removeprefix("<").replace("|<script", "|script").replace("|<style", "|style")
    pattern = f"(?is)<(?:(/?)({names}){NAME_END}{ATTRS}|{raw}|{spare}/?[a-z]{ATTRS}|[!?]{ATTRS})"
    return F.regexp_replace(drop_noncharacters(html), pattern, f"{OPEN}$1$2{SHUT}")


def lossless_units(html: Column, tags: str) -> Column:
    """Cut a page before every one of ``tags``; joined again it is the same page.

    ``tags`` is a pattern such as ``/?table|tr``.  Comments, scripts and styles
    are stepped over, and quoted attribute values may contain anything.
    """
    rest = f"(?:[^<]++|{RAW}|<(?!(?:{tags})[\\s/>])(?:[a-z/!?]{ATTRS})?+)"
    return F.regexp_extract_all(
        html, F.lit(f"(?is)<(?:{tags}){NAME_END}{ATTRS}{rest}*+|{rest}++|<"), F.lit(0)
    )


def numbered_tables(html: Column) -> Column:
    """Only the numbers of the tables of a page, in the shape of ``tables_column``."""
    opens = F.filter(lossless_units(html, "/?table"), lambda u: F.rlike(u, F.lit("^<[tT]")))
    return F.transform(
        opens,
        lambda u, i: F.struct((i + 1).alias("table_no"), F.lit(None).cast("string").alias("caption")),
    )


# The tags that carry table structure, as names and as one pattern without repeated beginnings.
STRUCTURE = ("table", "thead", "tbody", "tfoot", "caption", "tr", "td", "th")
STRUCTURE_NAMES = "t(?:[rdh]|able|head|body|foot)|caption"

TABLE, TABLE_END = f"{OPEN}table{SHUT}", f"{OPEN}/table{SHUT}"
ROW, CELL, HEADER_CELL = f"{OPEN}tr{SHUT}", f"{OPEN}td{SHUT}", f"{OPEN}th{SHUT}"
HEAD, CAPTION = f"{OPEN}thead{SHUT}", f"{OPEN}caption{SHUT}"
SECTION = f"{OPEN}(?:/thead|/?tbody|/?tfoot){SHUT}"


def _structure(bracketed: Column) -> Column:
    """Names of structural tags in lower case, and no other brackets."""

    def lower(text: Column) -> Column:
        any_case = text
        for name in STRUCTURE:
            any_case = F.regexp_replace(any_case, f"(?i){OPEN}(/?){name}{SHUT}", f"{OPEN}$1{name}{SHUT}")
        upper = F.rlike(text, F.lit(f"{OPEN}/?[a-z]*+[A-Z]"))
        return F.replace(F.when(upper, any_case).otherwise(text), F.lit(OPEN + SHUT), F.lit(""))

    return let(bracketed, lower)


def normalise_tables(html: Column, cell_format: str = "text") -> Column:
    """A page as text plus bracketed names of structural tags; everything else is removed."""
    if cell_format == "markdown":
        # items of lists that are not flat are left as marks; they are numbered per cell
        def general(page: Column) -> Column:
            return inline_to_markdown(_structure(keep_tags(page, STRUCTURE_NAMES, also=INLINE_TAGS)), OPEN)

        def read(page: Column) -> Column:
            # most pages have nothing but known tags and plain links; what looks like any other tag is left by these
            brackets = {end + name: f"{OPEN}{end}{name}{SHUT}" for name in STRUCTURE for end in ("", "/")}
            return let(
                known_to_markdown(page, brackets, OPEN),
                lambda text: F.when(F.contains(text, F.lit("<")) & F.rlike(text, F.lit("<[/a-zA-Z!?]")), general(page)).otherwise(text),
            )

        return write_lists(decode_entities(let(drop_noncharacters(html), read)), OPEN)
    if cell_format != "text":
        raise ValueError("cell_format must be 'text' or 'markdown'")
    return decode_entities(_structure(keep_tags(html, STRUCTURE_NAMES)))


def balanced_levels(signature: Column, opening: str = "O", closing: str = "c") -> Column:
    """Nesting level after each symbol of a string of opening and closing symbols.

    Closing symbols without a partner are ignored, as a page reader does.  Each
    pass resolves the innermost pairs; as many passes run as the string is deep.
    """

    def deepest(sig: Column) -> Column:
        # a bar begins anew; nothing is paired deeper than there are closing symbols
        return F.aggregate(
            F.regexp_extract_all(sig, F.lit(f"{opening}+|{closing}+|[^{opening}{closing}]"), F.lit(0)),
            F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
            lambda acc, run: let(
                F.when(run.startswith(opening), acc["now"] + F.length(run)).when(run.startswith(closing), F.greatest(acc["now"] - F.length(run), F.lit(0))).otherwise(F.when(run == "|", F.lit(0)).otherwise(acc["now"])),
                lambda now: F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most")),
            ),
            lambda acc: F.least(acc["most"], F.length(sig) - F.length(F.replace(sig, F.lit(closing), F.lit("")))),
        )

    def levels(sig: Column, passes: Column) -> Column:
        paired = F.aggregate(
            F.sequence(F.lit(1), F.greatest(passes, F.lit(1))),
            sig,
            lambda text, _: F.regexp_replace(text, f"{opening}(x*+){closing}", "x$1x"),
        )
        cleaned = F.array_join(
            F.zip_with(
                F.regexp_extract_all(sig, F.lit("."), F.lit(0)),
                F.regexp_extract_all(paired, F.lit("."), F.lit(0)),
                lambda was, now: F.when(now == closing, F.lit("z")).otherwise(was),
            ),
            "",
        )
        return let(
            cleaned,
            lambda c: F.zip_with(
                running_count(c, opening), running_count(c, closing), lambda up, down: up - down
            ),
        )

    return let(signature, lambda sig: let(deepest(sig), lambda n: levels(sig, n)))


def _flat_tables(pieces: Column) -> Column:
    return F.transform(
        F.slice(pieces, F.lit(2), F.size(pieces)),
        lambda piece, i: F.struct(
            (i + 1).alias("table_no"),
            F.lit(1).alias("depth"),
            F.substring_index(piece, TABLE_END, 1).alias("body"),
        ),
    )


def _nested_tables(text: Column) -> Column:
    """Un-nest: a stable sort on the nesting level makes every table contiguous."""
    marked = F.replace(
        F.replace(text, F.lit(TABLE), F.lit(TABLE_MARK)), F.lit(TABLE_END), F.lit(TABLE_END_MARK)
    )
    pieces = F.regexp_extract_all(
        marked, F.lit(f"[{TABLE_MARK}{TABLE_END_MARK}][^{TABLE_MARK}{TABLE_END_MARK}]*"), F.lit(0)
    )

    def reorder(parts: Column, signature: Column) -> Column:
        located = F.zip_with(
            F.arrays_zip(
                balanced_levels(signature).alias("level"),
                running_count(signature, "O").alias("no"),
            ),
            parts,
            lambda at, part: F.struct(
                at["level"].alias("level"), at["no"].alias("no"), part.alias("part")
            ),
        )
        placed = F.transform(
            located,
            lambda e, i: F.struct(
                e["level"].alias("level"),
                i.alias("pos"),
                F.when(
                    e["part"].startswith(TABLE_MARK),
                    F.concat(F.lit(TABLE_MARK), e["no"], F.lit(","), e["level"], F.lit(NUMBERED), F.substr(e["part"], F.lit(2))),
                ).otherwise(F.substr(e["part"], F.lit(2))).alias("part"),
            ),
        )
        inside = F.filter(F.sort_array(placed), lambda e: e["level"] > 0)
        joined = F.array_join(F.transform(inside, lambda e: e["part"]), "")
        return let(
            F.split(joined, TABLE_MARK),
            lambda p: F.sort_array(
                F.transform(
                    F.slice(p, F.lit(2), F.size(p)),
                    lambda piece: F.struct(
                        F.substring_index(piece, ",", 1).cast("int").alias("table_no"),
                        F.substring_index(F.substring_index(piece, NUMBERED, 1), ",", -1).cast("int").alias("depth"),
                        F.substr(piece, F.instr(piece, NUMBERED) + F.lit(1)).alias("body"),
                    ),
                )
            ),
        )

    return let(
        pieces,
        lambda parts: let(
            F.array_join(
                F.transform(parts, lambda p: F.when(p.startswith(TABLE_MARK), F.lit("O")).otherwise(F.lit("c"))), ""
            ),
            lambda signature: reorder(parts, signature),
        ),
    )


def _read_table(entry: Column, cell_format: str) -> Column:
    if cell_format == "markdown":
        def clean(cell: Column) -> Column:
            return trim_short(number_lists(F.substr(cell, F.lit(len(CELL) + 1))))
    else:
        def clean(cell: Column) -> Column:
            return trim_short(F.substr(cell, F.lit(len(CELL) + 1)))

    body = entry["body"]
    caption = F.when(
        F.contains(body, F.lit(CAPTION)),
        trim_text(F.regexp_extract(body, f"{CAPTION}([^{OPEN}]*)", 1)),
    )

    def first_of_head(before: Column) -> Column:
        after = F.substr(body, F.length(before) + F.lit(len(HEAD) + 1))
        inside = F.contains(after, F.lit(ROW)) & ~F.rlike(F.substring_index(after, ROW, 1), F.lit(SECTION))
        return F.when(inside, F.size(F.split(before, ROW))).otherwise(0)

    head_row = F.when(
        F.contains(body, F.lit(HEAD)), let(F.substring_index(body, HEAD, 1), first_of_head)
    ).otherwise(0)

    def shape(rows: Column, head: Column) -> Column:
        first = F.get(rows, F.lit(0))
        in_head = F.get(rows, head - 1)
        header_no = (
            F.when((head > 0) & (F.size(in_head) > 0), head)
            .when(F.exists(first, lambda c: c.startswith(HEADER_CELL)), F.lit(1))
            .otherwise(F.lit(0))
        )

        def assemble(number: Column) -> Column:
            by_head = (number > 0) & (number == head)
            headers = (
                F.when(by_head, F.transform(in_head, clean))
                .when(number > 0, F.transform(F.filter(first, lambda c: c.startswith(HEADER_CELL)), clean))
                .otherwise(F.array().cast("array<string>"))
            )
            data = F.filter(rows, lambda _, i: (i + 1) != number)
            return F.struct(
                entry["table_no"].alias("table_no"),
                entry["depth"].alias("depth"),
                caption.alias("caption"),
                headers.alias("headers"),
                F.transform(data, lambda r: F.transform(r, clean)).alias("rows"),
            )

        return let(header_no, assemble)

    rows = let(
        F.split(body, ROW),
        lambda p: F.transform(
            F.slice(p, F.lit(2), F.size(p)),
            lambda r: F.regexp_extract_all(
                r, F.lit(f"{OPEN}t[dh]{SHUT}[^{OPEN}]*+"), F.lit(0)
            ),
        ),
    )
    return let(rows, lambda r: let(head_row, lambda h: shape(r, h)))


def tables_column(html: Column, cell_format: str = "text") -> Column:
    """All tables of a page, in document order.

    A nested table owns its own rows; text of the inner table is not repeated in
    the outer one.  Result: array of
    ``struct<table_no, depth, caption, headers, rows>``.
    """

    def read(text: Column, pieces: Column) -> Column:
        # a table is nested where another begins before its end
        nested = F.exists(
            F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0))),
            lambda piece: ~F.contains(piece, F.lit(TABLE_END)),
        )
        bodies = F.when(nested, _nested_tables(text)).otherwise(_flat_tables(pieces))
        return F.transform(bodies, lambda e: _read_table(e, cell_format))

    return let(
        normalise_tables(html, cell_format),
        lambda text: let(F.split(text, TABLE), lambda pieces: read(text, pieces)),
    )


def _outline(html: Column, headings: str) -> Column:
    """Table starts and heading texts of a page, in document order."""
    text = decode_entities(keep_tags(html, "table|/?" + headings))
    # a heading's text ends at the next tag, its own end among them
    pattern = f"(?i){OPEN}(?:table|{headings}){SHUT}[^{OPEN}]*"
    return F.transform(
        F.regexp_extract_all(
            F.replace(text, F.lit(OPEN + SHUT), F.lit("")), F.lit(pattern), F.lit(0)
        ),
        lambda e: F.struct(
            F.lower(F.substr(F.substring_index(e, SHUT, 1), F.lit(2))).alias("name"),
            trim_short(F.substring_index(e, SHUT, -1)).alias("text"),
        ),
    )


def _named(events: Column, name: str) -> Column:
    return F.filter(events, lambda e: e["name"] == name)


HEADING_PATH_TYPE = "array<struct<level:int,text:string>>"


def heading_paths(html: Column) -> Column:
    """For every table of a page: the h1 to h5 headings it stands under.

    A heading of level k is on the path when it came after the last heading of
    every higher rank, which is what popping a stack of headings leaves.
    """
    levels = range(1, 6)

    def with_signature(events: Column, signature: Column) -> Column:
        numbered = F.transform(
            events,
            lambda e, i: F.struct(i.alias("at"), e["name"].alias("name"), e["text"].alias("text")),
        )

        def on_page(k: int, value: Column) -> Column:
            # levels that a page does not have are not looked up
            return F.when(F.contains(signature, F.lit(str(k))), value)

        known = F.struct(
            *[on_page(k, _named(numbered, f"h{k}")).alias(f"h{k}") for k in levels],
            *[on_page(k, running_count(signature, str(k))).alias(f"n{k}") for k in levels],
        )

        def path(seen: Column, at: Column) -> Column:
            last = [F.get(seen[f"h{k}"], F.get(seen[f"n{k}"], at) - 1) for k in levels]
            where = [F.coalesce(h["at"], F.lit(-1)) for h in last]
            steps = []
            for k in levels:
                above = where[: k - 1]
                on_path = last[k - 1].isNotNull()
                if above:
                    on_path = on_path & (where[k - 1] > (F.greatest(*above) if len(above) > 1 else above[0]))
                steps.append(
                    F.when(on_path, F.struct(F.lit(k).alias("level"), last[k - 1]["text"].alias("text")))
                )
            return F.filter(F.array(*steps), lambda s: s.isNotNull())

        return let(
            known,
            lambda seen: F.transform(
                F.filter(numbered, lambda e: e["name"] == "table"), lambda e: path(seen, e["at"])
            ),
        )

    def build(events: Column) -> Column:
        signature = F.array_join(
            F.transform(events, lambda e: F.when(e["name"] == "table", F.lit("T")).otherwise(F.substr(e["name"], F.lit(2)))), ""
        )
        return let(signature, lambda s: with_signature(events, s))

    return let(_outline(html, "h[1-5]"), build)


def under_heading_number(html: Column, level: int, text: str, index: int) -> Column:
    """Number of the ``index``-th table after the first matching heading, or NULL."""
    name = f"h{level}"
    wanted = text.strip().lower() if text else ""

    def locate(events: Column) -> Column:
        signature = F.array_join(
            F.transform(
                events,
                lambda e: F.when(e["name"] == "table", F.lit("T"))
                .when(
                    (e["name"] == name) & (F.contains(F.lower(e["text"]), F.lit(wanted)) if wanted else F.lit(True)),
                    F.lit("m"),
                )
                .otherwise(F.lit("o")),
            ),
            "",
        )

        def count(s: Column) -> Column:
            before = F.length(F.replace(F.substring_index(s, "m", 1), F.lit("o"), F.lit("")))
            total = F.length(F.regexp_replace(s, "[^T]", ""))
            number = before + F.lit(index)
            return F.when(F.contains(s, F.lit("m")) & (number <= total), number)

        return let(signature, count)

    return let(_outline(html, name), locate)
