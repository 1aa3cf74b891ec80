"""Guards, validation and sanitising of payload columns.

Every check is an expression that yields an error text or NULL, so bad payloads
can be set aside in a ``rejects`` frame instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tabledocs.functions.text import as_column, is_blank, let, trim_text
from tabledocs.functions.payload import csv_cells, csv_quote_error, json_invalid, json_shape

# Input limits.  They hold only where a caller passes them to a guard.
MAX_HTML_BYTES = 10 * 1024 * 1024
MAX_JSON_BYTES = 50 * 1024 * 1024
MAX_DEPTH = 100

# Elements without content, and those whose end may be left out: neither nests.
_FLAT_ELEMENTS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
    "p", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "colgroup", "option", "optgroup", "rt", "rp",
)

# Elements and attributes that can carry active content.
DANGEROUS_ELEMENTS = (
    "script", "iframe", "object", "embed", "form", "input", "button", "select", "textarea",
    "meta", "link", "style", "noscript", "applet", "frame", "frameset",
)
DANGEROUS_ATTRIBUTES = (
    "onabort", "onblur", "onchange", "onclick", "ondblclick", "onerror", "onfocus",
    "onkeydown", "onkeypress", "onkeyup", "onload", "onmousedown", "onmousemove",
    "onmouseout", "onmouseover", "onmouseup", "onreset", "onresize", "onselect",
    "onsubmit", "onunload", "javascript:", "data:text/html", "vbscript:",
)
# Of these the closing tag does not exist, so only the tag itself goes.
_EMPTY_ELEMENTS = ("embed", "input", "meta", "link", "frame")


def _remove_element(html: Column, name: str) -> Column:
    """Remove whole elements; an opening tag that is never closed stays.

    After an unclosed tag no closing tag can follow, so the second alternative
    takes the rest of the page in one step and the cost stays linear.
    """
    start = f"<{name}(?:\\s[^<>]*)?>"
    return F.regexp_replace(html, f"(?is){start}.*?</{name}\\s*>|({start}.*\\z)", "$1")


def sanitize_html(html: Column | str) -> Column:
    """Remove active content from a page.

    Each group of replacements runs only on pages where one search finds
    something for it to do.
    """

    def elements(names: list[str]):
        def remove(text: Column) -> Column:
            out = text
            for name in names:
                out = _remove_element(out, name)
            return F.when(F.rlike(text, F.lit(f"(?i)</(?:{'|'.join(names)})[\\s>]")), out).otherwise(text)

        return remove

    def empty_tags(text: Column) -> Column:
        empty, every = "|".join(_EMPTY_ELEMENTS), "|".join(DANGEROUS_ELEMENTS)
        pattern = f"(?i)</?(?:{empty})(?:\\s[^<>]*)?>|<(?:{every})(?:\\s[^<>]*)?/>"
        return F.regexp_replace(text, pattern, "")

    def all_elements(text: Column) -> Column:
        out = let(let(text, elements(common)), elements(rare))
        # one look at each tag, by its first letters, tells pages without any such element
        initials = "".join(f"[{''.join(sorted({n[i] for n in DANGEROUS_ELEMENTS}))}]" for i in range(3))
        found = f"(?i)<(?=/?{initials})/?(?:{'|'.join(DANGEROUS_ELEMENTS)})"
        return F.when(F.rlike(text, F.lit(found)), empty_tags(out)).otherwise(text)

    def attributes(text: Column) -> Column:
        names = "|".join(DANGEROUS_ATTRIBUTES)
        out = F.regexp_replace(
            text, f"(?i)\\s(?:{names})[^\\s=>\"']*\\s*=\\s*(?:\"[^\"]*\"|'[^']*'|[^\\s>\"']+)", ""
        )
        for attribute, schemes in (
            ("href", "javascript:|vbscript:"), ("src", "javascript:|vbscript:|data:text/html")
        ):
            out = F.regexp_replace(
                out,
                f"(?i)\\b{attribute}\\s*=\\s*(?:\"\\s*(?:{schemes})[^\"]*\"|'\\s*(?:{schemes})[^']*')",
                f'{attribute}="#"',
            )
        suspect = F.rlike(text, F.lit("[\\t-\\r ][oO][nN][a-zA-Z]")) | (
            F.contains(text, F.lit(":")) & F.rlike(text, F.lit("(?i)javascript:|vbscript:|data:text/html"))
        )
        return F.when(suspect, out).otherwise(text)

    paired = [n for n in DANGEROUS_ELEMENTS if n not in _EMPTY_ELEMENTS]
    common = [n for n in paired if n in ("script", "style")]
    rare = [n for n in paired if n not in common]
    return let(let(as_column(html), all_elements), attributes)


def html_depth(html: Column | str) -> Column:
    """Deepest nesting of tags, by counting opening and closing tags of elements that must be closed."""

    def step(state: Column, tag: Column) -> Column:
        closing = tag.startswith("</")
        now = (
            F.when(closing, F.greatest(state["now"] - 1, F.lit(0)))
            .when(tag.endswith("/>"), state["now"])
            .otherwise(state["now"] + 1)
        )
        return let(
            now, lambda n: F.struct(n.alias("now"), F.greatest(state["most"], n).alias("most"))
        )

    return F.aggregate(
        F.regexp_extract_all(
            as_column(html), F.lit(f"(?i)</?(?!(?:{'|'.join(_FLAT_ELEMENTS)})[\\s/>])[a-z][^<>]*>"), F.lit(0)
        ),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        step,
        lambda state: state["most"],
    )


def html_error(html: Column | str, max_bytes: int | None = None, need_table: bool = True,
               max_depth: int | None = None) -> Column:
    """Why a page cannot be read, or NULL.  Size and depth are limited only where a limit is given."""
    c = as_column(html)
    size = F.octet_length(c)
    error = F.when(c.isNull() | (c == ""), F.lit("must be a non-empty string"))
    if max_bytes is not None:
        error = error.when(size > max_bytes, F.concat(F.lit("too large: "), size, F.lit(f" bytes exceeds {max_bytes}")))
    error = error.when(is_blank(c), F.lit("empty or blank"))
    if need_table:
        error = error.when(html_table_error(c).isNotNull(), F.lit("no table elements found"))
    if max_depth is not None:
        # a page with few tags cannot be deep, so most pages are not walked at all
        tags = size - F.octet_length(F.replace(c, F.lit("<"), F.lit("")))
        error = error.when((tags > max_depth) & (html_depth(c) > max_depth), F.lit("excessively nested"))
    return error


def csv_error(csv: Column | str, delimiter: str = ",") -> Column:
    """Why a CSV payload cannot be read, or NULL; names the first bad row."""
    c = as_column(csv)

    def widths(rows: Column) -> Column:
        first = F.size(F.get(rows, F.lit(0)))
        bad = F.filter(
            F.transform(rows, lambda r, i: F.struct((i + 1).alias("row"), F.size(r).alias("width"))),
            lambda r: r["width"] != first,
        )
        return let(
            F.get(bad, F.lit(0)),
            lambda b: F.when(F.size(rows) == 0, F.lit("no rows")).when(
                b.isNotNull(),
                F.concat(F.lit("row "), b["row"], F.lit(" has "), b["width"], F.lit(" columns, expected "), first),
            ),
        )

    return (
        F.when(c.isNull() | is_blank(c), F.lit("input is empty"))
        .when(csv_quote_error(c, delimiter), F.lit("malformed quotes"))
        .otherwise(let(csv_cells(c, delimiter), widths))
    )


def _without_strings(json: Column) -> Column:
    return F.regexp_replace(json, '(?s)"(?:[^"\\\\]++|\\\\.)*+"', "")


def json_depth(json: Column | str) -> Column:
    """Deepest nesting of brackets outside strings."""
    runs = F.regexp_extract_all(_without_strings(as_column(json)), F.lit("[\\[{]+|[\\]}]+"), F.lit(0))
    return F.aggregate(
        runs,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda s, run: let(
            F.when(F.rlike(run, F.lit("^[\\[{]")), s["now"] + F.length(run)).otherwise(
                F.greatest(s["now"] - F.length(run), F.lit(0))
            ),
            lambda n: F.struct(n.alias("now"), F.greatest(s["most"], n).alias("most")),
        ),
        lambda s: s["most"],
    )


def _unbalanced(json: Column) -> Column:
    """Braces and brackets each close as often as they open, never before.

    An unterminated string hides everything after it, as it would for a reader
    that scans character by character.
    """

    def off(text: Column, opening: str, closing: str) -> Column:
        runs = F.regexp_extract_all(text, F.lit(f"\\{opening}+|\\{closing}+"), F.lit(0))
        return F.aggregate(
            runs,
            F.struct(F.lit(0).alias("now"), F.lit(0).alias("least")),
            lambda s, run: let(
                s["now"] + F.when(run.startswith(opening), F.length(run)).otherwise(-F.length(run)),
                lambda n: F.struct(n.alias("now"), F.least(s["least"], n).alias("least")),
            ),
            lambda s: (s["now"] != 0) | (s["least"] < 0),
        )

    return let(
        F.regexp_replace(_without_strings(json), '(?s)".*', ""),
        lambda t: off(t, "{", "}") | off(t, "[", "]"),
    )


_FUNCTIONS = "\\bfunction\\s*\\(|\\([^)]*\\)\\s*=>"


def json_safety_error(json: Column | str, max_bytes: int | None = None, max_depth: int | None = None,
                      allow_functions: bool = False) -> Column:
    """Balance and content checks of a JSON text, then parsing; size and depth are limited only where a limit is given."""
    c = as_column(json)
    size = F.octet_length(c)
    error = F.when(c.isNull() | (c == ""), F.lit("must be a non-empty string"))
    if max_bytes is not None:
        error = error.when(size > max_bytes, F.concat(F.lit("too large: "), size, F.lit(f" bytes exceeds {max_bytes}")))
    error = error.when(is_blank(c), F.lit("empty or blank")).when(_unbalanced(c), F.lit("malformed structure"))
    if max_depth is not None:
        error = error.when(json_depth(c) > max_depth, F.lit("too deeply nested"))
    if not allow_functions:
        error = error.when(F.rlike(c, F.lit(_FUNCTIONS)), F.lit("contains functions"))
    return error.when(json_invalid(c), F.lit("parsing failed"))


def json_error(json: Column | str, strict_keys: bool = True) -> Column:
    """Why a JSON payload is not tabular, or NULL; names the first bad item."""
    c = as_column(json)

    def at(items: Column, bad) -> Column:
        return F.get(
            F.filter(F.transform(items, lambda x, i: F.when(bad(x), i)), lambda i: i.isNotNull()), F.lit(0)
        )

    def arrays(items: Column) -> Column:
        rows = F.transform(items, lambda v: F.from_json(v, "array<string>"))

        def check(rs: Column) -> Column:
            odd = at(items, lambda v: ~trim_text(v).startswith("["))
            first = F.size(F.get(rs, F.lit(0)))
            wrong = at(rs, lambda r: F.size(r) != first)
            return (
                F.when(odd.isNotNull(), F.concat(F.lit("item at index "), odd, F.lit(" is not an array")))
                .when(
                    wrong.isNotNull(),
                    F.concat(F.lit("row "), wrong + 1, F.lit(" has "), F.size(F.get(rs, wrong)),
                             F.lit(" columns, expected "), first),
                )
            )

        return let(rows, check)

    def objects(items: Column) -> Column:
        odd = at(items, lambda v: v.isNull() | ~trim_text(v).startswith("{"))
        result = F.when(odd.isNotNull(), F.concat(F.lit("item at index "), odd, F.lit(" is not an object")))
        if strict_keys:
            keys = F.transform(items, lambda v: F.array_sort(F.array_distinct(F.json_object_keys(v))))
            differs = let(keys, lambda ks: at(ks, lambda k: k != F.get(ks, F.lit(0))))
            return F.when(odd.isNotNull(), result).otherwise(
                let(
                    differs,
                    lambda d: F.when(
                        d.isNotNull(), F.concat(F.lit("item at index "), d, F.lit(" has different keys"))
                    ),
                )
            )
        return result

    def shaped(shape: Column) -> Column:
        items = F.from_json(c, "array<string>")
        return (
            F.when(shape == "arrays", let(items, arrays))
            .when(shape.isin("objects", "values"), let(items, objects))
            .when(shape == "empty", F.lit("array is empty"))
            .when(shape == "scalar", F.lit("must be an object or array"))
        )

    return (
        F.when(c.isNull() | is_blank(c), F.lit("input is empty"))
        .when(json_invalid(c), F.lit("invalid JSON"))
        .otherwise(let(json_shape(c), shaped))
    )


def object_error(payload: Column | str) -> Column:
    """An object payload must parse to an object or an array."""
    c = as_column(payload)
    return F.when(json_invalid(c), F.lit("invalid object")).when(
        ~F.rlike(c, F.lit("^\\s*[\\[{]")), F.lit("must be an object or array")
    )


def html_table_error(html: Column | str) -> Column:
    """Whether a page lacks tables, as an error text."""
    c = as_column(html)
    return F.when(~F.rlike(c, F.lit("(?i)<table(?=[\\s/>])")), F.lit("no tables found"))


def input_error(payload: Column | str, source: str, delimiter: str = ",", strict_keys: bool = True,
                allow_functions: bool = True) -> Column:
    """Error of a payload of the given format, or NULL.  Text that looks like code is refused only on request."""
    c = as_column(payload)
    if source == "objects":
        return object_error(c)
    checks = {
        "html": lambda: html_error(c),
        "csv": lambda: csv_error(c, delimiter),
        "json": lambda: F.coalesce(json_safety_error(c, allow_functions=allow_functions), json_error(c, strict_keys)),
    }
    if source not in checks:
        raise ValueError(f"unsupported format: {source!r}")
    return F.when(c.isNull() | is_blank(c), F.lit("input is empty")).otherwise(checks[source]())


def output_size_error(payload: Column | str, max_bytes: int = MAX_JSON_BYTES) -> Column:
    c = as_column(payload)
    size = F.octet_length(c)
    return F.when(size > max_bytes, F.concat(F.lit("output too large: "), size, F.lit(f" bytes exceeds {max_bytes}")))


def checked(df: DataFrame, error: Column, mode: str = "PERMISSIVE", column: str = "error") -> DataFrame:
    """Add the error column; in FAILFAST mode any error stops the job."""
    if mode == "FAILFAST":
        return df.withColumn(column, F.when(error.isNotNull(), F.raise_error(error)).cast("string"))
    if mode != "PERMISSIVE":
        raise ValueError("mode must be 'PERMISSIVE' or 'FAILFAST'")
    return df.withColumn(column, error)


def split_rejects(
    df: DataFrame, error: Column, id_column: str, source: str, target: str, kind: str = "validation"
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and ``rejects(id, source, target, kind, error)``."""
    marked = df.withColumn("__error", error)
    good = marked.filter(F.col("__error").isNull()).drop("__error")
    rejects = marked.filter(F.col("__error").isNotNull()).select(
        id_column,
        F.lit(source).alias("source"),
        F.lit(target).alias("target"),
        F.lit(kind).alias("kind"),
        F.col("__error").alias("error"),
    )
    return good, rejects


def counted(df: DataFrame, error: Column | str, messages: dict[str, str], name: str = "errors") -> tuple[DataFrame, Observation]:
    """``df`` as it is, and counts that are made on its way through whatever job uses it.

    ``messages`` names kinds of errors by how their texts begin. After an action the observation has ``rows``, ``good`` and, for
    each kind, its errors; ``other`` has those of no kind. The first kind that fits counts.
    """
    c = as_column(error)
    observed = Observation(name)
    taken = F.lit(False)
    sums = [F.count(F.lit(1)).alias("rows"), F.count_if(c.isNull()).alias("good")]
    for kind, start in messages.items():
        fits = F.coalesce(c.startswith(start), F.lit(False))
        sums.append(F.count_if(fits & ~taken).alias(kind))
        taken = taken | fits
    sums.append(F.count_if(c.isNotNull() & ~taken).alias("other"))
    return df.observe(observed, *sums), observed
