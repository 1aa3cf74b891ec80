"""Scalar string helpers as Column expressions.

Everything here is a composition of built-in functions, so it stays in the JVM
and can be used in batch and in streaming queries alike.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, functions as F

# The white space a JavaScript-style trim removes.
WHITESPACE = (
    "\t\n\u000b\u000c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Unicode noncharacters: never part of interchanged text, so they are safe as
# in-row separators.  Input that does contain one has it dropped on reading.
NONCHARACTERS = "".join(chr(c) for c in range(0xFDD0, 0xFDF0))


def as_column(value: Column | str) -> Column:
    """A column name or a Column, as a Column."""
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A plain alias would be inlined by the optimizer; inside a lambda that means
    one evaluation per array element.  Binding it as a lambda variable keeps
    nested array work linear.  It is the start of a fold over nothing, whose last step is
    ``body``: unlike the element of an array, neither it nor the result is copied.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, lambda v: body(v))


def trim_text(value: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(value, F.lit(WHITESPACE))


def trim_short(value: Column) -> Column:
    """``trim_text`` for many short texts: those with a printable ASCII character at both ends are not searched."""

    def trimmed(text: Column) -> Column:
        plain = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
        return F.when(plain, text).otherwise(trim_text(text))

    return let(value, trimmed)


def is_blank(value: Column) -> Column:
    return trim_text(value) == ""


def contains_ignore_case(value: Column, needle: str) -> Column:
    return F.contains(F.lower(value), F.lit(needle.lower()))


def escape_html(value: Column) -> Column:
    """Escape the five characters that are special in HTML."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        value = F.replace(value, F.lit(raw), F.lit(safe))
    return value


def escape_text(value: Column) -> Column:
    """Escape what the HTML serialisation rules require inside a text node."""
    for raw, safe in (("&", "&amp;"), ("\u00a0", "&nbsp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(raw), F.lit(safe))
    return value


def _named_entities() -> Column:
    """The standard HTML entity names, as a map that Catalyst folds to a literal."""
    table = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


# One whole attribute with the space before it; what comes after it is not inside a value.
ATTRIBUTE = "[\\s/]++[^\\s=/>\"']++(?:\\s*+=\\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\\s>\"']++))?+"


def _short_names() -> str:
    """Names that also count without a semicolon, the longest first, as alternatives of a pattern."""
    return "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


def _code_point(number: Column) -> Column:
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF) & ~number.between(0xFDD0, 0xFDEF)
    return F.when(
        valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    ).otherwise(F.lit("\ufffd"))


def _decode_reference(tail: Column) -> Column:
    """``tail`` is the text after an ampersand, up to the next ampersand."""

    name = F.regexp_extract(tail, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)

    def resolve(found: Column) -> Column:
        return (
            F.when(found == "", F.lit(None).cast("string"))
            .when(found.startswith("#x") | found.startswith("#X"),
                  _code_point(F.conv(F.substring(found, 3, 6), 16, 10).try_cast("long")))
            .when(found.startswith("#"), _code_point(F.substring(found, 2, 7).try_cast("long")))
            .when(found == "amp", F.lit("&"))
            .when(found == "lt", F.lit("<"))
            .when(found == "gt", F.lit(">"))
            .when(found == "quot", F.lit('"'))
            .when(found == "nbsp", F.lit("\u00a0"))
            .otherwise(F.try_element_at(_named_entities(), found))
        )

    short = F.regexp_extract(tail, f"^(#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|{_short_names()})", 1)
    return let(
        F.struct(name.alias("whole"), short.alias("short")),
        lambda found: F.coalesce(
            F.concat(resolve(found["whole"]), F.substr(tail, F.length(found["whole"]) + F.lit(2))),
            F.concat(resolve(found["short"]), F.substr(tail, F.length(found["short"]) + F.lit(1))),
            F.concat(F.lit("&"), tail),
        ),
    )


# Entities that cover nearly all pages; anything else takes the general path.
_COMMON = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))
_UNCOMMON = "&(?!(?:lt|gt|quot|#39|nbsp|amp);)(?:#[0-9]|#[xX][0-9a-fA-F]|[A-Za-z])"


def decode_entities(value: Column) -> Column:
    """Resolve named, decimal and hexadecimal character references; old names and numbers also without a semicolon."""

    def decode(text: Column) -> Column:
        common = text
        for entity, char in _COMMON:
            common = F.replace(common, F.lit(entity), F.lit(char))
        general = let(
            F.split(text, "&"),
            lambda p: F.concat(
                F.get(p, F.lit(0)),
                F.array_join(F.transform(F.slice(p, F.lit(2), F.size(p)), _decode_reference), ""),
            ),
        )
        return (
            F.when(~F.contains(text, F.lit("&")), text)
            .when(F.rlike(text, F.lit(_UNCOMMON)), general)
            .otherwise(common)
        )

    return let(value, decode)


def running_count(signature: Column, symbol: str) -> Column:
    """For every character of ``signature``: how many ``symbol`` occurred so far.

    The in-row counterpart of ``sum(...) over (order by pos)``: splitting at the
    symbol numbers the stretches, and each number is repeated over its stretch.
    Linear in the length of the string.
    """
    return F.flatten(
        F.transform(
            F.split(signature, symbol),
            lambda part, i: F.array_repeat(i, F.length(part) + F.when(i == 0, 0).otherwise(1)),
        )
    )


# The grammar of a numeric literal that a JavaScript-style
# numeric conversion accepts (blank counts as zero).
_DECIMAL = "^[+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_RADIX = (("^0[xX][0-9a-fA-F]+$", 16), ("^0[oO][0-7]+$", 8), ("^0[bB][01]+$", 2))


def numeric_value(value: Column) -> Column:
    """The value as DOUBLE when it looks like a number, else NULL."""

    def parse(text: Column) -> Column:
        parsed = F.when(text == "", F.lit(0.0)).when(F.rlike(text, F.lit(_DECIMAL)), text.try_cast("double"))
        parsed = parsed.when(F.rlike(text, F.lit("^[+-]?Infinity$")), text.try_cast("double"))
        for pattern, radix in _RADIX:
            parsed = parsed.when(
                F.rlike(text, F.lit(pattern)), F.conv(F.substr(text, F.lit(3)), radix, 10).try_cast("double")
            )
        return parsed

    return let(trim_short(value), parse)
