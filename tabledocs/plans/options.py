"""Operator options, checked when a plan is built rather than when it runs."""

from __future__ import annotations

from dataclasses import dataclass, fields

# The formats and choices an option may take.
FORMATS = ("html", "csv", "json", "objects")
PRESETS = (
    "all-tables", "first-table", "last-table", "table-under-heading", "table-with-caption", "custom",
)
TEXT_ALIGN = ("", "left", "center", "right", "justify", "start", "end")
VERTICAL_ALIGN = ("", "top", "middle", "bottom", "baseline")
WRAP = ("", "wrap", "nowrap")


class OptionError(ValueError):
    """An option has the wrong type, length, range or value."""


def _check(owner: object, name: str, kind: type | tuple[type, ...], *, choices=None, low=None, high=None,
           shortest=None, longest=None) -> None:
    value = getattr(owner, name)
    if isinstance(value, bool) and kind is not bool:
        raise OptionError(f"{name} must be {kind}, not bool")
    if not isinstance(value, kind):
        raise OptionError(f"{name} must be {kind}, not {type(value).__name__}")
    if choices is not None and value not in choices:
        raise OptionError(f"{name} must be one of {', '.join(map(repr, choices))}; got {value!r}")
    if low is not None and value < low:
        raise OptionError(f"{name} must be at least {low}; got {value}")
    if high is not None and value > high:
        raise OptionError(f"{name} must be at most {high}; got {value}")
    if shortest is not None and len(value) < shortest:
        raise OptionError(f"{name} must have at least {shortest} characters")
    if longest is not None and len(value) > longest:
        raise OptionError(f"{name} must have at most {longest} characters")


def check_delimiter(delimiter: str) -> str:
    """A CSV delimiter: one to five characters, neither quote nor line break."""
    if not isinstance(delimiter, str) or not 1 <= len(delimiter) <= 5:
        raise OptionError("delimiter must have 1 to 5 characters")
    if any(c in delimiter for c in "\"\r\n"):
        raise OptionError("delimiter must not contain a quote or a line break")
    return delimiter


@dataclass(frozen=True)
class TableSelector:
    """Which tables of a page to take.

    ``preset`` chooses among the simple forms.  Giving ``element_selector``
    (with or without ``table_selector``) selects tables inside the elements it
    matches.  ``multiple=False`` keeps one table, except for all-tables.
    ``scope='parent'`` limits a table under a heading to the heading's parent.
    """

    preset: str = "all-tables"
    multiple: bool | None = None
    heading_level: int = 1
    heading_text: str = ""
    table_index: int = 1
    caption_text: str = ""
    table_selector: str = "table"
    element_selector: str | None = None
    scope: str = "document"

    def __post_init__(self) -> None:
        _check(self, "preset", str, choices=PRESETS)
        _check(self, "heading_level", int, low=1, high=999)
        _check(self, "heading_text", str)
        _check(self, "table_index", int, low=1)
        _check(self, "caption_text", str)
        _check(self, "table_selector", str, shortest=1)
        _check(self, "scope", str, choices=("document", "parent"))
        if self.element_selector is not None:
            _check(self, "element_selector", str, shortest=1)

    @property
    def takes_many(self) -> bool:
        return self.preset == "all-tables" and self.element_selector is None if self.multiple is None else self.multiple


@dataclass(frozen=True)
class ExtractOptions:
    """How to read the tables of a page."""

    selector: TableSelector = TableSelector()
    include_headers: bool = True
    cell_format: str = "text"
    headings: bool | None = None          # None: on for all-tables
    heading_selector: str = ""
    include_nested: bool = False
    sanitize: bool = True

    def __post_init__(self) -> None:
        _check(self, "include_headers", bool)
        _check(self, "cell_format", str, choices=("text", "markdown"))
        _check(self, "heading_selector", str)
        _check(self, "include_nested", bool)
        _check(self, "sanitize", bool)

    @property
    def detects_headings(self) -> bool:
        if self.headings is not None:
            return self.headings
        return self.selector.preset == "all-tables" and self.selector.element_selector is None


@dataclass(frozen=True)
class ShapeOptions:
    """Sorting and projection of records."""

    sort_by: str = ""
    order: str = "ascending"
    fields: str = ""

    def __post_init__(self) -> None:
        _check(self, "sort_by", str)
        _check(self, "order", str, choices=("ascending", "descending"))
        _check(self, "fields", str)


@dataclass(frozen=True)
class StyleOptions:
    """How to restyle tables.  Empty values leave the page as it is."""

    table_class: str = ""
    table_style: str = ""
    row_style: str = ""
    cell_style: str = ""
    zebra: bool = False
    even_row_color: str = ""
    odd_row_color: str = ""
    border_style: str = ""
    border_width: int | None = None
    border_color: str = ""
    border_radius: str = ""
    border_collapse: str = ""
    border_cells: bool = False
    table_text_align: str = ""
    row_text_align: str = ""
    cell_text_align: str = ""
    header_text_align: str = ""
    body_text_align: str = ""
    header_vertical_align: str = ""
    body_vertical_align: str = ""
    header_wrap: str = ""
    body_wrap: str = ""
    numeric_alignment: str = ""
    banded_rows: str = ""
    table_width: str = ""
    caption_style: str = ""
    caption_position: str = ""

    def __post_init__(self) -> None:
        for f in fields(self):
            if f.name in ("zebra", "border_cells"):
                _check(self, f.name, bool)
            elif f.name == "border_width":
                if self.border_width is not None:
                    _check(self, "border_width", int, low=0)
            elif f.name.endswith("text_align"):
                _check(self, f.name, str, choices=TEXT_ALIGN)
            elif f.name.endswith("vertical_align"):
                _check(self, f.name, str, choices=VERTICAL_ALIGN)
            elif f.name.endswith("_wrap"):
                _check(self, f.name, str, choices=WRAP)
            else:
                _check(self, f.name, str)
        _check(self, "border_collapse", str, choices=("", "collapse", "separate"))
        _check(self, "numeric_alignment", str, choices=("", "left", "right"))
        _check(self, "banded_rows", str, choices=("", "on", "off"))
        _check(self, "table_width", str, choices=("", "auto", "full"))
        _check(self, "caption_position", str, choices=("", "top", "bottom"))


@dataclass(frozen=True)
class WriteOptions:
    """How to write records as text."""

    include_headers: bool = True
    pretty: bool = False
    delimiter: str = ","
    multiple: bool = False
    duplicates: str = "append"
    qualified_keys: bool = False

    def __post_init__(self) -> None:
        check_delimiter(self.delimiter)
        _check(self, "duplicates", str, choices=("append", "suffix"))
