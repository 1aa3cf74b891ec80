"""Tables inside documents, as Spark DataFrames."""

from tabledocs.operators.extract import cells, each, record_columns, records, rows, tables, with_tables
from tabledocs.operators.quality import (
    checked, counted, csv_error, html_depth, html_error, input_error, json_error, json_safety_error,
    object_error, output_size_error, sanitize_html, split_rejects,
)
from tabledocs.operators.replace import replace_from, replace_table, replacement_tables
from tabledocs.operators.shape import (
    manipulate, manipulate_records, parse_field_list, project, project_records, sort_by_field, sort_records,
)
from tabledocs.operators.style import style_tables
from tabledocs.plans.assemble import group_text, ordered_position
from tabledocs.plans.convert import convert, fill_empty, heading_keyed_json, wrap_output
from tabledocs.plans.documents import append_sections, combine_objects, render_all, render_groups
from tabledocs.plans.options import (
    ExtractOptions, OptionError, ShapeOptions, StyleOptions, TableSelector, WriteOptions,
)

__all__ = [
    "ExtractOptions", "OptionError", "ShapeOptions", "StyleOptions", "TableSelector", "WriteOptions",
    "append_sections", "cells", "checked", "combine_objects", "convert", "counted", "csv_error", "each", "fill_empty",
    "group_text", "heading_keyed_json", "html_depth", "html_error", "input_error", "json_error",
    "json_safety_error", "manipulate", "manipulate_records", "object_error", "ordered_position",
    "output_size_error", "parse_field_list", "project", "project_records", "record_columns", "records",
    "render_all", "render_groups", "replace_from", "replace_table", "replacement_tables", "rows", "sanitize_html",
    "sort_by_field", "sort_records", "split_rejects", "style_tables", "tables", "with_tables",
    "wrap_output",
]
