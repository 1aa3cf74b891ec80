"""Every registered query against its SQL, on the smallest given tables."""

import importlib
import os

import duckdb
import pytest

entry = importlib.import_module("__spark_entry__")
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# one query per kind of work; the driver runs all of them
SAMPLE = (
    "extract_records", "heading_keyed_json", "select_under_heading_in_parent", "css_custom_select", "sort_mixed_numeric",
    "csv_payload_semicolon", "object_item_rows", "sanitize_pages", "html_depth_of_pages", "markdown_cells",
    "replace_from_json", "style_numeric_align", "nested_all", "convert_html_to_csv", "all_at_once", "stream_extract",
    "many_breaks", "json_repeated_keys", "entities_without_semicolon", "replace_repeated_keys", "wide_group_round_trip",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    from workload.queries import ORACLE, QUERIES

    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, database, name):
    df = entry.queries()[name](spark, DATA)
    result = database.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    expected = sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())
    assert sorted(repr(tuple(r)) for r in df.collect()) == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_orderkey", "row_no", "line", "part", "supp", "qty", "flag", "status"]
    assert df.limit(1).count() == 1
