import csv
import io
import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import OptionError, WriteOptions
from tabledocs.functions.payload import (
    csv_cells, csv_quote_error, csv_records, json_records, json_rows, json_shape, key_value_rows, object_items,
)
from tabledocs.functions.render import csv_text, pretty_json
from tabledocs.plans.options import check_delimiter


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "p string").select(column(F.col("p"))).head()[0]


@pytest.mark.parametrize(
    ("text", "rows"),
    [
        ("a,b\n1,2", [["a", "b"], ["1", "2"]]),
        ("a,b\r\n1,2\r\n", [["a", "b"], ["1", "2"]]),
        ('a,b\n"x, ""q""\ny",2\n\n3,', [["a", "b"], ['x, "q"\ny', "2"], ["3", ""]]),
        ('5" disk,"",z\n', [['5" disk', "", "z"]]),
        ('"a"', [["a"]]),
        ('"multi\nline"', [["multi\nline"]]),
        ('x,"last\nfield"', [["x", "last\nfield"]]),
        ("", []),
        ("a", [["a"]]),
        (",", [["", ""]]),
        ('"",""', [["", ""]]),
    ],
)
def test_csv_cells(spark, text, rows):
    assert one(spark, text, csv_cells) == rows


@pytest.mark.parametrize(("delimiter", "text"), [(";", 'a;b\n"1;2";3'), ("||", 'a||b\n"1||2"||3'), ("\t", 'a\tb\n"1\t2"\t3'), ("|", 'a|b\n"1|2"|3')])
def test_csv_delimiters(spark, delimiter, text):
    rows = one(spark, text, lambda c: csv_cells(c, delimiter))
    assert rows == [["a", "b"], [f"1{delimiter}2", "3"]]


@pytest.mark.parametrize(("text", "bad"), [('a\n"open', True), ('"a"x,b', True), ('a,"b"\n', False), ('a"b,c', False)])
def test_csv_quote_errors(spark, text, bad):
    assert one(spark, text, csv_quote_error) is bad


def test_csv_records_last_header_wins(spark):
    assert one(spark, "a,a,b\n1,2,3", csv_records) == [{"a": "2", "b": "3"}]


@pytest.mark.parametrize("bad", ["", "toolong", '"', "\n", 5])
def test_delimiter_checks(bad):
    with pytest.raises(OptionError):
        check_delimiter(bad)
    with pytest.raises(OptionError):
        WriteOptions(delimiter=bad)


_cell = st.text(alphabet=st.sampled_from(list("ab ,;\"\n\r'&<é")), max_size=6)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_cell, min_size=2, max_size=3), min_size=1, max_size=5), st.sampled_from([",", ";", "::"]))
def test_csv_round_trip(spark, rows, delimiter):
    rows = [r + ["x"] for r in rows]
    df = spark.createDataFrame([(rows,)], "rows array<array<string>>")
    text = df.select(csv_text(F.array().cast("array<string>"), F.col("rows"), delimiter).alias("p"))
    assert text.select(csv_cells(F.col("p"), delimiter)).head()[0] == rows
    if len(delimiter) == 1:
        assert list(csv.reader(io.StringIO(text.head().p, newline=""), delimiter=delimiter)) == rows


@pytest.mark.parametrize(
    ("text", "shape"),
    [('[{"a":1}]', "objects"), (" [ [1]]", "arrays"), ("[]", "empty"), ("[1]", "values"), (' {"a":1}', "object"), ('"x"', "scalar")],
)
def test_json_shape(spark, text, shape):
    assert one(spark, text, json_shape) == shape


def test_json_values_as_text(spark):
    assert one(spark, '[{"b":1.50,"a":"x","o":{"z":1,"y":[1]},"n":null,"t":true}]', json_records) == [
        {"b": "1.5", "a": "x", "o": '{"z":1,"y":[1]}', "n": None, "t": "true"}
    ]
    assert one(spark, '{"a":1}', json_records) == [{"a": "1"}]
    assert one(spark, '[[1,null],["x",true]]', json_rows) == [["1", None], ["x", "true"]]


def test_key_value_rows_flatten_one_level(spark):
    text = '{"a":{"z":1,"y":"q"},"b":[1],"c":null,"d":"{s"}'
    pairs = [(p.key, p.value) for p in one(spark, text, key_value_rows)]
    assert pairs == [("z", "1"), ("y", "q"), ("b", "[1]"), ("c", "null"), ("d", "{s")]
    assert [p.key for p in one(spark, text, lambda c: key_value_rows(c, qualified=True))][:2] == ["a.z", "a.y"]


@pytest.mark.parametrize(
    ("item", "records"),
    [
        ('{"a":1,"__x":2}', [{"a": "1"}]),
        ('{"z":1,"convertedData":[{"a":1},5,"s",[1],{"b":2}]}', [{"a": "1"}, {"b": "2"}]),
        ('{"convertedData":{"a":1}}', [{"a": "1"}]),
        ('{"convertedData":"text"}', []),
        ('[{"a":1},[2]]', [{"a": "1"}]),
        ("plain text", [{"value": "plain text"}]),
    ],
)
def test_object_items(spark, item, records):
    assert one(spark, item, object_items) == records
    typed = one(spark, item, lambda c: F.to_json(object_items(c, typed=True)))
    assert [{k: str(v) for k, v in r.items()} for r in json.loads(typed)] == records


@pytest.mark.parametrize(
    "value", [{}, [], [{"a": 1, "b": [], "c": {"d": "x,:{}[]\"\\"}}, None, [1, [2.5, True]]], "s", 3, {"k": {}}]
)
def test_pretty_json_equals_a_two_space_dump(spark, value):
    compact = json.dumps(value, separators=(",", ":"))
    assert one(spark, compact, pretty_json) == json.dumps(value, indent=2)


def test_wrap_output(spark):
    df = spark.createDataFrame([(1, '[{"a":1},{"a":2}]')], "id int, payload string")
    out = td.convert(df, "json", "objects").select("id", "output")
    items = td.wrap_output(out, wrap=False).orderBy("item_no")
    assert [(r[0], r[1]) for r in items.select("item_no", F.to_json("item")).collect()] == [(1, '{"a":1}'), (2, '{"a":2}')]
    wrapped = td.wrap_output(out, name="result")
    assert wrapped.select(F.to_json("item.result")).head()[0] == '[{"a":1},{"a":2}]'
