import pytest
from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import OptionError, ShapeOptions
from tabledocs.functions.payload import json_records
from tabledocs.functions.text import numeric_value
from tabledocs.operators.shape import resolve_column, sort_keys

MIXED = '[{"N":"10"},{"N":"9"},{"N":"b"},{"N":"A"},{"m":3},{"N":null},{"N":""},{"N":"9.0"},{"N":"0x10"},{"N":true}]'


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("name, age", ["name", "age"]), ('"full name", age, "e, mail"', ["full name", "age", "e, mail"]),
        ("a,'b c',d", ["a", "b c", "d"]), ("", []), ("  ", []), (None, []), ("a,,b,", ["a", "b"]), ('"open, x', ["open, x"]),
        ("'it\"s',b", ['it"s', "b"]),
    ],
)
def test_field_lists(text, names):
    assert td.parse_field_list(text) == names


def test_names_match_without_case():
    assert resolve_column(["FirstName", "AGE"], " age ") == "AGE"
    assert resolve_column(["a"], "b") is None


def test_numeric_values(spark):
    texts = ["1", " 2.5 ", "", "-3e2", ".5", "0x1F", "0b11", "0o17", "1d", "1_0", "abc", "Infinity", "+7", "1,000"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(numeric_value(F.col("t"))).collect()] == [
        1.0, 2.5, 0.0, -300.0, 0.5, 31.0, 3.0, 15.0, None, None, None, float("inf"), 7.0, None,
    ]


@pytest.mark.parametrize(
    ("order", "expected"),
    [
        ("ascending", [None, None, "", "9", "9.0", "10", "0x10", "A", "b", "true"]),
        ("descending", ["true", "b", "A", "0x10", "10", "9", "9.0", "", None, None]),
    ],
)
def test_sort_records(spark, order, expected):
    df = spark.createDataFrame([(MIXED,)], "p string")
    recs = df.select(td.sort_records(json_records(F.col("p")), "n", order)).head()[0]
    assert [r.get("N") for r in recs] == expected
    # the same order on a frame
    wide = spark.createDataFrame([(i, r.get("N")) for i, r in enumerate(df.select(json_records(F.col("p"))).head()[0])], "i int, N string")
    assert [r.N for r in td.sort_by_field(wide, "n", order, ordinal="i").collect()] == expected


def test_project_records(spark):
    df = spark.createDataFrame([('[{"Name":"x","AGE":1,"city":null}]',)], "p string")
    recs = df.select(td.project_records(json_records(F.col("p")), "age, NAME, zz, Age, city").alias("r"))
    # a collected map does not keep its order, its JSON does
    assert recs.select(F.to_json("r")).head()[0] == '[{"AGE":"1","Name":"x","city":null}]'


def test_manipulate_a_frame(spark):
    df = spark.createDataFrame([(1, "b", 10), (2, "a", 9), (3, "c", 100)], "id int, Name string, score int")
    out = td.manipulate(df, ShapeOptions(sort_by="SCORE", fields="name"), ordinal="id")
    assert out.columns == ["Name"] and [r[0] for r in out.collect()] == ["a", "b", "c"]
    assert td.project(df, "").columns == df.columns
    assert td.sort_by_field(df, "unknown").columns == df.columns


def test_bad_order():
    with pytest.raises(OptionError):
        ShapeOptions(sort_by="a", order="up")


def test_ordered_position(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("k"))
    got = td.ordered_position(df, sort_keys(F.col("k"))).collect()
    assert [r.position for r in sorted(got, key=lambda r: r.k)] == list(range(1, 5001))
