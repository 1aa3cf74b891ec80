import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tabledocs as td

TABLE = "<table></table>"


def errors(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, p string").orderBy("i")
    return [r[0] for r in df.select(column).collect()]


from tabledocs.operators.quality import MAX_DEPTH, MAX_HTML_BYTES, MAX_JSON_BYTES  # noqa: E402


def test_html_guard(spark):
    texts = ["", " \n ", "<p>x</p>", TABLE, "<div>" * 101 + TABLE, "<div>" * 99 + TABLE, None, "<br/>" * 500 + TABLE, "<i></i>" * 500 + TABLE]
    assert errors(spark, texts, td.html_error("p", MAX_HTML_BYTES, max_depth=MAX_DEPTH)) == [
        "must be a non-empty string", "empty or blank", "no table elements found", None, "excessively nested", None,
        "must be a non-empty string", None, None,
    ]
    assert errors(spark, [TABLE + "x" * 100], td.html_error("p", max_bytes=50)) == ["too large: 115 bytes exceeds 50"]


def test_depth(spark):
    assert errors(spark, ["<a><b></b></a>", "</a></b><c>", "<br/><i>", "x < y", "<a><b><c></x></y><d>"], td.html_depth("p")) == [2, 1, 1, 0, 3]


def test_sanitize(spark):
    cases = {
        "<p>a</p><script src=x>alert('<b>')</script>b": "<p>a</p>b",
        "<SCRIPT\n>1</SCRIPT >x<script/>y": "xy",
        '<td onclick="go(\'x\')" class=z>1</td>': "<td class=z>1</td>",
        "<img src=x ONERROR=alert(1)>": "<img src=x>",
        '<a href="javascript:x()">k</a>': '<a href="#">k</a>',
        "<img src='vbscript:q'>": '<img src="#">',
        '<img src="data:text/html,x">': '<img src="#">',
        '<a href="data:text/html,x">k</a>': '<a href="data:text/html,x">k</a>',
        "<iframe src=x>in</iframe><object>o</object><embed src=e><meta charset=x><link rel=y>t": "t",
        "<form>open <b>kept</b>": "<form>open <b>kept</b>",
        "<form>a</form>b<form>open<iframe>x</iframe>": "b<form>open",
        "<formula>x</formula><select><option>1</select><button>b</button>": "<formula>x</formula>",
        "<p>plain &amp; simple</p>": "<p>plain &amp; simple</p>",
        "<style>p{}</style><noscript>n</noscript><textarea>t</textarea>z": "z",
    }
    assert errors(spark, list(cases), td.sanitize_html("p")) == list(cases.values())


def test_csv_error(spark):
    texts = ["", "a,b\n1,2\n", "a,b\n1", "a,b\n\n1,2,3", 'a\n"x', "a\nb"]
    assert errors(spark, texts, td.csv_error("p")) == [
        "input is empty", None, "row 2 has 1 columns, expected 2", "row 2 has 3 columns, expected 2", "malformed quotes", None,
    ]
    assert errors(spark, ["a;b\n1;2", "a;b\n1"], td.csv_error("p", ";")) == [None, "row 2 has 1 columns, expected 2"]


def test_json_error(spark):
    texts = ["", '[{"a":1},{"a":2}]', '[{"a":1},{"b":1}]', '[{"b":1,"a":2},{"a":1,"b":3}]', "[]", "[1]", '"x"', "null", "{", '{"a":1}',
             "[[1,2],[3]]", "[[1],2]", '[{"a":1},[1]]', '[{"a":1},null]']
    assert errors(spark, texts, td.json_error("p")) == [
        "input is empty", None, "item at index 1 has different keys", None, "array is empty", "item at index 0 is not an object",
        "must be an object or array", "must be an object or array", "invalid JSON", None,
        "row 2 has 1 columns, expected 2", "item at index 1 is not an array", "item at index 1 is not an object",
        "item at index 1 is not an object",
    ]
    assert errors(spark, ['[{"a":1},{"b":1}]'], td.json_error("p", strict_keys=False)) == [None]


def test_json_safety(spark):
    texts = ["", "  ", '{"a":1', '{"a":"}{"}', "]" + "[", '{"f":"function (x) {}"}', '{"f":"(a, b) => a"}', "[" * 101 + "]" * 101,
             "[" * 100 + "]" * 100, "{a:1}", '{"__proto__":{"x":1}}', '{"s":"\\"[["}']
    assert errors(spark, texts, td.json_safety_error("p", MAX_JSON_BYTES, MAX_DEPTH)) == [
        "must be a non-empty string", "empty or blank", "malformed structure", None, "malformed structure", "contains functions",
        "contains functions", "too deeply nested", None, "parsing failed", None, None,
    ]
    assert errors(spark, ['{"f":"function (x)"}'], td.json_safety_error("p", allow_functions=True)) == [None]
    assert errors(spark, ['{"a":12345}'], td.json_safety_error("p", max_bytes=5)) == ["too large: 11 bytes exceeds 5"]


def test_object_and_output_checks(spark):
    assert errors(spark, ['{"a":1}', "[1]", "5", "x"], td.object_error("p")) == [
        None, None, "must be an object or array", "invalid object"
    ]
    assert errors(spark, ["abc", "ab"], td.output_size_error("p", 2)) == ["output too large: 3 bytes exceeds 2", None]
    with pytest.raises(ValueError):
        td.input_error("p", "xml")


def test_rejects_and_fail_fast(spark):
    df = spark.createDataFrame([(1, TABLE), (2, "x"), (3, "")], "doc_id int, html string")
    good, bad = td.split_rejects(df, td.html_error("html"), "doc_id", "html", "json")
    assert [r.doc_id for r in good.collect()] == [1]
    assert sorted(tuple(r) for r in bad.collect()) == [
        (2, "html", "json", "validation", "no table elements found"),
        (3, "html", "json", "validation", "must be a non-empty string"),
    ]
    assert td.checked(df.filter("doc_id = 1"), td.html_error("html"), "FAILFAST").count() == 1
    with pytest.raises(PySparkException):
        td.checked(df, td.html_error("html"), "FAILFAST").collect()
    with pytest.raises(ValueError):
        td.checked(df, F.lit(None), "OTHER")


def test_unclosed_tags_stay_linear(spark):
    """Many unclosed tags and stray quotes must not make a page slow."""
    texts = ["<form>" * 200_000 + TABLE, "<!--" * 200_000 + TABLE, "<script>" * 100_000, "<td " * 200_000 + TABLE, "\"'<a " * 100_000]
    assert len(errors(spark, texts, F.length(td.sanitize_html("p")))) == len(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, html string")
    options = td.ExtractOptions(headings=True)
    assert td.with_tables(df, "html", options).select(F.sum(F.size("tables"))).head()[0] is not None
