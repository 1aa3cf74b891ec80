import itertools
import json

import pytest
from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import ExtractOptions, OptionError, ShapeOptions, TableSelector, WriteOptions

HTML = (
    "<h1>R &amp; D</h1><table><caption>c1</caption><thead><tr><th>name</th><th>age</th></tr></thead>"
    "<tbody><tr><td>Bob, Jr</td><td>9</td></tr><tr><td>Al</td><td>10</td></tr></tbody></table>"
    "<h2>Sub one!</h2><table><tr><th>a</th></tr><tr><td>x</td></tr></table>"
    "<h2>Other</h2><table><tr><td>q</td></tr></table><h2>Sub one!</h2><table><tr><th>a</th></tr><tr><td>y</td></tr></table>"
)
ONE = '<table><thead><tr><th>name</th><th>age</th></tr></thead><tbody><tr><td>Bob, Jr</td><td>9</td></tr><tr><td>Al</td><td>10</td></tr></tbody></table>'
PAYLOADS = {
    "html": ONE,
    "csv": 'name,age\n"Bob, Jr",9\nAl,10',
    "json": '[{"name":"Bob, Jr","age":9},{"name":"Al","age":10}]',
    "objects": '{"__x":1,"convertedData":[{"name":"Bob, Jr","age":9},{"name":"Al","age":10},"skipped"]}',
}


def run(spark, text, source, target, **options):
    df = spark.createDataFrame([(1, text)], "id int, payload string")
    out = td.convert(df, source, target, **options)
    if target == "objects":
        out = out.withColumn("output", F.to_json("output"))
    row = out.head()
    return row.output if row.error is None else ("error", row.error)


@pytest.mark.parametrize(("source", "target"), list(itertools.product(PAYLOADS, PAYLOADS)))
def test_every_pair_of_formats(spark, source, target):
    out = run(spark, PAYLOADS[source], source, target)
    if target == "html":
        assert out == ONE
    elif target == "csv":
        assert out.splitlines() == PAYLOADS["csv"].splitlines()
    else:
        rows = json.loads(out)
        assert [str(v) for r in rows for v in (r["name"], r["age"])] == ["Bob, Jr", "9", "Al", "10"]
        assert all(isinstance(r["age"], int) == (source in ("json", "objects")) for r in rows)


def test_headings_nest_json(spark):
    out = json.loads(run(spark, HTML, "html", "json"))
    people = [{"name": "Bob, Jr", "age": "9"}, {"name": "Al", "age": "10"}]
    assert out == {"R_D": {"_data": people, "Sub_one": [{"a": "x"}, {"a": "y"}], "Other": [["q"]]}}
    assert list(out["R_D"]) == ["_data", "Sub_one", "Other"]
    apart = json.loads(run(spark, HTML, "html", "json", write=WriteOptions(duplicates="suffix")))
    assert apart["R_D"]["Sub_one"] == [{"a": "x"}] and apart["R_D"]["Sub_one_2"] == [{"a": "y"}]


def nest(tables):
    """Brute force: tables placed one by one into nested dicts."""
    root = {}
    for path, rows in tables:
        node = root
        for key in path[:-1]:
            if isinstance(node.get(key), list):
                node[key] = {"_data": node[key]}
            node = node.setdefault(key, {})
        last = node.setdefault(path[-1], [])
        if isinstance(last, dict):
            last = last.setdefault("_data", [])
        last.extend(rows)
    return root


def test_heading_keyed_json_against_brute_force(spark):
    import random

    rng = random.Random(5)
    pages, expected = [], []
    for n in range(25):
        html, stack, tables = "", [], []
        for i in range(rng.randint(3, 14)):
            if rng.random() < 0.5:
                rows = [[str(rng.randint(0, 9))] for _ in range(rng.randint(0, 2))]
                html += "<table>" + "".join(f"<tr><td>{r[0]}</td></tr>" for r in rows) + "</table>"
                tables.append(([t for _, t in stack] or [f"table_{len(tables) + 1}"], rows))
            else:
                level, text = rng.randint(1, 4), rng.choice("pqr")
                stack = [s for s in stack if s[0] < level] + [(level, text)]
                html += f"<h{level}>{text}</h{level}>"
        if len(tables) > 1:
            pages.append((n, html))
            expected.append(nest(tables))
    df = spark.createDataFrame(pages, "id int, payload string")
    got = td.convert(df, "html", "json").orderBy("id").collect()
    assert [json.loads(r.output) for r in got] == expected
    assert [r.output for r in got] == [json.dumps(e, separators=(",", ":")) for e in expected]


def test_page_without_headings_uses_table_numbers(spark):
    html = "<table><tr><td>1</td></tr></table><table><tr><td>2</td></tr></table>"
    assert json.loads(run(spark, html, "html", "json")) == {"table_1": [["1"]], "table_2": [["2"]]}


def test_many_tables(spark):
    plain = ExtractOptions(headings=False)
    out = json.loads(run(spark, HTML, "html", "json", extract=plain))
    assert [t.get("caption") for t in out] == ["c1", None, None, None] and out[2] == {"data": [["q"]]}
    first = ExtractOptions(selector=TableSelector("first-table"))
    assert list(json.loads(run(spark, HTML, "html", "json", extract=first))) == ["caption", "data"]
    assert run(spark, HTML, "html", "csv", extract=first) == '# c1\r\nname,age\r\n"Bob, Jr",9\r\nAl,10'.replace("# c1\r\n", "# c1\n")
    csv = run(spark, HTML, "html", "csv")
    assert csv.split("\n\n")[1] == "# R & D > Sub one!\na\r\nx"
    assert run(spark, HTML, "html", "html", extract=first) == ONE.replace("<table>", "<table><caption>c1</caption>")
    assert run(spark, HTML, "html", "html", write=WriteOptions(pretty=True)).count("\n\n") == 3


def test_headers_may_be_left_out(spark):
    none = WriteOptions(include_headers=False)
    assert run(spark, ONE, "html", "json", write=none) == '[["Bob, Jr","9"],["Al","10"]]'
    assert run(spark, ONE, "html", "csv", write=none) == '"Bob, Jr",9\r\nAl,10'
    assert "<thead>" not in run(spark, ONE, "html", "html", write=none)
    assert run(spark, "a,b\n1,2", "csv", "json", write=none) == '[["a","b"],["1","2"]]'
    assert "<thead>" not in run(spark, PAYLOADS["json"], "json", "html", write=none)


def test_sort_and_project_reach_every_pair(spark):
    shape = ShapeOptions(sort_by="AGE", order="descending", fields="age")
    assert run(spark, ONE, "html", "json", shape=shape) == '[{"age":"10"},{"age":"9"}]'
    assert run(spark, PAYLOADS["csv"], "csv", "csv", shape=shape) == "age\n10\n9"
    assert run(spark, PAYLOADS["json"], "json", "json", shape=shape) == '[{"age":10},{"age":9}]'
    assert run(spark, PAYLOADS["objects"], "objects", "csv", shape=shape) == "age\r\n10\r\n9"
    assert "<td>10</td></tr><tr><td>9</td>" in run(spark, ONE, "html", "html", shape=shape)
    # a table without the field keeps its rows as empty objects
    assert run(spark, ONE, "html", "json", shape=ShapeOptions(fields="zz")) == "[{},{}]"


def test_json_shapes(spark):
    arrays = '[[1,"a,"],[null,true]]'
    assert run(spark, arrays, "json", "csv") == '1,"a,"\nnull,true'
    assert run(spark, arrays, "json", "html") == "<table><tbody><tr><td>1</td><td>a,</td></tr><tr><td>null</td><td>true</td></tr></tbody></table>"
    single = '{"a":{"z":1},"b":"x,y","c":null}'
    assert run(spark, single, "json", "csv") == 'Key,Value\na,"{""z"":1}"\nb,"x,y"\nc,null'
    assert "<tr><td>z</td><td>1</td></tr><tr><td>b</td><td>x,y</td></tr>" in run(spark, single, "json", "html")
    gaps = '[{"a":1},{"b":2}]'
    assert run(spark, gaps, "json", "csv") == ("error", "item at index 1 has different keys")
    assert run(spark, gaps, "json", "csv", strict_keys=False) == "a\n1\n"
    assert run(spark, '{"a":"<b>&"}', "objects", "html").endswith("<td>&lt;b&gt;&amp;</td></tr></tbody></table>")


def test_errors_and_empty_results(spark):
    assert run(spark, "<p>x", "html", "json") == ("error", "no table elements found")
    assert run(spark, "", "csv", "json") == ("error", "input is empty")
    assert run(spark, "a,b\n1", "csv", "json") == ("error", "row 2 has 1 columns, expected 2")
    missing = ExtractOptions(selector=TableSelector("custom", table_selector="#none"))
    assert run(spark, ONE, "html", "csv", extract=missing) == ("error", "no tables found for selector '#none'")
    for target, empty in (("html", "<table></table>"), ("csv", ""), ("json", "[]")):
        assert run(spark, '{"convertedData":[]}', "objects", target) == empty
    with pytest.raises(OptionError):
        run(spark, "x", "xml", "json")
    with pytest.raises(Exception, match="input is empty"):
        run(spark, "", "csv", "json", mode="FAILFAST")


def test_csv_of_only_a_header(spark):
    assert run(spark, "a,b\n", "csv", "html") == "<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody></tbody></table>"
    assert run(spark, "a,b\n", "csv", "json") == "[]"


def test_delimiters(spark):
    assert run(spark, "a;b\n1;2", "csv", "csv", input_delimiter=";") == "a,b\n1,2"
    assert run(spark, ONE, "html", "csv", write=WriteOptions(delimiter="\t")) == "name\tage\r\nBob, Jr\t9\r\nAl\t10"
