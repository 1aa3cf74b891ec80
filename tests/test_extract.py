import random
from html.parser import HTMLParser

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import ExtractOptions
from tabledocs.functions.markup import heading_paths, lossless_units, tables_column
from tabledocs.functions.render import html_table
from tabledocs.functions.text import decode_entities, running_count, trim_text

PLAIN = ExtractOptions(headings=False)


def read(df, **options):
    rows = df.select("id", tables_column(F.col("html"), **options).alias("t")).orderBy("id").collect()
    return [[(t.caption, t.headers, t.rows) for t in r.t] for r in rows]


def test_headers_rows_and_captions(pages):
    df = pages(
        "<table><caption> People </caption><thead><tr><th>Name</th><th>Age</th></tr></thead>"
        "<tbody><tr><td> Ann </td><td>3</td></tr></tbody></table>",
        "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>",
        "<table><tr><th>Name</th><td>lost</td></tr><tr><td>x</td><td>y</td></tr></table>",
        "<table><thead></thead><tbody><tr><td>1</td></tr></tbody></table>",
        "<table><tr><td>before</td></tr><thead><tr><td>head</td></tr></thead><tr></tr></table>",
        "<p>nothing</p>",
        "",
    )
    assert read(df) == [
        [("People", ["Name", "Age"], [["Ann", "3"]])],
        [(None, [], [["a", "b"], ["c"]])],
        [(None, ["Name"], [["x", "y"]])],
        [(None, [], [["1"]])],
        [(None, ["head"], [["before"], []])],
        [],
        [],
    ]


def test_malformed_and_misleading_markup(pages):
    df = pages(
        "<TABLE CLASS='a>b'><TR><TD title=\"<table>\">x<TD>y<TR><TD>z",
        "<!-- <table><tr><td>no</td></tr></table> --><table><tr><td>yes<!-- c --></td></tr></table>",
        "<script>var t='<table>';</script><table><tr><td>a < b</td></tr></table></table></table>",
        "<table><tr><td>1</td>stray</tr>text</table><table><tr><td>2</td></tr></table>",
        "<table><tr><td>a<br>b <b>c</b></td></tr></table>﷒﷕",
        "<tablex><tr><td>no</td></tr></tablex>",
    )
    assert [[t[2] for t in page] for page in read(df)] == [
        [[["x", "y"], ["z"]]],
        [[["yes"]]],
        [[["a < b"]]],
        [[["1"]], [["2"]]],
        [[["ab c"]]],
        [],
    ]


def test_entities(spark):
    texts = {
        "a &amp; b": "a & b", "&amp;lt;": "&lt;", "&lt;&gt;&quot;&#39;": "<>\"'", "&eacute;&#233;&#xE9;": "ééé",
        "&#128512;": "😀", "x &unknown; &": "x &unknown; &", "&copy;&middot;&hellip;": "©·…", "&nbsp;": " ",
        "&#xFDD2;": "�", "&#0;": "�",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    out = [r[0] for r in df.orderBy("id").select(decode_entities(F.col("t"))).collect()]
    assert out == list(texts.values())


def test_trim_takes_unicode_space(spark):
    df = spark.createDataFrame([(" ﻿\t x y 　\n",)], "t string")
    assert df.select(trim_text(F.col("t"))).head()[0] == "x y"


def test_running_count(spark):
    df = spark.createDataFrame([("aOOcbO",), ("",), ("O",)], "s string")
    assert [r[0] for r in df.select(running_count(F.col("s"), "O")).collect()] == [[0, 1, 2, 2, 2, 3], [], [1]]


def test_cell_markdown(pages):
    df = pages(
        "<table><tr><td><strong>b</strong> <i>i</i> <code>x<b>y</b></code></td>"
        "<td><a href='u?a=1&amp;b=2'>t <b>k</b></a><a>bare</a><img alt='al' src=s></td>"
        "<td>l1<br/>l2<hr><p>p1<p>p2</p></td>"
        "<td><ul> <li> one </li><li>two</ul><ol><li>n1</li><li>n2</li></ol></td>"
        "<td><ul><li>a<ol><li>x</li><li>y</li></ol></li><li>b</li></ul></td>"
        "<td><blockquote> q </blockquote><del>d</del><sub>s</sub><sup>p</sup><h3>h</h3><span>z</span></td></tr></table>"
    )
    assert read(df, cell_format="markdown")[0][0][2] == [[
        "**b** *i* `xy`",
        "[t **k**](u?a=1&b=2)bare![al](s)",
        "l1\nl2\n---\np1\n\np2",
        "- one\n- two\n1. n1\n2. n2",
        "- a1. x\n2. y\n- b",
        "> q\n~~d~~~s~^p^### h\nz",
    ]]


def test_heading_paths_follow_the_stack_rule(spark):
    rng = random.Random(3)
    texts, expected = [], []
    for _ in range(60):
        html, stack, paths = "", [], []
        for i in range(rng.randint(1, 14)):
            if rng.random() < 0.4:
                html += "<table><tr><td>x</td></tr></table>"
                paths.append([(lv, t) for lv, t in stack])
            else:
                level = rng.randint(1, 6)
                html += f"<H{level} class=c>t{i} <b>&amp;</b></H{level}>"
                if level < 6:
                    stack = [s for s in stack if s[0] < level] + [(level, f"t{i} &")]
        texts.append((len(texts), html))
        expected.append(paths)
    df = spark.createDataFrame(texts, "id int, html string")
    got = df.orderBy("id").select(heading_paths(F.col("html")).alias("p")).collect()
    assert [[[(h.level, h.text) for h in path] for path in r.p] for r in got] == expected


class Outline(HTMLParser):
    """Brute force: tables with the rows and cells that belong to each itself."""

    def __init__(self):
        super().__init__()
        self.tables, self.open = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self.open.append((self.tables[-1], len(self.open) + 1))
        elif self.open and tag == "tr":
            self.open[-1][0].append([])
        elif self.open and tag == "td":
            self.open[-1][0][-1].append("")

    def handle_endtag(self, tag):
        if tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1][0] and self.open[-1][0][-1]:
            self.open[-1][0][-1][-1] += data


def random_table(rng, depth):
    rows = ""
    for _ in range(rng.randint(1, 3)):
        cells = ""
        for _ in range(rng.randint(1, 3)):
            inner = random_table(rng, depth + 1) if depth < 5 and rng.random() < 0.3 else ""
            cells += f"<td>{rng.randint(0, 99)}{inner}{rng.choice('abc')}</td>"
        rows += f"<tr>{cells}</tr>"
    return f"<table>{rows}</table>"


def test_nested_tables_against_a_parser(spark):
    rng = random.Random(11)
    texts = [
        (i, "".join(random_table(rng, 1) + rng.choice(["", "</table>", "x"]) for _ in range(rng.randint(1, 3))))
        for i in range(40)
    ]
    expected = []
    for _, text in texts:
        outline = Outline()
        outline.feed(text)
        expected.append([[[c.strip() for c in r] for r in t] for t in outline.tables])
    df = spark.createDataFrame(texts, "id int, html string").orderBy("id")
    got = df.select(tables_column(F.col("html")).alias("t")).collect()
    assert [[t.rows for t in r.t] for r in got] == expected
    assert [[t.table_no for t in r.t] for r in got] == [list(range(1, len(t) + 1)) for t in expected]


def test_descendant_wide_reading(pages):
    df = pages(
        "<table><caption>o</caption><tr><td>A<table><caption>i</caption><tr><th>H</th></tr><tr><td>v</td></tr></table></td>"
        "<td>B</td></tr></table>"
    )
    options = ExtractOptions(headings=False, include_nested=True)
    t = td.with_tables(df, "html", options).head().tables
    # the inner header cell is a descendant of the first outer row, so it names the outer column too
    assert [(x.table_no, x.depth, x.caption, x.headers, x.rows) for x in t] == [
        (1, 1, "o", ["H"], [["H"], ["v"]]),
        (2, 2, "i", ["H"], [["v"]]),
    ]


def test_records_zip_headers_and_cells(pages):
    df = pages("<table><tr><th>a</th><th>b</th><th>a</th></tr><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr><tr><td>5</td></tr></table>")
    recs = td.records(df, "html", PLAIN)
    assert [r[0] for r in recs.orderBy("row_no").select(F.to_json("rec")).collect()] == ['{"a":"3","b":"2"}', '{"a":"5"}']
    typed = td.record_columns(recs, {"a": "int", "missing": "string"}, keep=["row_no"]).orderBy("row_no").collect()
    assert [(r.a, r.missing) for r in typed] == [(3, None), (5, None)]
    cells = td.cells(df, "html", PLAIN).orderBy("row_no", "col_no").collect()
    assert [(c.row_no, c.col_no, c.header, c.value) for c in cells][3] == (1, 4, None, "4")


def test_many_tables_keep_their_numbers(pages):
    html = "".join(f"<h2>s{i}</h2><table><tr><td>{i}</td></tr></table>" for i in range(150))
    t = td.with_tables(pages(html)).head().tables
    assert [(x.table_no, x.n_tables, x.rows, x.heading_path[0].text) for x in t] == [
        (i + 1, 150, [[str(i)]], f"s{i}") for i in range(150)
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc", "Cn", "Co")), max_size=8), min_size=2, max_size=2), min_size=1, max_size=6))
def test_html_round_trip(spark, rows):
    df = spark.createDataFrame([(0, rows)], "id int, rows array<array<string>>")
    html = html_table(F.array(F.lit("<h>"), F.lit("&k")), F.col("rows"), F.lit("c\"'"))
    (table,) = read(df.select("id", html.alias("html")))[0]
    strip = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
    assert table == ("c\"'", ["<h>", "&k"], [[c.strip(strip) for c in r] for r in rows])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["<table>", "</table>", "<td a='>'>", "<", "<!--", "-->", "x\n", "\"", "<script>", "</script>", "<tr", ">", "</td>", "<p>"]), max_size=25))
def test_units_are_lossless(spark, parts):
    df = spark.createDataFrame([("".join(parts),)], "html string")
    joined = F.array_join(lossless_units(F.col("html"), "/?table|tr|td"), "")
    assert df.select(joined).head()[0] == "".join(parts)


def test_names_of_structural_tags_in_any_case(pages):
    df = pages(
        "<TABLE><Caption> c </CAPTION><tr><td>x</td></tr><THEAD><TR><tH>h</Th></tr></thead><TBODY><tR><tD> é </td><td>b<tr><TD></table>"
        "<p>out</p><thead><table><thead></thead><tr><td>1"
    )
    first, second = read(df)[0]
    assert first == ("c", ["h"], [["x"], ["é", "b"], [""]])
    assert second == (None, [], [["1"]])


def test_a_cell_does_not_carry_all_headers(pages):
    df = td.cells(pages("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>"), "html")
    assert [(r.col_no, r.header, r.value) for r in df.collect()] == [(1, "a", "1"), (2, "b", "2"), (3, None, "3")]
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last = next(line for line in plan if "Generate posexplode" in line)
    assert "headers" not in last.split("), [", 1)[1]


def test_sanitised_names_are_found_in_any_case(pages):
    from tabledocs.operators.quality import DANGEROUS_ELEMENTS, sanitize_html

    df = pages(*[f"a<{n.title()} x='1'/>b: onto" for n in DANGEROUS_ELEMENTS], "a<b ONclick='x'>c", "<a href='JavaScript:x'>y</a>")
    got = [r[0] for r in df.orderBy("id").select(sanitize_html("html")).collect()]
    assert got == ["ab: onto"] * len(DANGEROUS_ELEMENTS) + ["a<b>c", '<a href="#">y</a>']
