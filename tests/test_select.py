import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import ExtractOptions, OptionError, TableSelector
from tabledocs.functions.css import compile_selector, nearest_preceding_text, select_table_numbers, under_heading_in_parent
from tabledocs.functions.nested import tables_with_nested
from tabledocs.operators.select import no_match_error, with_tree

PAGE = (
    '<div id="m" class="a b"><h2>X one</h2><section><table class="t x"><caption>Cap A</caption><tr><td>1'
    "<table><tr><td>in</td></tr></table></td></tr></table></section><p>open<br><img src=x>"
    '<table id=k><caption>cap b</caption><tr><td>2</td></tr></table></div>'
    '<div class=c><h2>X two</h2><span class="year">2025</span><table><tr><td>3</table><table><tr><td>4</table></div>'
)


def chosen(pages, html=PAGE, **options):
    selector = TableSelector(**options)
    df = td.with_tables(pages(html), "html", ExtractOptions(selector=selector, headings=False))
    row = df.select("tables", no_match_error(F.col("tables"), selector).alias("error")).head()
    assert (row.error is None) == bool(row.tables)
    return [t.table_no for t in row.tables]


@pytest.mark.parametrize(
    ("options", "expected"),
    [
        ({"preset": "all-tables"}, [1, 2, 3, 4, 5]),
        ({"preset": "all-tables", "multiple": False}, [1]),
        ({"preset": "first-table"}, [1]),
        ({"preset": "first-table", "multiple": True}, [1, 2, 3, 4]),
        ({"preset": "last-table"}, [5]),
        ({"preset": "last-table", "multiple": True}, [1, 2, 3, 5]),
        ({"preset": "table-under-heading", "heading_level": 2, "heading_text": "x"}, [1]),
        ({"preset": "table-under-heading", "heading_level": 2, "heading_text": "TWO", "table_index": 2}, [5]),
        ({"preset": "table-under-heading", "heading_level": 2, "heading_text": "x", "table_index": 4}, [4]),
        ({"preset": "table-under-heading", "heading_level": 2, "heading_text": "x", "table_index": 4, "scope": "parent"}, []),
        ({"preset": "table-under-heading", "heading_level": 2, "heading_text": "", "table_index": 3, "scope": "parent"}, [3]),
        ({"preset": "table-under-heading", "heading_level": 3}, []),
        ({"preset": "table-with-caption", "caption_text": "CAP"}, [1]),
        ({"preset": "table-with-caption", "caption_text": "cap", "multiple": True}, [1, 3]),
        ({"preset": "table-with-caption", "caption_text": "none"}, []),
        ({"preset": "custom", "table_selector": "div.c > table"}, [4]),
        ({"preset": "custom", "table_selector": "div.c > table", "multiple": True}, [4, 5]),
        ({"element_selector": "#m", "multiple": True}, [1, 2, 3]),
        ({"element_selector": "section, #m", "table_selector": "table.x", "multiple": True}, [1]),
        ({"element_selector": "html"}, [1]),
        ({"element_selector": "article"}, []),
    ],
)
def test_selection(pages, options, expected):
    assert chosen(pages, **options) == expected


@pytest.mark.parametrize(
    ("selector", "expected"),
    [
        ("table", [1, 2, 3, 4, 5]), ("#m table", [1, 2, 3]), (".b > section > table", [1]), ("table#k, div.c > table", [3, 4, 5]),
        ("table:first-of-type", [1, 2, 3, 4]), ("div.c table:last-of-type", [5]), ('div[class="c"] > table', [4, 5]),
        ("td > table", [2]), ("[class^=a] table", [1, 2, 3]), ("[class$=b] table", [1, 2, 3]), ("div[class~=b] table", [1, 2, 3]),
        ("* > table.t", [1]), ("body table", [1, 2, 3, 4, 5]), ("table table", [2]), ("span table", []), ("table[class*=' ']", [1]),
    ],
)
def test_css(pages, selector, expected):
    assert pages(PAGE).select(select_table_numbers(F.col("html"), selector)).head()[0] == expected


@pytest.mark.parametrize("bad", ["", " ", "a >", ">a", "a,,b,", "a > > b", "td[", "a + ~ b", "+ a", "table:nth-child(2", "table:nth-child(x)", "table:nth-child()", "a:hover", "a:not()", "a:not(b c)", "a:nth-child", "a)b", "p:not(:nth-child(2n+)"])
def test_bad_selectors_fail_when_the_plan_is_built(bad):
    with pytest.raises(ValueError):
        compile_selector(bad)


def test_nearest_preceding_element(pages):
    c = F.col("html")
    row = pages(PAGE).select(nearest_preceding_text(c, "span.year"), nearest_preceding_text(c, "h2")).head()
    assert row[0] == [None, None, None, "2025", "2025"]
    assert row[1] == ["X one"] * 3 + ["X two"] * 2


def test_heading_selector_gives_single_level_paths(pages):
    t = td.with_tables(pages(PAGE), "html", ExtractOptions(heading_selector="span.year")).head().tables
    assert [[(h.level, h.text) for h in x.heading_path] for x in t] == [[], [], [], [(1, "2025")], [(1, "2025")]]


@pytest.mark.parametrize(
    "options",
    [
        {"preset": "nope"}, {"heading_level": 0}, {"heading_level": 1000}, {"heading_level": "1"}, {"table_index": 0},
        {"table_selector": ""}, {"element_selector": ""}, {"scope": "x"}, {"caption_text": None}, {"heading_level": True},
    ],
)
def test_option_checks(options):
    with pytest.raises(OptionError):
        TableSelector(**options)


def test_attributes_are_read_whole(spark):
    """What looks like an attribute inside a quoted value is none."""
    page = '<div title="see id=main now"><table><tr><td>no</td></tr></table></div><div data-x id="main"><table><tr><td>yes</td></tr></table></div>'
    df = spark.createDataFrame([(1, page)], "id int, html string")
    chosen = td.rows(df, "html", ExtractOptions(selector=TableSelector("custom", table_selector="#main table")))
    assert [r.cells for r in chosen.collect()] == [["yes"]]


def test_styles_merge_into_the_attribute_itself(spark):
    page = "<table title='a style=\"x:1\"' style=\"color: red\"><tr><td>a</td></tr></table>"
    df = spark.createDataFrame([(1, page)], "id int, html string")
    out = td.style_tables(df, td.StyleOptions(table_width="full")).head().html
    assert "title='a style=\"x:1\"'" in out and 'style="color: red; width: 100%;"' in out


def tree_of(page):
    """A page of well-formed tags as dictionaries, by a plain parser."""
    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.root = {"name": "body", "attrs": {}, "children": [], "parent": None}
            self.at, self.order = self.root, []

        def handle_starttag(self, tag, attrs):
            node = {"name": tag, "attrs": dict(attrs), "children": [], "parent": self.at, "text": ""}
            self.at["children"].append(node)
            self.order.append(node)
            self.at = node

        def handle_endtag(self, tag):
            self.at = self.at["parent"]

        def handle_data(self, data):
            self.at["text"] = self.at.get("text", "") + data

    reader = Reader()
    reader.feed(page)
    return reader.order


def passes(node, steps):
    """Whether the last of the steps matches a node, looking at every ancestor and sibling."""
    *rest, (combinator, test) = steps
    if not test(node):
        return False
    if not rest:
        return True
    family = node["parent"]["children"]
    mine = next(i for i, x in enumerate(family) if x is node)
    above = []
    up = node["parent"]
    while up is not None:
        above.append(up)
        up = up["parent"]
    candidates = {" ": above, ">": above[:1], "+": family[max(0, mine - 1) : mine], "~": family[:mine]}[combinator]
    return any(passes(c, rest) for c in candidates)


def place(node, same_name=False, last=False):
    family = [x for x in node["parent"]["children"] if not same_name or x["name"] == node["name"]] if node["parent"] else [node]
    family = family[::-1] if last else family
    return next(i for i, x in enumerate(family) if x is node) + 1


def named(name):
    return lambda n: n["name"] == name


SELECTORS = {
    "table:nth-child(2)": [("", lambda n: n["name"] == "table" and place(n) == 2)],
    "table:nth-child(-n + 2)": [("", lambda n: n["name"] == "table" and place(n) <= 2)],
    "table:nth-of-type(odd)": [("", lambda n: n["name"] == "table" and place(n, True) % 2 == 1)],
    "table:nth-of-type(3n-1)": [("", lambda n: n["name"] == "table" and place(n, True) % 3 == 2)],
    "table:nth-last-child(2n)": [("", lambda n: n["name"] == "table" and place(n, False, True) % 2 == 0)],
    "table:nth-last-of-type(1)": [("", lambda n: n["name"] == "table" and place(n, True, True) == 1)],
    "table:only-child": [("", lambda n: n["name"] == "table" and len(n["parent"]["children"]) == 1)],
    "p + table": [("", named("p")), ("+", named("table"))],
    "p ~ table": [("", named("p")), ("~", named("table"))],
    "p ~ div > table": [("", named("p")), ("~", named("div")), (">", named("table"))],
    "div p + div table": [("", named("div")), (" ", named("p")), ("+", named("div")), (" ", named("table"))],
    "div:not(.a) table:not(:first-child)": [("", lambda n: n["name"] == "div" and n["attrs"].get("class") != "a"), (" ", lambda n: n["name"] == "table" and place(n) > 1)],
    "div.a ~ *:not(div, p)": [("", lambda n: n["name"] == "div" and n["attrs"].get("class") == "a"), ("~", lambda n: n["name"] not in ("div", "p"))],
    ":is(div, p):nth-child(2) ~ table:where(.a)": [("", lambda n: n["name"] in ("div", "p") and n["parent"] and place(n) == 2), ("~", lambda n: n["name"] == "table" and n["attrs"].get("class") == "a")],
    "table:empty": [("", lambda n: n["name"] == "table" and not n["children"] and not n.get("text"))],
    "div > div ~ table ~ table": [("", named("div")), (">", named("div")), ("~", named("table")), ("~", named("table"))],
}


def test_siblings_against_a_plain_search(spark):
    rng = random.Random(12)

    def page(depth):
        out = ""
        for _ in range(rng.randrange(5)):
            name = rng.choice(["div", "p", "table", "div"])
            mark = rng.choice(["", ' class="a"', " class='b'"])
            out += f"<{name}{mark}>{page(depth - 1) if depth and name != 'p' else rng.choice(['', 'x'])}</{name}>"
        return out

    pages = [page(4) for _ in range(60)]
    df, tree = with_tree(spark.createDataFrame(enumerate(pages), "id int, html string").repartition(8), "html")
    got = df.select("id", *[select_table_numbers(F.col("html"), s, tree=tree).alias(f"s{i}") for i, s in enumerate(SELECTORS)]).collect()
    for row in got:
        tables = [n for n in tree_of(pages[row.id]) if n["name"] == "table"]
        for i, (selector, steps) in enumerate(SELECTORS.items()):
            assert row[f"s{i}"] == [k + 1 for k, n in enumerate(tables) if passes(n, steps)], (selector, pages[row.id])
    assert all(any(r[f"s{i}"] for r in got) for i in range(len(SELECTORS)))


def test_pages_with_and_without_html_and_body(pages):
    c = F.col("html")
    for page, expected in (
        ("<table></table>", [[1], [1], [1], []]), ("<html><body><table></table></body></html>", [[1], [1], [1], []]),
        ("<html><table></table>", [[1], [1], [1], []]), ("<html><table></table></html>", [[], [1], [], [1]]),
    ):
        row = pages(page).select(*[select_table_numbers(c, s) for s in ("body > table", "html table", "html > body table", "html > table")]).head()
        assert list(row) == expected


def test_large_pages(spark):
    """Eight times the tables of one page take far less than 64 times the time."""
    def seconds(n):
        flat = "".join(f"<h2>h{k}</h2><div><table><tr><td>{k}</td></tr></table></div>" for k in range(n))
        df, tree = with_tree(spark.createDataFrame([(flat,)], "html string"), "html")
        c = F.col("html")
        work = [
            select_table_numbers(c, "h2 + div table", tree=tree), nearest_preceding_text(c, "h2", tree=tree),
            under_heading_in_parent(c, 2, f"h{n - 1}", 1, tree=tree), tables_with_nested(c),
        ]
        took = []
        for column in work:
            best = 1e9
            for _ in range(2):
                start = time.perf_counter()
                df.select(column.alias("x")).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - start)
            took.append(best)
        return took

    few, many = seconds(500), seconds(4000)
    assert all(b <= 16 * max(a, 0.2) for a, b in zip(few, many, strict=True)), (few, many)
