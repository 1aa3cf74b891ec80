import pytest
from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import OptionError, ShapeOptions, StyleOptions, TableSelector

PAGE = (
    "<h1>Intro</h1><p>a</p><!-- <table> --><h1>Target</h1>\n<table class=\"t x\" style=\"color: red; width:5px\"><caption>c1</caption>"
    "<thead><tr><th>h</th></tr></thead><tr><td>1<table><tr><td title=\"<table>\">v</td></tr></table></td>"
    "<td style='background-color:blue'>1,200.5%</td></tr><tr style=\"background-color:x\"><td>z</td></tr></table>tail"
    "<h2>Q</h2><TABLE><tr><td>2</table>end"
)


def replaced(pages, content="[NEW $1\\]", **selector):
    return td.replace_table(pages(PAGE), F.lit(content), selector=TableSelector(**selector), pretty=True).head()


def test_only_the_selected_table_changes(pages):
    start, stop = PAGE.index("<table class"), PAGE.index("tail")
    assert replaced(pages).html == PAGE[:start] + "[NEW $1\\]" + PAGE[stop:]
    assert replaced(pages, preset="table-under-heading", heading_text="target").html == replaced(pages).html
    inner = '<table><tr><td title="<table>">v</td></tr></table>'
    assert replaced(pages, preset="custom", table_selector="td > table").html == PAGE.replace(inner, "[NEW $1\\]")
    assert replaced(pages, preset="last-table").html == PAGE.replace("<TABLE><tr><td>2</table>", "[NEW $1\\]")


def test_no_match_leaves_the_page(pages):
    row = replaced(pages, preset="table-with-caption", caption_text="nope")
    assert row.html == PAGE and "nope" in row.error


def test_inserted_content_is_sanitised_unless_told_otherwise(pages):
    bad = "<table><tr><td onclick='x()'>n</td></tr></table><script>1</script>"
    assert "script" not in replaced(pages, bad).html and "onclick" not in replaced(pages, bad).html
    raw = td.replace_table(pages(PAGE), F.lit(bad), sanitize=False, pretty=True).head().html
    assert bad in raw and ">\n<" in raw


def test_replacement_by_key_and_from_payload(spark):
    docs = spark.createDataFrame([(1, PAGE), (2, PAGE), (None, PAGE)], "k int, html string")
    payloads = spark.createDataFrame([(1, "n,v\na,2\nb,10"), (None, "n,v\nz,1")], "k int, payload string")
    made = td.replacement_tables(
        payloads, "csv", shape=ShapeOptions(sort_by="v", order="descending", fields="v,n"),
        style=StyleOptions(numeric_alignment="right", table_width="full"),
    )
    out = {r.k: r.html for r in td.replace_from(docs, made, "k", "content").collect()}
    assert '<table style="width: 100%;"><thead><tr><th>v</th><th>n</th></tr></thead>' in out[1]
    assert '<tr><td style="text-align: right;">10</td><td>b</td></tr><tr><td style="text-align: right;">2</td>' in out[1]
    assert out[2] == PAGE.replace(">\n<", "><") and "<td>z</td>" in out[None]


def styled(pages, html, **options):
    return td.style_tables(pages(html), StyleOptions(**options)).head().html


def test_styles_merge_and_rows_are_counted_per_table(pages):
    out = styled(
        pages, PAGE, table_class="styled x", zebra=True, even_row_color="#eee", odd_row_color="#ddd", border_width=1,
        border_style="solid", table_style="width: 9px; height:1px", caption_position="bottom", numeric_alignment="right",
        cell_style="padding:1px", header_wrap="nowrap",
    )
    assert '<table class="t x styled" style="color: red; width: 9px; height: 1px; border-style: solid; border-width: 1px;" border="1">' in out
    assert '<caption style="caption-side: bottom;">c1</caption>' in out
    assert '<th style="white-space: nowrap; padding: 1px;">h</th>' in out
    assert '<thead><tr><th' in out
    assert out.count('<tr style="background-color: #eee;">') == 3 and out.count('<tr style="background-color: #ddd;">') == 1
    assert '<td style="background-color: blue; padding: 1px; text-align: right;">1,200.5%' in out
    assert '<td title="<table>" style="padding: 1px;">v' in out and '<td style="padding: 1px;">1<table' in out


def test_everything_else_is_untouched(pages):
    assert styled(pages, PAGE) == PAGE
    banded = styled(pages, PAGE, banded_rows="on")
    assert banded.count("#f9f9f9") == 3 and 'style="background-color:x"' in banded
    import re

    assert re.sub(r' style="background-color: #f9f9f9;"', "", banded) == PAGE


def test_each_option(pages):
    html = "<table><caption>c</caption><thead><tr><th>h</th></tr></thead><tbody><tr><td>x</td></tr></tbody></table>"
    cases = {
        "table_text_align": ("left", '<table style="text-align: left;">'),
        "body_text_align": ("center", '<table style="text-align: center;">'),
        "row_text_align": ("end", '<tr style="text-align: end;"><td>'),
        "row_style": ("a:b;;c; d : e:f", '<tr style="a: b; d: e:f;">'),
        "cell_text_align": ("right", '<th style="text-align: right;">h</th>'),
        "header_text_align": ("right", '<th style="text-align: right;">h</th>'),
        "header_vertical_align": ("top", '<th style="vertical-align: top;">'),
        "body_vertical_align": ("top", '<td style="vertical-align: top;">'),
        "body_wrap": ("wrap", '<td style="white-space: normal;">'),
        "table_width": ("auto", '<table style="width: auto;">'),
        "border_radius": ("3px", '<table style="border-radius: 3px;">'),
        "border_collapse": ("collapse", '<table style="border-collapse: collapse;">'),
        "caption_style": ("x:y", '<caption style="x: y;">'),
        "table_class": ("k", '<table class="k">'),
    }
    for name, (value, expected) in cases.items():
        assert expected in styled(pages, html, **{name: value}), name
    cells = styled(pages, html, border_cells=True, border_style="solid")
    assert '<td style="border-style: solid;">' in cells and '<table style="border-style: solid;">' in cells


@pytest.mark.parametrize("options", [{"table_text_align": "up"}, {"border_width": -1}, {"banded_rows": "yes"}, {"zebra": 1}, {"table_width": "1px"}])
def test_option_checks(options):
    with pytest.raises(OptionError):
        StyleOptions(**options)


def test_a_page_is_cut_only_at_tags_that_matter(pages, monkeypatch):
    from tabledocs.operators import style

    odd = PAGE + "<TABLE class=a><thead><TR><th>a<tr></thead><tbody title=\"<tr>\"><tr ><td/><td><!-- <td> --><tfoot><tr><td>f<track></table><tr"
    every = (
        StyleOptions(zebra=True, even_row_color="#eee", odd_row_color="#ddd", table_class="s"), StyleOptions(banded_rows="on", row_style="a:b"),
        StyleOptions(cell_style="padding:2px", header_wrap="nowrap", row_text_align="left"), StyleOptions(caption_style="a:b", border_width=2),
        StyleOptions(zebra=True, odd_row_color="red", banded_rows="on", cell_style="color: \"x\""), StyleOptions(),
    )
    df = pages(PAGE, odd, "", None, "<td>", "no table")

    def styled():
        return [[r.html for r in td.style_tables(df, o).orderBy("id").collect()] for o in every]

    assert "td" not in style._cut_tags(every[0]).split("|") and style._cut_tags(every[5]) == "table"
    cut = styled()
    monkeypatch.setattr(style, "_cut_tags", lambda o: style._TAGS)
    assert cut == styled()
