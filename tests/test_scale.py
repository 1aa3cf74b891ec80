"""Groups of any size, plans without needless exchanges, streams and files."""

import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import tabledocs as td
from tabledocs import ExtractOptions, StyleOptions, TableSelector
from tabledocs.functions.payload import csv_records, json_records
from tabledocs.plans.assemble import running_totals
from tabledocs.sources import files
from tabledocs.streaming.documents import stream_documents, stream_rejects, stream_tables, write_records_and_rejects, write_stream


def skewed(spark, n=6000):
    """A third of all rows have one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").alias("v"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("t"),
    )


def test_hot_groups_are_written_in_bounded_ordered_parts(spark):
    df = skewed(spark)
    out = td.render_groups(df, ["k"], ["v", "t"], ["v"], "json", max_rows=300).collect()
    by_key = {}
    for r in sorted(out, key=lambda r: r.part):
        rows = json.loads(r.payload)
        assert len(rows) <= 300
        by_key.setdefault(r.k, []).extend(x["v"] for x in rows)
    expected = {}
    for r in df.orderBy("v").collect():
        expected.setdefault(r.k, []).append(r.v)
    assert by_key == expected and None in by_key


@pytest.mark.parametrize(("partitions", "adaptive"), [(1, "true"), (7, "false"), (200, "true")])
def test_parts_depend_on_the_rows_alone(spark, partitions, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = skewed(spark).repartition(partitions)
        out = td.group_text(df, ["k"], ["v"], F.col("v").cast("string"), separator=",", max_rows=300).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    hot = {r.part: r.body for r in out if r.k == "hot"}
    assert hot == {p: ",".join(str(3 * v) for v in range(300 * p, min(300 * p + 300, 2000))) for p in range(7)}


def test_sizes_are_counted_once_and_texts_wait(spark):
    """Building a frame counts the groups; nothing is collected before the frame is used, and groups that fit need one exchange."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(t):
        calls.add(1)
        return t

    df = skewed(spark, 300).withColumn("t", seen("t"))
    out = td.group_text(df, ["k"], ["v"], F.col("t"))
    assert calls.value == 300
    assert "rangepartitioning" not in plan(out)


def by_hand(rows, max_rows, max_bytes):
    """(key, part): texts, one row after the other."""
    out, state = {}, {}
    for key, order, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1], r[2] or "")):
        rank, before = state.get(key, (0, 0))
        out.setdefault((key, rank // max_rows + before // max_bytes), []).append(text)
        state[key] = (rank + 1, before + len((text or "").encode()))
    return {k: ",".join(t for t in v if t is not None) for k, v in out.items()}


@pytest.mark.parametrize("partitions", [1, 7, 200])
@pytest.mark.parametrize("bounds", [(50, 10**9), (10**9, 700), (40, 900), (1, 1)])
def test_parts_are_bounded_by_rows_and_bytes(spark, partitions, bounds):
    rows = [(r.k, r.v % 400, r.t if r.v % 11 else None) for r in skewed(spark, 1500).collect()] + [("long", 1, "é" * 1000), ("long", 2, "z"), ("long", 2, "z"), ("long", 3, "")]
    df = spark.createDataFrame(rows, "k string, v bigint, t string").repartition(partitions)
    got = td.group_text(df, ["k"], ["v"], F.col("t"), separator=",", max_rows=bounds[0], max_bytes=bounds[1]).collect()
    assert {(r.k, r.part): r.body for r in got} == by_hand(rows, *bounds) and len(got) == len({(r.k, r.part) for r in got})
    whole = td.group_text(df, [], ["k", "v"], F.col("t"), separator=",", max_rows=bounds[0], max_bytes=bounds[1]).collect()
    # without keys, null first
    alone = [(None, ((k is not None, k or "", v)), t) for k, v, t in rows]
    assert {(None, r.part): r.body for r in whole} == by_hand(alone, *bounds)


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_one_key_is_ranked_by_many_tasks(spark, partitions):
    """One key, and rows that all tie: ranks are 1 to n, sums run on, and stretches are about equal."""
    df = spark.range(40_000).select(F.lit("k").alias("k"), F.lit(5).alias("v"), F.lit(3).cast("bigint").alias("n")).repartition(partitions)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running_totals(df, ["k"], [F.col("v")], {"sum": F.col("n")})
        got = out.select("__rank", "sum", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(r["__rank"] for r in got) == list(range(1, 40_001)) and all(r["sum"] == 3 * r["__rank"] for r in got)
    sizes = sorted(Counter(r.p for r in got).values())
    assert len(sizes) > 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_no_groups(spark):
    empty = skewed(spark).where("false")
    assert td.group_text(empty, ["k"], ["v"], F.col("t")).count() == 0 and td.group_text(empty, [], ["v"], F.col("t")).count() == 0
    assert td.render_all(empty, ["v"], ["v"], "csv").count() == 0


def test_whole_batch_in_parts(spark):
    df = skewed(spark, 1000).select("v", "t")
    parts = td.render_all(df, ["v", "t"], ["v"], "csv", max_rows=90)
    recs = td.each(parts, ["part"], csv_records(F.col("payload")), "rec")
    assert sorted(int(r.v) for r in recs.select(F.col("rec")["v"].alias("v")).collect()) == list(range(1000))
    small = td.render_all(df, ["v"], ["v"], "html").collect()
    assert len(small) == 1 and small[0].payload.count("<tr>") == 1001


def test_combine_objects_keeps_types_and_order(spark):
    items = spark.createDataFrame([(2, '{"b":2,"__x":0}'), (1, '{"convertedData":[{"b":1,"c":"<"},{"c":"y"}]}')], "i int, item string")
    assert [r.payload for r in td.combine_objects(items, "item", ["i"]).collect()] == ['[{"b":1,"c":"<"},{"c":"y"},{"b":2}]']
    assert td.combine_objects(items, "item", ["i"], "csv").head().payload == "b,c\n1,<\n,y\n2,"
    assert "<td>1</td><td>&lt;</td>" in td.combine_objects(items, "item", ["i"], "html").head().payload


def test_columns_of_all_objects(spark):
    """Keys that only later objects have are columns too, in order of first appearance."""
    items = spark.createDataFrame([(3, '{"d":1,"a":2}'), (1, '{"a":1}'), (2, '[{"c":true,"b":null},{"b":2}]'), (4, "plain")], "i int, item string")
    for n in (1, 5):
        assert td.combine_objects(items.repartition(n), "item", ["i"], "csv").head().payload == "a,c,b,d,value\n1,,,,\n,true,,,\n,,2,,\n2,,,1,\n,,,,plain"
    parts = td.combine_objects(items, "item", ["i"], "html", max_rows=2).orderBy("part").collect()
    assert [p.part for p in parts] == [0, 1, 2] and all("<th>value</th>" in p.payload for p in parts)
    assert td.combine_objects(items.where("false"), "item", ["i"], "csv").count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reading_and_converting_pages_needs_no_exchange_and_no_python(pages):
    df = pages("<h1>a</h1><table><tr><th>x</th></tr><tr><td>1</td></tr></table>", "z")
    frames = [
        td.records(df), td.cells(df), td.tables(df),
        td.tables(df, options=ExtractOptions(selector=TableSelector("custom", table_selector="div > table"))),
        td.convert(df, "html", "json", "html"), td.convert(df, "csv", "html", "html"),
        td.replace_table(df, F.lit("x")), td.style_tables(df, StyleOptions(zebra=True, even_row_color="#eee")),
        td.split_rejects(df, td.html_error("html"), "id", "html", "json")[1],
    ]
    for frame in frames:
        text = plan(frame)
        assert "Exchange" not in text and "Python" not in text and "Window" not in text


def test_reading_is_evaluated_once(spark, tmp_path):
    """The optimizer must not copy the reading expression into a filter."""
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "<table><tr><td>1</td></tr></table>")], "id int, html string").write.parquet(path)
    text = plan(td.records(spark.read.parquet(path), "html", ExtractOptions(headings=False)))
    reads = re.findall("thead", text)
    assert text.count("Filter") >= 1 and len(reads) <= len(re.findall("thead", plan(td.with_tables(spark.read.parquet(path), "html", ExtractOptions(headings=False)))))


def test_grouping_has_one_exchange(spark):
    text = plan(td.group_text(skewed(spark), ["k"], ["v"], F.col("t")))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(i, f"<table><tr><th>v</th></tr><tr><td>{i}</td></tr></table>" if i % 3 else "bad") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id int, html string")
    df.repartition(3).write.parquet(source)
    plain = ExtractOptions(headings=False)
    stream = stream_documents(spark, source, "doc_id int, html string", files_per_trigger=1)
    write_stream(stream_tables(stream, "html", plain), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    write_stream(stream_rejects(stream, "doc_id"), f"{tmp_path}/bad", f"{tmp_path}/state2").awaitTermination()
    got = sorted((r.doc_id, r.rec["v"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    batch = td.records(df.filter(td.html_error("html").isNull()), "html", plain)
    assert got == sorted((r.doc_id, r.rec["v"]) for r in batch.collect())
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 10
    # later files only
    spark.createDataFrame([(99, rows[1][1])], "doc_id int, html string").write.mode("append").parquet(source)
    write_stream(stream_tables(stream, "html", plain), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(got) + 1


def test_stream_with_rejects_after_a_crash(spark, tmp_path):
    """A batch fails after its records are written and before its rejects are; the restarted stream has each document once."""
    source, out, bad, state = (str(tmp_path / x) for x in ("in", "out", "bad", "state"))
    rows = [(i, f"<table><tr><th>v</th></tr><tr><td>{i}</td></tr><tr><td>x</td></tr></table>" if i % 3 else "bad") for i in range(40)]
    spark.createDataFrame(rows, "doc_id int, html string").repartition(4).write.parquet(source)
    seen = {}

    def run(fail_at=None):
        documents = stream_documents(spark, source, "doc_id int, html string", files_per_trigger=1)

        def after(number, counts):
            seen[number] = counts
            if number == fail_at:
                raise RuntimeError("ended here")

        write_records_and_rejects(documents, "doc_id", out, bad, state, options=ExtractOptions(headings=False), after_batch=after).awaitTermination()

    def result():
        good = sorted((r.doc_id, r.row_no) for r in spark.read.parquet(out).collect())
        return good, sorted((r.doc_id, r.error) for r in spark.read.parquet(bad).collect())

    with pytest.raises(Exception, match="ended here"):
        run(fail_at=1)
    # what an attempt before has left of a batch: records only
    spark.createDataFrame([(777, 1, "v")], "doc_id int, row_no int, caption string").write.mode("overwrite").parquet(f"{out}/batch=1")
    run()
    expected = sorted((i, n) for i, _ in rows if i % 3 for n in (1, 2)), sorted((i, "no table elements found") for i, _ in rows if i % 3 == 0)
    assert result() == expected
    assert sorted(seen) == [0, 1, 2, 3] and sum(c["rows"] for c in seen.values()) == 40
    assert sum(c["good"] for c in seen.values()) == 26 and sum(c["rejected"] for c in seen.values()) == 14
    # nothing new: nothing written; later files only once
    run()
    assert result() == expected
    spark.createDataFrame([(99, rows[1][1]), (100, "")], "doc_id int, html string").coalesce(1).write.mode("append").parquet(source)
    run()
    assert len(result()[0]) == len(expected[0]) + 2 and result()[1][-1] == (100, "must be a non-empty string")


def test_counts_on_the_way(spark):
    """Counts of errors come from the job that writes, and equal the rejects."""
    df = spark.createDataFrame([(i, ["", "<p>", "<table></table>", None, " "][i % 5]) for i in range(50)], "id int, html string")
    marked = td.checked(df, td.html_error("html"))
    out, seen = td.counted(marked, "error", {"empty": "must be", "blank": "empty or", "never": "zzz", "also empty": "must"})
    rows = out.collect()
    errors = Counter(r.error for r in rows)
    assert seen.get == {"rows": 50, "good": 10, "empty": 20, "blank": 10, "never": 0, "also empty": 0, "other": 10}
    assert errors["must be a non-empty string"] == 20 and errors[None] == 10


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a "q", b', None), (2, "line\nbreak", "x")], "id int, t string, u string")
    files.write_csv(df, f"{tmp_path}/csv", ";")
    back = files.read_csv_files(spark, f"{tmp_path}/csv", ";").orderBy("id").collect()
    assert [(r.id, r.t) for r in back] == [("1", ' a "q", b'), ("2", "line\nbreak")]
    files.write_json(df, f"{tmp_path}/json")
    assert files.read_json_files(spark, f"{tmp_path}/json").count() == 2
    items = files.read_items(spark, f"{tmp_path}/json")
    assert td.each(items, ["file"], json_records(F.col("item")), "rec").count() == 2
    files.write_text(spark.createDataFrame([("g", "<p>")], "g string, payload string"), f"{tmp_path}/text", partition_by=["g"])
    docs = files.read_documents(spark, f"{tmp_path}/text/g=g/*.txt").collect()
    assert [d.payload for d in docs] == ["<p>\n"]
    given = files.literal_document(spark, "given").select(files.explicit_or_upstream(F.lit(""), F.col("payload")))
    assert given.head()[0] == "given"


def test_empty_result_per_id(spark):
    ids = spark.createDataFrame([(1,), (2,)], "k int")
    out = td.fill_empty(spark.createDataFrame([(1, "x")], "k int, output string"), ids, "k", "html")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x"), (2, "<table></table>")]


def test_bad_stream_level(spark):
    with pytest.raises(ValueError):
        stream_tables(None, level="pages")


@pytest.mark.parametrize("files", [1, 3])
def test_a_streamed_table_is_a_file_or_a_folder_of_files(spark, tmp_path, files):
    import pyarrow as pa
    import pyarrow.parquet as pq

    at = tmp_path / "tables" / "pages.parquet"
    at.parent.mkdir()
    pq.write_table(pa.table({"n": [99]}), at.parent / "other.parquet")
    make = lambda k: pa.table({"page_id": [10 * k + j for j in range(5)], "html": ["<table><tr><td>1</td></tr></table>"] * 5})
    if files == 1:
        pq.write_table(make(0), at)
    else:
        at.mkdir()
        for k in range(files):
            pq.write_table(make(k), at / f"part-{k}.parquet")
    stream = stream_documents(spark, str(at.parent), "page_id bigint, html string", entries="pages.parquet")
    write_records_and_rejects(stream, "page_id", f"{tmp_path}/out", f"{tmp_path}/rejects", f"{tmp_path}/state").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5 * files


def test_markdown_rows_are_numbered_through_a_whole_order(spark, tmp_path):
    from workload.queries import QUERIES

    n = 20_005
    lines = spark.range(n).select(
        F.when(F.col("id") < n - 2, 1).otherwise(2).cast("bigint").alias("l_orderkey"), F.col("id").alias("l_linenumber"), F.lit(3).cast("bigint").alias("l_partkey"),
        F.lit(4).cast("bigint").alias("l_suppkey"), F.lit(5.0).alias("l_quantity"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = QUERIES["markdown_cells"](spark, str(tmp_path))
    assert rows.columns == ["l_orderkey", "row_no", "a", "b", "c"] and dict(rows.dtypes)["row_no"] == "int"
    found = rows.select("l_orderkey", "row_no", "a").collect()
    wanted = {(1, i + 1, f"**{i}** *N*") for i in range(n - 2)} | {(2, i + 1, f"**{n - 2 + i}** *N*") for i in range(2)}
    assert len(found) == n and {tuple(r) for r in found} == wanted




def test_ranges_are_sampled_by_bounded_starts_of_texts(spark):
    from tabledocs.plans.assemble import BOUND_CHARS, _bounds

    rows = [(None,), ("",), ("b",), ("x" * 64,), ("x" * 64 + "a",), ("x" * 64 + "b",), ("x" * 5000,), ("y",)]
    df = spark.createDataFrame([(t, n) for (t,) in rows for n in (2, 1)], "t string, n int")
    bounds = _bounds(df, [F.col("t"), F.col("n")])
    starts = df.select("t", "n", F.struct(*bounds).alias("s")).orderBy("t", "n").collect()
    keys = [tuple((v is not None, v) for v in r["s"]) for r in starts]
    assert keys == sorted(keys) and all(len(r["s"][0] or "") <= BOUND_CHARS for r in starts)


def test_hot_groups_are_told_apart_without_a_shuffle_by_group(spark, monkeypatch):
    """Few groups, one with nearly all rows: joining by group would read that one in one task, whatever the sizes are."""
    monkeypatch.setattr("tabledocs.plans.assemble.STRETCH_BYTES", 1000)
    df = spark.range(3000).select(F.when(F.col("id") < 2900, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = td.group_text(df, ["k"], ["id"], F.col("id").cast("string"), separator=",", max_rows=100)
        joins = re.findall(r"SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin", out._jdf.queryExecution().executedPlan().toString())
        got = {(r["k"], r["part"]): r["body"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # wide's join is before the checkpoint: what is left are the small groups' and the offsets'
    assert joins and set(joins) == {"BroadcastHashJoin"}
    assert len(got) == 29 + 100 and all(got["hot", p] == ",".join(map(str, range(100 * p, 100 * p + 100))) for p in range(29))


def test_work_in_a_page_neither_copies_bound_values_nor_compares_by_expression(spark, pages):
    """A bound value is no element of an array, and structs are sorted by their order, not by a lambda per comparison."""
    html = "<h1>a</h1><table><tr><td>1</td></tr></table><h2>b</h2><table><tr><td>2</td></tr></table>"
    out = td.heading_keyed_json(td.with_tables(pages(html), "html", ExtractOptions()), "tables", "json")
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "array_sort(" not in plan and not re.search(r"\btransform\(array\(", plan)
    assert json.loads(out.first()["json"]) == {"a": {"_data": [["1"]], "b": [["2"]]}}


def test_paths_of_every_depth_are_written(spark, pages):
    """Levels that no table of a page has are passed over; deeper ones, and nodes with rows and children, are not."""
    heads = "".join(f"<h{k}>s{k}</h{k}><table><tr><td>{k}</td></tr></table>" for k in range(1, 6))
    out = td.heading_keyed_json(td.with_tables(pages(heads, "<table><tr><td>0</td></tr></table>", "<p>"), "html", ExtractOptions()), "tables", "json")
    deep = [["5"]]
    for k in range(4, 0, -1):
        deep = {"_data": [[str(k)]], f"s{k + 1}": deep}
    assert [json.loads(r["json"]) for r in out.orderBy("id").collect()] == [{"s1": deep}, {"table_1": [["0"]]}, {}]


MARKDOWN_PAGES = (
    "<table><tr><td> <b>1</b> <em>N</em></td><td><a class='x' href=\"/p/7\">part 7</a><br/><del>3</del></td><td><ul><li> N</li> <li>O</li></ul><ol><li>1</li><li><span>9</span></li></ol> z</td></tr></table>",
    "<table><tr><td><ul><li>a<ol><li>b</li><li>c</li></ol></li></ul></td><td><ol><li>&nbsp;x &amp; y </ol>z</td></tr></table>",
    "<table><tr><td><ol><li>open</td><td><li>stray</li></ul><ul></ul></td></tr></table>",
    "<table><caption><ul><li>c</li></ul></caption><tr><td><ul><li>1</li></ul></td></tr></table>",
    "<table><tr><td><a href=z><b>l</b></a><A HREF='q'>m</A> <p>t</p><code><b>k</b></code> a < b</td><td><blockquote> q </blockquote><h2>h</h2><hr></td></tr></table>",
    "<TABLE><tr><td title=\"<li>\">1<!-- <b> --></td><td><b class='k'>2</b></br><b/>3<x-y>4</x-y></td></tr></TABLE>",
    "<ul><li>before</li></ul><table><tr><th>n</th></tr><tr><td><table><tr><td><i>in</i></td></tr></table></td></tr></table><b",
)


def test_known_tags_are_read_as_all_others_are(pages, monkeypatch):
    """Looking tags up whole and writing lists once per page gives what the patterns and the numbering per cell give."""
    from tabledocs.functions import markup

    options = ExtractOptions(headings=False, cell_format="markdown")

    def read():
        return [r["tables"] for r in td.with_tables(pages(*MARKDOWN_PAGES), "html", options).orderBy("id").collect()]

    found = read()
    assert found[0][0]["rows"] == [["**1** *N*", "[part 7](/p/7)\n~~3~~", "- N\n- O\n1. 1\n2. 9\n z"]]
    monkeypatch.setattr(markup, "known_to_markdown", lambda page, structure, marks: F.lit("<other"))
    monkeypatch.setattr(markup, "write_lists", lambda text, marks: text)
    assert read() == found


def test_known_tags_and_plain_links_leave_no_tag(pages):
    from tabledocs.functions.markdown import known_to_markdown

    structure = {end + n: f"[{end}{n}]" for n in ("table", "tr", "td") for end in ("", "/")}
    out = pages(MARKDOWN_PAGES[0], "<b>a</b><i class='x'>b</i>").select(known_to_markdown(F.col("html"), structure, "\ufdd0").alias("t")).collect()
    assert "<" not in out[0]["t"] and "[part 7](/p/7)\n~~3~~" in out[0]["t"]
    assert out[1]["t"] == "**a**<i class='x'>b*"


@pytest.mark.parametrize("duplicates", ["append", "suffix"])
def test_paths_of_few_tables_are_searched_as_they_are_sorted(pages, monkeypatch, duplicates):
    """Pages up to a number of tables are nested by search, larger ones by sorting, with the same result."""
    from tabledocs.functions import outline_json

    made = ["".join(f"<h{1 + (i * i + n) % 3}>s {(i * 7 + n) % 5}</h1><table><tr><td>{i}</td></tr></table>" for i in range(n)) for n in (1, 2, 7, 20, 32, 33, 50)]
    read = td.with_tables(pages(*made, "<table><tr><td>0</td></tr></table><h2>é &amp; x</h2><table></table>"), "html", ExtractOptions())

    def keyed():
        return [r["json"] for r in td.heading_keyed_json(read, "tables", "json", td.WriteOptions(duplicates=duplicates)).orderBy("id").collect()]

    found = keyed()
    monkeypatch.setattr(outline_json, "_FEW", -1)
    assert keyed() == found
    monkeypatch.setattr(outline_json, "_FEW", 1000)
    assert keyed() == found
    assert list(json.loads(found[-1])) == ["table_1", "é_x"]


def test_headings_of_every_level_are_on_the_path(pages):
    """Levels that a page lacks are not looked up; those it has count as before."""
    html = "<table></table><h3>a</h3><table></table><h5>b</h5><table></table><h2> c\u00a0</h2><table></table><H5>d<i>e</i></H5><table></table><h1></h1><table></table>"
    found = td.with_tables(pages(html, "<table></table>", "<h4>x<table></table>"), "html", ExtractOptions()).orderBy("id").collect()
    paths = [[[(h["level"], h["text"]) for h in t["heading_path"]] for t in r["tables"]] for r in found]
    assert paths == [[[], [(3, "a")], [(3, "a"), (5, "b")], [(2, "c")], [(2, "c"), (5, "de")], [(1, "")]], [[]], [[(4, "x")]]]
