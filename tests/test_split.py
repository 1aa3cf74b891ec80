"""Large files that are read in blocks, against the plain readers."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tabledocs.sources.files import read_csv_files
from tabledocs.sources.split import csv_file_records, json_array_items, read_large_csv


@pytest.fixture
def blocks(spark):
    """Blocks of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def make(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield make
    for n, v in before.items():
        spark.conf.set(n, v)


def field(rng):
    text = "".join(rng.choice(['"', "\n", "\r\n", ",", ";", " ", "a", "é", "x" * 30, "{", "}", "\\"]) for _ in range(rng.randrange(6)))
    quoted = '"' + text.replace('"', '""') + '"'
    return quoted if any(c in text for c in '",\n\r;') or rng.random() < 0.1 else text


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_csv_like_the_plain_reader(spark, tmp_path, blocks, newline):
    rng = random.Random(3)
    for k in range(3):
        rows = [["id", "a b", "c"]] + [[f"{k}-{i}", field(rng), field(rng)] for i in range(300)]
        if k == 2:
            rows[5][1] = '"' + "long\n" * 900 + '"'
        text = newline.join(",".join(r) for r in rows)
        (tmp_path / f"f{k}.csv").write_bytes((text + (newline if k else "")).encode())
    def plain(rows):
        # the plain reader normalises line breaks of fields in such files
        return sorted(tuple(x if x is None or newline == "\n" else x.replace("\r\n", "\n") for x in r) for r in rows)

    expected = plain([tuple(x or "" for x in r) for r in read_csv_files(spark, str(tmp_path)).collect()])
    for size in (100, 1777, 10**9):
        blocks(size)
        got = read_large_csv(spark, str(tmp_path))
        assert got.columns == ["id", "a b", "c"] and plain([tuple(x or "" for x in r) for r in got.collect()]) == expected
    blocks(1777)
    assert csv_file_records(spark, str(tmp_path)).select("block").distinct().count() > 4
    ordered = csv_file_records(spark, str(tmp_path / "f1.csv")).orderBy("block", "at").select("text").collect()
    assert [r.text.split(",")[0] for r in ordered] == ["id"] + [f"1-{i}" for i in range(300)]


def value(rng, depth=3):
    kind = rng.randrange(6 if depth else 4)
    if kind == 0:
        return rng.choice([1, -2.5, True, None])
    if kind < 4:
        return "".join(rng.choice(['"', "}", "{", "\\", "\n", "]", "é", ",", "a", "\\\""]) for _ in range(rng.randrange(7)))
    return {f"k{i}": value(rng, depth - 1) for i in range(rng.randrange(4))} if kind == 4 else [value(rng, depth - 1) for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("indent", [None, 1])
def test_json_array_like_a_parser(spark, tmp_path, blocks, indent):
    rng = random.Random(4)
    whole = {}
    for k in range(3):
        items = [{"i": i, "v": value(rng), "w": value(rng)} if rng.random() < 0.8 else value(rng) for i in range(250)]
        whole[f"f{k}.json"] = items
        (tmp_path / f"f{k}.json").write_text(json.dumps(items, indent=indent, ensure_ascii=k == 1) + "\n" * k)
    (tmp_path / "empty.json").write_text(" [ ]\n")
    for size in (64, 1500, 10**9):
        blocks(size)
        got = {}
        for r in json_array_items(spark, str(tmp_path)).orderBy("file", "block", "at", "part").collect():
            got.setdefault(os.path.basename(r.file), []).append(r.item)
        for name, items in whole.items():
            read = [x if isinstance(y, str) else None if x is None else json.loads(x) for x, y in zip(got[name], items, strict=True)]
            assert read == items
        assert set(got) == set(whole)


def test_many_tasks(spark, tmp_path, blocks):
    """One file of a single line, and one of long quoted fields, are read by many tasks."""
    blocks(200_000)
    with open(tmp_path / "one.json", "w") as out:
        out.write("[" + ",".join(json.dumps({"i": i, "t": "}" * (i % 50)}) for i in range(60_000)) + "]")
    with open(tmp_path / "one.csv", "w") as out:
        out.write("i,t\n" + "".join(f'{i},"{i}\n{"y" * (i % 50)}"\n' for i in range(40_000)))
    items = json_array_items(spark, str(tmp_path / "one.json"))
    assert items.select("block").distinct().count() > 8
    assert items.agg(F.count("item"), F.sum(F.get_json_object("item", "$.i").cast("long"))).head() == (60_000, sum(range(60_000)))
    table = read_large_csv(spark, str(tmp_path / "one.csv"))
    assert table.agg(F.count("t"), F.sum(F.col("i").cast("long")), F.sum(F.length("t"))).head()[:2] == (40_000, sum(range(40_000)))
