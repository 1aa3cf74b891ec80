"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one JSON line.

Every result is written in full to the no-op sink, so nothing is skipped by
column pruning or a limit.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import QUERIES  # noqa: E402

# round trips, whole-page work and payload ingest
HEADLINE = (
    "render_html_by_nation", "extract_records", "extract_cells", "table_inventory", "heading_path_tables",
    "select_under_heading", "css_scope_select", "heading_keyed_json", "sort_mixed_numeric", "sort_then_project",
    "csv_payload_records", "json_payload_records", "json_key_value_rows", "records_to_json", "multi_table_csv",
    "sanitize_pages", "html_depth_of_pages", "lossless_units_of_pages", "page_headings", "csv_validate",
    "json_validate", "markdown_cells", "replace_under_heading", "replace_from_records", "style_zebra",
    "style_numeric_align", "nested_all", "convert_html_to_csv", "convert_html_to_json", "convert_csv_to_html",
    "convert_json_to_csv", "convert_objects_to_json", "all_at_once", "sort_global_position",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tabledocs-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
