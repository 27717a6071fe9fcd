"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of the tables and ``BENCH_CPUS`` the number of local threads.
The tables are first stored once more in many files, at every size alike, since a large table has
many row groups and a small one may have a single one, which keeps one thread busy; this is not
timed. Each query is run once to warm up and then timed once. Searches use a stored index, as they
would in use; building it is timed on its own.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from checks import queries as q
from checks import tables as t
from papyra.plans.index import build_index
from papyra.sources.scratch import scratch_path

HEADLINE = (
    "scan_papers", "prepared_papers", "dedup_abstract", "tag_covid", "tokenize_text",
    "bm25_postings", "bm25_scores", "search_topk", "search_flag_filter", "search",
    "search_batch", "search_results", "search_batch_results", "summarize_docs", "num_sentences",
)
FILES = 32


def in_many_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the tables of ``sf_dir``, each in ``FILES`` files."""
    folder = scratch_path(spark, "tables")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        spark.read.parquet(str(path)).repartition(FILES).write.parquet(f"{folder}/{path.name}")
    return folder


def build(spark: SparkSession, sf_dir: str):
    index = build_index(
        t.table(spark, sf_dir, "documents"), scratch_path(spark, "index"), "text",
        stop_words=t.SHORT_STOP_LIST, buckets=q.BUCKETS,
    )
    return index.stats


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: q.QUERIES[name] for name in HEADLINE} | {"build_index": build}
    tables, seconds = in_many_files(spark, sf_dir), {}
    for name, function in runs.items():
        for _ in range(2):
            start = time.time()
            function(spark, tables).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
