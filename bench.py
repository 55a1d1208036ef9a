"""Time the headline queries: one warm-up run and one timed run each, one JSON line at the end.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from registry.queries import QUERIES

HEADLINE = [
    "clean_text", "norm_question", "html_blocks", "budget_chunks", "pair_windows", "best_of_k", "drop_reason",
    "split_add_remove", "coverage_jaccard", "exact_dedup", "greedy_dedup", "paraphrase_dedup", "dense_dedup",
    "rebalance", "split_exact", "pack_sequences", "convert_format", "render_chat", "corpus_stats", "train_plan",
    "best_trial", "dataset_splits",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="run-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spent = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent[name] = round(time.perf_counter() - start, 3)
    line = {"metric": "headline queries, total", "value": round(sum(spent.values()), 3), "unit": "sec", "queries": spent, "sf": folder.rsplit("sf", 1)[-1]}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
