"""Headline queries on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from millrace import build_session  # noqa: E402
from millrace.catalog import all_queries  # noqa: E402
from millrace.operators.vectors import parse_sparse_lines  # noqa: E402
from millrace.session import materialize  # noqa: E402

HEADLINE = (
    "e1_token_counts", "f1_vocab_rank", "d3_encode_tokens", "j4_noise_bigrams", "j6_bucketize", "f4_running_loss_status",
    "f6_progress_last_max", "e13_log_epoch_summary", "g3_second_latest_checkpoint", "j1_sparse_to_dense",
    "b7_write_sparse_text", "e5_group_mean_vector", "j19_center_vector", "e9_tree_softmax_loss", "l2_tree_path_closure",
    "e4_group_rois", "f3_cap_per_class_any", "c2_filter_min_box_ratio", "d1_join_archive_labels", "d9_nearest_time_join",
    "d11_interval_label_join", "d12_match_way_section", "f10_rolling_features", "f11_step_windows", "f13_resample",
    "j1_sparse_harness_1024_lines",
)
HARNESS = HEADLINE[-1]


def run(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def sparse_harness(spark) -> float:
    """Parsing of 1,024 lines of one label and 16,014 features of density 0.125, stored before the clock starts."""
    wanted = F.filter(F.sequence(F.lit(1), F.lit(16_014)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(8)) == 0)
    entries = F.transform(wanted, lambda i: F.concat(i.cast("string"), F.lit(":0.5")))
    lines = materialize(spark.range(0, 1024, 1, 8).select("id", F.concat(F.lit("0:1 "), F.array_join(entries, " ")).alias("line")))
    start = time.perf_counter()
    parse_sparse_lines(lines, "line", 1, 16_014).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    run(spark, queries["e1_token_counts"], folder)  # start-up and class loading
    times = {name: round(run(spark, queries[name], folder), 3) for name in names if name != HARNESS}
    if HARNESS in names:
        times[HARNESS] = round(sparse_harness(spark), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
