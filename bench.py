"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. Arguments, if any,
are prefixes of query names to time instead of the headline ones.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tallywatch import build_session
from tallywatch.plans.catalog import QUERIES

HEADLINE = (
    "A1_prediction_statistics",
    "A2_J1_deployment_metrics",
    "A4_alert_summary",
    "A21_J9_duration_histogram",
    "G1_fit_terms",
    "G2_term_weights",
    "G3_centroid_drift",
    "G4_length_ks",
    "G5_data_drift",
    "G6_concept_drift",
    "G9_drift_monitor",
    "G11_column_drift",
    "P15_J7_encoded_texts",
    "T3_histogram_quantiles",
    "T6_peak_concurrency",
    "W9_alert_lifecycle",
    "W13_stratified_split",
    "W18_would_be_cache_hits",
    "P18_text_descriptors",
    "G13_descriptor_drift",
    "G14_batch_scores",
    "G15_trained_classifier",
    "R5_streamed_drift",
    "T3_merged_sketches",
    "G11_distances_by_kind",
)
# the table whose rows a query's rate is counted in, by the beginning of its name; events otherwise
TABLES = {"G1_": "documents", "G2": "documents", "G3": "documents", "G4": "documents", "P": "documents", "G13": "documents",
          "G14": "documents", "G15": "documents", "W13": "documents", "A4": "orders", "W9": "lineitem"}


def spread(spark, folder: str, into: str, files: int) -> str:
    """A folder with the same tables whose texts lie in several files: the given file has one row group, which one task would read."""
    for name in os.listdir(folder):
        if name != "documents.parquet":
            os.symlink(f"{os.path.abspath(folder)}/{name}", f"{into}/{name}")
    spark.read.parquet(f"{folder}/documents.parquet").repartition(files).write.parquet(f"{into}/documents.parquet")
    return into


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = [n for n in QUERIES if n.startswith(tuple(sys.argv[1:]))] if sys.argv[1:] else HEADLINE
    # start-up and code compilation belong to no query: every query runs once on the smallest tables first
    smallest = f"{folder.rstrip('/').rsplit('/', 1)[0]}/sf0.001"
    for name in chosen if os.path.isdir(smallest) else []:
        QUERIES[name](spark, smallest).write.format("noop").mode("overwrite").save()
    given, scratch = folder, tempfile.TemporaryDirectory(prefix="bench-")
    folder = spread(spark, given, scratch.name, int(cpus))
    timings = {}
    for name in chosen:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - began, 3)
    counts = {table: spark.read.parquet(f"{folder}/{table}.parquet").count() for table in {*TABLES.values(), "events"}}
    table_of = {n: next((t for p, t in TABLES.items() if n.startswith(p)), "events") for n in timings}
    rates = {n: round(counts[table_of[n]] / max(s, 1e-3)) for n, s in timings.items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rows_per_sec": rates,
                "sf": given.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
