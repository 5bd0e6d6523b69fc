"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full through the ``noop`` sink (every row
computed, nothing collected): one warm-up run, then the median of $BENCH_RUNS
runs.
``customer_job_3_batches`` runs the stored layer job three times (bronze,
silver, two golds, SCD1, and an SCD2 merge into the versioned store per
batch, current slice bucketed by key) on customer snapshots prepared once,
untimed, from the test tables. ``customer_batches_3_incremental`` runs the
incremental form on three disjoint batches of the same rows. ``user_job`` runs
the CSV user flow (bronze, silver, gold) on the users view written once as CSV.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}; plan
counters (exchanges / windows / scans) go to stderr.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_valid_customers",
    "revenue_by_country",
    "revenue_by_segment",
    "user_count_by_country",
    "latest_per_customer",
    "scd1_customers",
    "scd2_merge",
    "scd2_changes",
    "scd2_three_snapshots",
    "dimension_report",
]


def _plan_counts(df) -> dict[str, int]:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    text = buf.getvalue()
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning", text)),
        "windows": len(re.findall(r"\bWindow \[", text)),
        "scans": len(re.findall(r"FileScan parquet", text)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    sf_value = float(sf.group(1)) if sf else None

    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from strata.plans import catalog
    from pyspark.sql import functions as F

    from strata.plans.layers import run_customer_batch, run_customer_job, run_user_job
    from strata.sources.tables import EXTRACTED_AT, SNAPSHOT_1_END, SNAPSHOT_2_END, customer_states, snapshot, users

    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn()
        return time.perf_counter() - t0

    results: dict[str, float] = {}
    for name in HEADLINE:
        print(name, _plan_counts(catalog.SPARK[name](spark, sf_dir)), file=sys.stderr)

        def run(name=name):
            # building the DataFrame is timed too: chained merges checkpoint their states
            catalog.SPARK[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        results[name] = round(statistics.median(timed(run) for _ in range(runs)), 3)

    scratch = tempfile.mkdtemp(prefix="strata-bench-")
    sources = []
    for n in (1, 2, 3):
        path = f"{scratch}/source/snapshot{n}"
        snapshot(spark, sf_dir, n).write.mode("overwrite").parquet(path)
        sources.append(path)

    job_times = []
    for attempt in range(runs + 1):
        wh = f"{scratch}/warehouse{attempt}"
        t = timed(lambda wh=wh: [run_customer_job(spark, src, wh, scd2_buckets=cpus) for src in sources])
        if attempt:
            job_times.append(t)
    results["customer_job_3_batches"] = round(statistics.median(job_times), 3)

    # incremental job: three disjoint batches by order date
    states = customer_states(spark, sf_dir, with_extract_date=True)
    at = F.col(EXTRACTED_AT)
    t1, t2 = (F.lit(t).cast("timestamp_ntz") for t in (SNAPSHOT_1_END, SNAPSHOT_2_END))
    batch_paths = []
    for i, cond in enumerate([at < t1, (at >= t1) & (at < t2), at >= t2]):
        path = f"{scratch}/source/batch{i}"
        states.filter(cond).drop(EXTRACTED_AT).write.parquet(path)
        batch_paths.append(path)
    batch_times = []
    for attempt in range(runs + 1):
        wh = f"{scratch}/batch_warehouse{attempt}"
        t = timed(
            lambda wh=wh: [
                run_customer_batch(spark, p, wh, i, scd2_buckets=cpus) for i, p in enumerate(batch_paths)
            ]
        )
        if attempt:
            batch_times.append(t)
    results["customer_batches_3_incremental"] = round(statistics.median(batch_times), 3)

    users_csv = f"{scratch}/source/users_csv"
    users(spark, sf_dir).write.option("header", "true").csv(users_csv)
    user_times = []
    for attempt in range(runs + 1):
        wh = f"{scratch}/user_warehouse{attempt}"
        t = timed(lambda wh=wh: run_user_job(spark, users_csv, wh))
        if attempt:
            user_times.append(t)
    results["user_job"] = round(statistics.median(user_times), 3)

    total = round(sum(results.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": total,
                "unit": "sec",
                "queries": results,
                "sf": sf_value,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
