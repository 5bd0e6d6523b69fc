"""Measure shuffle volume and the largest reduce-task input from Spark's event log.

Usage: python scripts/shuffle_probe.py [sf_dir]

Runs, each as its own job:
  * latest row per key over customer states where one key holds about a third
    of the rows -- with Catalyst's map-side group limit (default) and with it
    disabled (windowGroupLimitThreshold = -1);
  * one stored SCD2 merge of snapshot 2 into snapshot 1 -- plain layout and with
    the current slice bucketed by key;
  * one SCD1 merge of snapshot 2 into the SCD1 of snapshot 1 -- plain and
    bucketed previous state.
Prints one line per case: shuffle records written, shuffle bytes written, and
the most records any single task read from a shuffle. The event log goes to a
fresh scratch folder; the Spark UI stays off.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="strata-probe-")
    logs = f"{scratch}/events"
    os.makedirs(logs)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from strata.operators.dedupe import latest_per_key
    from strata.operators.rows import silver_customers
    from strata.operators.scd import scd1, scd1_merge
    from strata.plans.store import DimensionStore, VersionedTable
    from strata.schemas import scd2_schema
    from strata.sources.tables import EXTRACTED_AT, customer_states, snapshot

    sc = spark.sparkContext

    def case(name: str, action) -> None:
        sc.setJobGroup(name, name)
        action()
        sc.setJobGroup("setup", "setup")

    sc.setJobGroup("setup", "setup")

    # inputs are written once first, so each case counts only its own shuffles
    states = customer_states(spark, sf, with_extract_date=True)
    hot = F.col(EXTRACTED_AT) < F.lit("1997-03-01 00:00:00").cast("timestamp_ntz")
    hot_states = states.withColumn("customer_id", F.when(hot, F.lit("HOT")).otherwise(F.col("customer_id")))
    hot_states.drop(EXTRACTED_AT).repartition(32).write.parquet(f"{scratch}/hot")
    hot_states = spark.read.parquet(f"{scratch}/hot")
    n_hot = hot_states.filter(F.col("customer_id") == "HOT").count()
    print(json.dumps({"hot_key_rows": n_hot, "rows": hot_states.count(), "input_files": len(hot_states.inputFiles())}))

    def dedup() -> None:
        latest_per_key(hot_states, "customer_id", "updated_at").write.format("noop").mode("overwrite").save()

    case("dedup_hot_key_partial_limit", dedup)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    case("dedup_hot_key_no_partial_limit", dedup)
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")

    for n in (1, 2):
        silver_customers(snapshot(spark, sf, n)).write.parquet(f"{scratch}/s{n}")
    s1, s2 = (spark.read.parquet(f"{scratch}/s{n}") for n in (1, 2))
    for buckets in (None, 8):
        store = DimensionStore(spark, f"{scratch}/dim-{buckets}", scd2_schema(s1.schema), buckets=buckets)
        store.merge(s1)
        case(f"merge_buckets_{buckets}", lambda store=store: store.merge(s2))
    for buckets in (None, 8):
        table = VersionedTable(spark, f"{scratch}/scd1-{buckets}", s1.schema, key="customer_id", buckets=buckets)
        table.write_version(scd1(s1))
        case(
            f"scd1_merge_buckets_{buckets}",
            lambda table=table: table.write_version(scd1_merge(table.read_version(), s2)),
        )
    spark.stop()

    stage_group: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = {}
    files = sorted(p for p in glob.glob(f"{logs}/**/*", recursive=True) if os.path.isfile(p))
    for path in files:
        if os.path.basename(path).startswith(("appstatus", ".")) or path.endswith(".crc"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    group = props.get("spark.jobGroup.id") or props.get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        if group:
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev["Stage ID"])
                    if not group or group == "setup":
                        continue
                    m = ev.get("Task Metrics") or {}
                    w = m.get("Shuffle Write Metrics") or {}
                    r = m.get("Shuffle Read Metrics") or {}
                    t = totals.setdefault(group, {"records_written": 0, "bytes_written": 0, "max_task_records_read": 0})
                    t["records_written"] += w.get("Shuffle Records Written", 0)
                    t["bytes_written"] += w.get("Shuffle Bytes Written", 0)
                    t["max_task_records_read"] = max(t["max_task_records_read"], r.get("Total Records Read", 0))
    for name in sorted(totals):
        print(json.dumps({"case": name, **totals[name]}))


if __name__ == "__main__":
    main()
