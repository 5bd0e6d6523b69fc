"""Command line for the batch and streaming jobs (``spark-submit`` or ``python -m strata``).

    python -m strata user-job --source users.csv --warehouse /data/wh
    python -m strata customer-job --source /landing --warehouse /data/wh --batch-id 20240301 --buckets 512
    python -m strata customer-job --incremental --source /landing/2024-03-01 --warehouse /data/batches --batch-id 20240301
    python -m strata customer-stream --source /landing --warehouse /data/batches [--checkpoint DIR]
    python -m strata report --warehouse /data/wh [--version N]

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
memory and the shared ``spark.checkpoint.dir`` are whatever the submitter set.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="command", required=True)
    u = sub.add_parser("user-job", help="CSV users -> bronze, silver, gold")
    u.add_argument("--source", required=True)
    u.add_argument("--warehouse", required=True)
    u.add_argument("--strict", action="store_true")
    c = sub.add_parser("customer-job", help="Parquet customers -> layers + one SCD2 merge")
    c.add_argument("--source", required=True)
    c.add_argument("--warehouse", required=True)
    c.add_argument("--batch-id", type=int)
    c.add_argument("--buckets", type=int, help="keep the SCD2 current slice bucketed by key")
    c.add_argument("--strict", action="store_true")
    c.add_argument("--register", action="store_true", help="register the datasets in the catalog")
    c.add_argument(
        "--incremental",
        action="store_true",
        help="the source holds one new batch (needs --batch-id): append it instead of a full refresh",
    )
    c.add_argument("--ignore-late", action="store_true", help="keep newer SCD2 versions when a batch is older")
    s = sub.add_parser("customer-stream", help="run the incremental customer flow on every new batch of files")
    s.add_argument("--source", required=True)
    s.add_argument("--warehouse", required=True)
    s.add_argument("--checkpoint", help="default: below spark.checkpoint.dir")
    s.add_argument("--buckets", type=int)
    s.add_argument("--max-files-per-trigger", type=int)
    r = sub.add_parser("report", help="print the health report of the customer SCD2 dimension")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--version", type=int)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"strata-{args.command}").getOrCreate()
    from strata.plans.layers import customer_dimension, run_customer_batch, run_customer_job, run_user_job

    if args.command == "user-job":
        result = {"datasets": run_user_job(spark, args.source, args.warehouse, strict=args.strict)}
    elif args.command == "report":
        from strata.operators.rows import silver_customers
        from strata.schemas import CUSTOMER_SCHEMA

        silver_schema = silver_customers(spark.createDataFrame([], CUSTOMER_SCHEMA)).schema
        store = customer_dimension(spark, args.warehouse, silver_schema)
        (row,) = store.report(args.version).collect()  # one summary row
        result = {"version": store._commit_for(args.version).version, **row.asDict()}
    elif args.command == "customer-job" and args.incremental:
        if args.batch_id is None:
            raise SystemExit("--incremental needs --batch-id")
        late = {"late": "ignore"} if args.ignore_late else {}
        commit = run_customer_batch(
            spark, args.source, args.warehouse, args.batch_id, strict=args.strict, scd2_buckets=args.buckets, **late
        )
        result = {"scd2_version": commit.version, "path": commit.path}
    elif args.command == "customer-job":
        late = {"late": "ignore"} if args.ignore_late else {}
        commit = run_customer_job(
            spark,
            args.source,
            args.warehouse,
            batch_id=args.batch_id,
            strict=args.strict,
            register=args.register,
            scd2_buckets=args.buckets,
            **late,
        )
        result = {"scd2_version": commit.version, "path": commit.path}
    else:
        from strata.operators.rows import silver_customers
        from strata.schemas import CUSTOMER_SCHEMA
        from strata.streaming import customer_stream, read_stream

        stream = read_stream(spark, args.source, CUSTOMER_SCHEMA, max_files_per_trigger=args.max_files_per_trigger)
        customer_stream(stream, args.warehouse, checkpoint=args.checkpoint, scd2_buckets=args.buckets).awaitTermination()
        silver_schema = silver_customers(spark.createDataFrame([], CUSTOMER_SCHEMA)).schema
        latest = customer_dimension(spark, args.warehouse, silver_schema).latest()
        result = {"scd2_version": latest.version if latest else None}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
