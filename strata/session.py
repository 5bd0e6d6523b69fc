"""Session helpers: shared checkpoint location and a local session for tests/bench."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Streaming checkpoints and lineage cuts go below it. Raises when the
    session names none: a machine-local default would not survive the loss of
    the machine, so callers that run locally must set it themselves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set ``fallback`` only where none is set (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)
    if not root:
        spark.sparkContext.setCheckpointDir(fallback)
        root = fallback
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "strata") -> SparkSession:
    """A local session configured like the tests and the benchmark."""
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the session's checkpoint folder and read it
    back, so later steps start from stored data instead of re-running its plan.

    A written table computes the plan once (an eager ``checkpoint()`` runs it
    twice: once to count, once to save). Returns ``df`` unchanged when the
    session names no checkpoint folder.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)
    if not root:
        return df
    path = f"{root.rstrip('/')}/strata-lineage/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
