"""Versioned Parquet storage for a type 2 dimension.

Plain Parquet tables cannot ``MERGE`` and must not be overwritten while they
are being read, so every merge writes a *new version* and a small log entry
commits it. Layout under ``root``::

    data/attempt=<version>-<id>/is_current=true/has_key=*/   current slice as of the version
    data/attempt=<version>-<id>/is_current=false/has_key=*/  rows closed by the version
    _log/                                                    one JSON row per committed version

Version ``n`` of the dimension is the current slice of ``n`` plus the closed
rows of versions ``base..n``; ``base`` is the last version written in full.
A merge therefore reads only the current slice of the previous version
(partition pruning on ``attempt`` and ``is_current``) and writes the new
current slice plus the rows it closes in one partitioned write -- history is
never rewritten.

With ``buckets=N`` the slices are also bucketed by the key into ``N`` files
per partition, and the next merge reads the current slice as a bucketed
table: it is already hash-partitioned by the key, so only the incoming
snapshot is shuffled (into the same ``N`` partitions). The store pins
``spark.sql.shuffle.partitions`` to ``N`` while it runs a merge, which is what
keeps both sides of the join co-partitioned. Rows without a key, which a merge
re-inserts every run and which would all fall into one bucket, sit in their
own ``has_key=false`` partition and are read by a plain, file-split scan.

Failure handling: every attempt writes to a fresh directory, and the log row
that names it is appended only after the data job has committed. A failed
attempt leaves an unnamed directory that no reader ever lists; the retry
writes a new one. Merges carrying a ``batch_id`` already in the log are
skipped, so replayed stream batches are idempotent. One writer per store.
"""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from strata.constants import CUSTOMER_KEY, CUSTOMER_ORDER, IS_CURRENT
from strata.operators.scd import SchemaMismatchError, empty_dimension, scd2_changes

ATTEMPT = "attempt"
HAS_KEY = "has_key"

LOG_SCHEMA = StructType(
    [
        StructField("version", IntegerType(), False),
        StructField("base", IntegerType(), False),
        StructField("kind", StringType(), False),
        StructField("batch_id", LongType(), True),
        StructField("path", StringType(), False),
        StructField("buckets", IntegerType(), True),
        StructField("committed_at", StringType(), False),
    ]
)


@dataclass(frozen=True)
class Commit:
    version: int
    base: int
    kind: str
    batch_id: int | None
    path: str
    buckets: int | None

    @property
    def attempt(self) -> str:
        return self.path.rstrip("/").rsplit(f"{ATTEMPT}=", 1)[1]


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str | None):
    """Temporarily set a session conf (no-op for ``None``)."""
    if value is None:
        yield
        return
    previous = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


@contextmanager
def _shuffle_partitions(spark: SparkSession, n: int):
    """Make every new shuffle produce ``n`` partitions (AQE's initial number included),
    so a shuffled side lines up with an ``n``-bucket table."""
    with _session_conf(spark, "spark.sql.shuffle.partitions", str(n)):
        with _session_conf(spark, "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n)):
            yield


def _write_bucketed(
    spark: SparkSession, rows: DataFrame, path: str, key: str, buckets: int, partition_by: tuple[str, ...] = ()
) -> None:
    """Write ``rows`` to ``path`` bucketed by ``key`` (``bucketBy`` needs a catalog
    table: a temporary external one is created and dropped, the files stay)."""
    tmp = "strata_write_" + uuid.uuid4().hex[:16]
    with _shuffle_partitions(spark, buckets):
        writer = rows.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.bucketBy(buckets, key).option("path", path).saveAsTable(tmp)
    spark.sql(f"DROP TABLE IF EXISTS {tmp}")


def _sql_string(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _bucketed_name(location: str, fields) -> str:
    shape = location + "|" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields)
    return "strata_bucketed_" + hashlib.sha1(shape.encode()).hexdigest()[:16]


def _drop_bucketed(spark: SparkSession, location: str, fields) -> None:
    """Forget the table registered over ``location`` (external: the files stay)."""
    spark.sql(f"DROP TABLE IF EXISTS {_bucketed_name(location, fields)}")


def _bucketed_table(spark: SparkSession, location: str, fields, key: str, buckets: int) -> str:
    """Register (once per location and schema) an external bucketed table over
    ``location`` and return its name. Columns missing from older files read as null."""
    name = _bucketed_name(location, fields)
    cols = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
        f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{_sql_string(location)}'"
    )
    return name


class VersionedTable:
    """A table kept as append-only versions under ``root``: every write goes to a
    fresh directory, and a row in the version log commits it.

    Used directly for tables that are rewritten whole on each version (the
    type 1 dimension of an incremental job); :class:`DimensionStore` builds
    the type 2 layout on the same log.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        key: str | None = None,
        buckets: int | None = None,
    ) -> None:
        if buckets is not None and (buckets < 1 or key is None):
            raise ValueError("buckets must be positive and need a key")
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.buckets = buckets

    # ---- paths ------------------------------------------------------------

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def log_path(self) -> str:
        return f"{self.root}/_log"

    def _new_attempt_path(self, version: int) -> str:
        return f"{self.data_path}/{ATTEMPT}={version:08d}-{uuid.uuid4().hex[:12]}"

    # ---- log ----------------------------------------------------------------

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG_SCHEMA).json(self.log_path)
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":  # nothing committed yet; any other error is raised
                return None
            raise

    def commits(self) -> list[Commit]:
        """Committed versions, oldest first (one small row per version)."""
        log = self._log()
        if log is None:
            return []
        rows = log.orderBy("version").collect()
        versions = [r.version for r in rows]
        if len(set(versions)) != len(versions):
            raise RuntimeError(f"{self.log_path} names a version twice: two writers committed at once, one of their merges is not in the other")
        return [Commit(r.version, r.base, r.kind, r.batch_id, r.path, r.buckets) for r in rows]

    def latest(self) -> Commit | None:
        commits = self.commits()
        return commits[-1] if commits else None

    def _append_log(self, commit: Commit) -> None:
        values = {
            "version": commit.version,
            "base": commit.base,
            "kind": commit.kind,
            "batch_id": commit.batch_id,
            "path": commit.path,
            "buckets": commit.buckets,
            "committed_at": datetime.now(timezone.utc).isoformat(),
        }
        row = self.spark.range(1).select(
            *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields]
        )
        row.write.mode("append").json(self.log_path)

    def _commit_for(self, version: int | None, commits: list[Commit] | None = None) -> Commit:
        commits = self.commits() if commits is None else commits
        if not commits:
            raise ValueError("store is empty")
        if version is None:
            return commits[-1]
        for c in commits:
            if c.version == version:
                return c
        raise ValueError(f"version {version} is not committed")

    def committed_batch(self, batch_id: int | None, commits: list[Commit] | None = None) -> Commit | None:
        """The commit that recorded ``batch_id``, if any (replays are skipped)."""
        if batch_id is None:
            return None
        for c in self.commits() if commits is None else commits:
            if c.batch_id == batch_id:
                return c
        return None

    # ---- whole-table versions ---------------------------------------------

    def read_version(self, version: int | None = None, commits: list[Commit] | None = None) -> DataFrame:
        """A version written by :meth:`write_version` (a bucketed table if written so).
        ``commits`` reuses a commit list already read from the log."""
        c = self._commit_for(version, commits)
        if not c.buckets:
            return self.spark.read.schema(self.schema).parquet(c.path)
        name = _bucketed_table(self.spark, c.path, self.schema.fields, self.key, c.buckets)
        return self.spark.table(name).select(*self.schema.fieldNames())

    def write_version(
        self, df: DataFrame, batch_id: int | None = None, commits: list[Commit] | None = None
    ) -> Commit:
        """Write ``df`` whole as the next version (skipped if ``batch_id`` is committed).

        Bucketed tables write with ``spark.sql.shuffle.partitions`` pinned to the
        bucket count, so a plan that joins a bucketed version with shuffled data
        lines both sides up without re-shuffling the version.
        """
        commits = self.commits() if commits is None else commits
        done = self.committed_batch(batch_id, commits)
        if done is not None:
            return done
        version = commits[-1].version + 1 if commits else 1
        path = self._new_attempt_path(version)
        rows = df.select(*self.schema.fieldNames())
        if self.buckets:
            _write_bucketed(self.spark, rows, path, self.key, self.buckets)
        else:
            rows.write.parquet(path)
        commit = Commit(version, version, "full", batch_id, path, self.buckets)
        self._append_log(commit)
        if commits and commits[-1].buckets:
            _drop_bucketed(self.spark, commits[-1].path, self.schema.fields)
        return commit


class DimensionStore(VersionedTable):
    """A type 2 dimension kept as append-only versions under ``root``."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        key: str = CUSTOMER_KEY,
        order: str = CUSTOMER_ORDER,
        buckets: int | None = None,
    ) -> None:
        if IS_CURRENT not in schema.fieldNames():
            raise ValueError("schema must be an SCD2 dimension schema")
        super().__init__(spark, root, schema, key=key, buckets=buckets)
        self.order = order

    # ---- reads --------------------------------------------------------------

    def _scan(self, paths: list[str]) -> DataFrame:
        full = StructType(
            [f for f in self.schema.fields if f.name != IS_CURRENT]
            + [
                StructField(ATTEMPT, StringType(), True),
                StructField(IS_CURRENT, BooleanType(), True),
                StructField(HAS_KEY, BooleanType(), True),
            ]
        )
        return self.spark.read.schema(full).option("basePath", self.data_path).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The whole dimension at ``version`` (default: latest)."""
        commits = self.commits()
        c = self._commit_for(version, commits)
        paths = [x.path for x in commits if c.base <= x.version <= c.version]
        a, cur = F.col(ATTEMPT), F.col(IS_CURRENT)
        rows = self._scan(paths).filter(((a == F.lit(c.attempt)) & cur) | ~cur | cur.isNull())
        return rows.select(*self.schema.fieldNames())

    def read_current(self, version: int | None = None) -> DataFrame:
        """Only the current slice at ``version`` (bucketed by key if written so)."""
        return self._read_current(self._commit_for(version))

    def _read_current(self, c: Commit) -> DataFrame:
        keyed, keyless = self._current_parts(c)
        return keyed if keyless is None else keyed.unionByName(keyless)

    def _current_parts(self, c: Commit) -> tuple[DataFrame, DataFrame | None]:
        """(current rows, None) -- or, bucketed, (keyed rows as a bucketed table, keyless rows)."""
        current = (F.col(ATTEMPT) == F.lit(c.attempt)) & F.col(IS_CURRENT)
        if not c.buckets:
            return self._scan([c.path]).filter(current).select(*self.schema.fieldNames()), None
        keyless = self._scan([c.path]).filter(current & ~F.col(HAS_KEY)).select(*self.schema.fieldNames())
        fields = [f for f in self.schema.fields if f.name != IS_CURRENT]
        location = f"{c.path}/{IS_CURRENT}=true/{HAS_KEY}=true"
        table = _bucketed_table(self.spark, location, fields, self.key, c.buckets)
        keyed = self.spark.table(table).withColumn(IS_CURRENT, F.lit(True)).select(*self.schema.fieldNames())
        return keyed, keyless

    # ---- writes -------------------------------------------------------------

    def _write(self, rows: DataFrame, version: int) -> str:
        path = self._new_attempt_path(version)
        rows = rows.select(*self.schema.fieldNames(), F.col(self.key).isNotNull().alias(HAS_KEY))
        if not self.buckets:
            rows.write.partitionBy(IS_CURRENT, HAS_KEY).parquet(path)
        else:
            _write_bucketed(self.spark, rows, path, self.key, self.buckets, (IS_CURRENT, HAS_KEY))
        return path

    def write_full(self, dim: DataFrame, batch_id: int | None = None) -> Commit:
        """Store a whole dimension as a new base version."""
        last = self.latest()
        version = 1 if last is None else last.version + 1
        path = self._write(dim, version)
        commit = Commit(version, version, "full", batch_id, path, self.buckets)
        self._append_log(commit)
        return commit

    def late_rows(self, incoming: DataFrame) -> DataFrame:
        """Rows of ``incoming`` that a merge would apply as late data (see
        :func:`strata.operators.quality.late_rows`); with buckets the stored
        current rows are read co-partitioned, only ``incoming`` is shuffled."""
        from strata.operators.quality import late_rows

        keyed, _ = self._current_parts(self._commit_for(None))
        return late_rows(keyed, incoming, self.key, self.order)

    def report(self, version: int | None = None) -> DataFrame:
        """One-row health summary of a version (see :func:`strata.operators.quality.dimension_report`)."""
        from strata.operators.quality import dimension_report

        return dimension_report(self.read(version), self.key)

    def compact(self) -> Commit:
        """Rewrite the latest version as a new base: one directory instead of the
        closed rows of every version since the last base. Readers of older
        versions are unaffected (their directories are kept)."""
        return self.write_full(self.read())

    def merge(self, incoming: DataFrame, batch_id: int | None = None, **options) -> Commit:
        """Merge a snapshot into the latest version and commit the result.

        ``options`` go to :func:`strata.operators.scd.scd2_changes`. The first
        merge into an empty store loads the snapshot as version 1.
        """
        commits = self.commits()
        done = self.committed_batch(batch_id, commits)
        if done is not None:
            return done
        unknown = [c for c in incoming.columns if c not in self.schema.fieldNames()]
        if unknown:
            raise SchemaMismatchError(
                f"snapshot columns {unknown} are not in the store schema; open the store with the "
                "evolved schema (older versions then read them as null) and merge with allow_missing_columns=True"
            )
        last = commits[-1] if commits else None
        keyless = None
        if last is None:
            existing = empty_dimension(incoming, self.order).select(
                *[F.col(f.name).cast(f.dataType) for f in self.schema.fields]
            )
            version, base = 1, 1
        else:
            existing, keyless = self._current_parts(last)
            version, base = last.version + 1, last.base
        changes = scd2_changes(existing, incoming, self.key, self.order, keyless_current=keyless, **options)
        out = changes.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        path = self._write(out, version)
        commit = Commit(version, base, "merge", batch_id, path, self.buckets)
        self._append_log(commit)
        if last is not None and last.buckets:
            fields = [f for f in self.schema.fields if f.name != IS_CURRENT]
            _drop_bucketed(self.spark, f"{last.path}/{IS_CURRENT}=true/{HAS_KEY}=true", fields)
        return commit
