"""Versioned parquet tables: upserts without MERGE.

Parquet has no MERGE/UPDATE, so a keyed upsert is read -> join -> write a *new*
version directory, then a new one-line commit directory that names it. Nothing is
ever overwritten: readers take the highest commit, so a crash before the commit
leaves the previous version current, and there is no moment without one.

With ``bucket_by=(column, n)`` every version is written hash-bucketed and
sorted by the key, and read back through a table declaring that bucket spec,
so the daily keyed join reads the big table in place (``Bucketed: true``, no
Exchange on its side) and only the small batch is shuffled. With
``partition=(column, expression)`` a version also is partitioned by that column,
so a reader that knows which of its values it needs reads no other files.
"""

from __future__ import annotations

import hashlib
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def missing_path(e: AnalysisException) -> bool:
    """Only a path that does not exist reads as "no data yet"; any other error is an error."""
    return e.getCondition() == "PATH_NOT_FOUND"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: str, bucket_by: tuple[str, int] | None = None,
                 partition: tuple[str, str] | None = None):
        self.spark, self.root, self.schema, self.bucket_by, self.partition = spark, root, schema, bucket_by, partition
        self._commits = os.path.join(root, "commits")

    def _pointer_row(self) -> tuple[str, str] | None:
        """(path, metadata) of the highest commit; every commit is one line in a directory of its own."""
        try:
            row = self.spark.read.text(os.path.join(self._commits, "c-*")).agg(F.max("value")).first()
        except AnalysisException as e:
            if not missing_path(e):
                raise
            return None
        if not row or row[0] is None:
            return None
        _, path, meta = row[0].split("\t")
        return path, meta

    def current(self) -> str | None:
        p = self._pointer_row()
        return p[0] if p else None

    def meta(self) -> str:
        """Free-form metadata committed with the current version (e.g. a log watermark)."""
        p = self._pointer_row()
        return p[1] if p else ""

    def _load(self, path: str) -> DataFrame:
        if not self.bucket_by:
            return self.spark.read.parquet(path)
        col, n = self.bucket_by
        name = "jobmart_v_" + hashlib.sha1(path.encode()).hexdigest()[:16]
        if not self.spark.catalog.tableExists(name):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            by = f"PARTITIONED BY (`{self.partition[0]}`) " if self.partition else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet {by}CLUSTERED BY (`{col}`) "
                           f"SORTED BY (`{col}`) INTO {n} BUCKETS LOCATION '{path}'")
            if self.partition:
                self.spark.catalog.recoverPartitions(name)
        return self.spark.table(name)

    def read(self) -> DataFrame:
        path = self.current()
        if path is None:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn(self.partition[0], F.expr(self.partition[1])) if self.partition else empty
        return self._load(path)

    def stage(self, df: DataFrame) -> str:
        """Write a new version directory (not yet visible to readers)."""
        path = os.path.join(self.root, f"v-{time.time_ns()}-{uuid.uuid4().hex[:8]}")
        if self.bucket_by:
            col, n = self.bucket_by
            tmp = "jobmart_stage_" + uuid.uuid4().hex[:12]
            out = df.withColumn(self.partition[0], F.expr(self.partition[1])).write.partitionBy(self.partition[0]) if self.partition else df.write
            out.bucketBy(n, col).sortBy(col).format("parquet").option("path", path).saveAsTable(tmp)
            self.spark.sql(f"DROP TABLE {tmp}")  # external table: only the catalog entry goes
        else:
            df.write.parquet(path)
        return path

    def commit(self, path: str, meta: str = "") -> DataFrame:
        """Make a staged version current (with optional metadata, e.g. a log watermark)."""
        n = time.time_ns()
        line = f"{n:020d}\t{path}\t{meta}"
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(os.path.join(self._commits, f"c-{n:020d}"))
        return self._load(path)

    def write(self, df: DataFrame, meta: str = "") -> DataFrame:
        return self.commit(self.stage(df), meta)

    def truncate(self) -> DataFrame:
        """SNK-13: a new, empty version (older versions stay readable until cleaned up)."""
        return self.write(self.spark.createDataFrame([], self.schema))

    def delete_where(self, condition) -> DataFrame:
        """SNK-13: ``DELETE … WHERE condition`` as a filtered new version."""
        return self.write(self.read().where(~condition))


class LogTable:
    """Append-only parquet log, one partition per batch: who wrote it (``stream``) and its number there (``batch_id``).

    A stream numbers its own batches one after another; no two streams share a name, so none can overwrite another's
    rows. Writing a batch replaces only that batch's partition (dynamic partition overwrite): a replayed batch is
    idempotent, and the write costs the size of the batch. What a reader has covered is the last batch of every
    stream (``ends``), so a stream that turns up later, with low numbers, is still read.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root, f"{schema}, stream string, batch_id bigint"

    def write_batch(self, df: DataFrame, stream: str, batch_id: int = 0) -> None:
        (df.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch_id").parquet(self.root))

    def read(self, after: dict[str, int] | None = None, exclude: tuple[str, int] | None = None) -> DataFrame:
        """The log beyond ``after`` (partition pruning on both columns), without the batch ``exclude``."""
        try:
            df = self.spark.read.schema(self.schema).parquet(self.root)
        except AnalysisException as e:
            if not missing_path(e):
                raise
            return self.spark.createDataFrame([], self.schema)
        if after:
            # One condition for each last number, not for each stream: most streams of a log have a single batch.
            by_end: dict[int, list[str]] = {}
            for stream, end in after.items():
                by_end.setdefault(end, []).append(stream)
            unread = ~F.col("stream").isin(list(after))
            for end, streams in by_end.items():
                unread = unread | (F.col("stream").isin(streams) & (F.col("batch_id") > end))
            df = df.where(unread)
        if exclude is not None:
            df = df.where((F.col("stream") != exclude[0]) | (F.col("batch_id") != exclude[1]))
        return df

    def ends(self) -> dict[str, int]:
        """The last batch of every stream; one row for each stream comes to the driver."""
        return {r[0]: r[1] for r in self.read().groupBy("stream").agg(F.max("batch_id")).collect()}


def append_rows(spark: SparkSession, root: str, rows: DataFrame, part_col: str) -> None:
    """Adds rows to a date-partitioned parquet table; earlier files stay as they are."""
    rows.write.mode("append").partitionBy(part_col).parquet(root)


def read_rows(spark: SparkSession, root: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], schema)
