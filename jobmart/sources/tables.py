"""Reading the landed parquet tables.

Only ``spark.read.parquet`` plus ``select``: Catalyst pushes the projection
and any later filter into the scan (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart import constants as K


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def checked_broadcast(df: DataFrame, max_rows: int = K.BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    The probe reads at most ``max_rows + 1`` rows (``limit`` stops early), so
    it stays cheap even when the side turns out large; beyond the bound the
    frame is returned unhinted and AQE picks the join from runtime sizes.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


_WRITTEN: dict[tuple, str] = {}


def write_table(df, name: str, key: tuple = (), spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and return the re-read table.

    This is how the jobs cut lineage (never ``localCheckpoint``): the folder is
    the one the cluster names in ``spark.checkpoint.dir`` (see
    :func:`jobmart.session.shared_dir`), so a lost executor re-reads files
    instead of recomputing the plan. ``key`` lets callers reuse a table
    written earlier in the same application; ``df`` may then be a zero-argument
    builder, called only when the table is not written yet.
    """
    import uuid

    from jobmart.session import shared_dir

    spark = spark or df.sparkSession
    cache_key = (spark.conf.get("spark.app.id", None) or id(spark), name, key)
    path = _WRITTEN.get(cache_key) if key else None
    if path is None:
        frame = df() if callable(df) else df
        path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
        frame.write.mode("overwrite").parquet(path)
        if key:
            _WRITTEN[cache_key] = path
    return spark.read.parquet(path)
