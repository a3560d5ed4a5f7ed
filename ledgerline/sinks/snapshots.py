"""Snapshot writes: a new directory per version, never overwriting the data being read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerline.sinks import pointer


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a new Parquet snapshot at ``path`` and return the read of it (lineage cut)."""
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # read with the written schema: partition values keep their types (inference would guess)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Append ``df`` to the table at ``path`` and return the read of the whole table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def publish_snapshot(df: DataFrame, root: str, partition_by: Sequence[str] = (), after: int | None = None) -> str:
    """Write ``df`` as a new version under ``root/v=<id>/`` and publish it by a numbered pointer. Readers follow
    the newest pointer, so the version being read is never overwritten and a failed write is never visible.
    ``after`` (see ``current_version``): fail if another version was published since."""
    version = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/v={version}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    pointer.publish(df.sparkSession, f"{root.rstrip('/')}/_pointer", {"version": version, "path": path}, after)
    return path


def current_version(root: str) -> int:
    """Number of the newest version (0: none)."""
    return pointer.newest(f"{root.rstrip('/')}/_pointer")[0]


def read_current(spark, root: str, schema=None) -> DataFrame:
    """The newest published version (one small record is read on the driver: the path)."""
    path = pointer.newest(f"{root.rstrip('/')}/_pointer")[1]["path"]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
