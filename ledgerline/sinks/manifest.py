"""The manifest of an archive folder: which files are archives, and what is in them.

A packing job writes its archives under names that only its own task attempts use, and never renames one:

    <root>/_job-<job>/<attempt>/<archive>            the archives of one task attempt
    <root>/_manifest/job-<job>.parquet               one row per archive of the attempts that succeeded
    <root>/_manifest/published/v<number>.json        the job is published

The last file is the publication. Readers take the archives that published jobs list and nothing else, so
what a failed, speculative or killed attempt leaves, or a driver that dies before the end, is never seen.
An archive that several jobs wrote is the one of the latest version.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sinks import pointer

FOLDER = "_manifest"
JOB_PREFIX = "_job-"
SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),        # name below the root, as given to the writer
    T.StructField("path", T.StringType()),           # the file
    T.StructField("bytes", T.LongType()),
    T.StructField("members", T.LongType()),
    T.StructField("files", T.LongType()),
    T.StructField("content_bytes", T.LongType()),
    T.StructField("companies", T.LongType()),        # companies with at least one member
    T.StructField("listed", T.LongType()),           # rows that name the archive without a member
    T.StructField("written_at", T.TimestampNTZType()),
])


def job_folder(root: str, job: str) -> str:
    return f"{root.rstrip('/')}/{JOB_PREFIX}{job}"


def write_entries(fs, root: str, job: str, entries: Iterable[tuple]) -> None:
    """The rows of one job, in the order of ``SCHEMA`` (driver side: one row per archive)."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = {"string": pa.string(), "bigint": pa.int64(), "timestamp_ntz": pa.timestamp("us")}
    schema = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in SCHEMA.fields])
    columns = list(zip(*entries)) or [()] * len(schema)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    fs.create_dir(f"{root}/{FOLDER}", recursive=True)
    with fs.open_output_stream(f"{root}/{FOLDER}/job-{job}.parquet") as out:
        pq.write_table(table, out)


def publish(spark: SparkSession, root: str, job: str) -> int:
    """Make the archives of a finished job visible."""
    return pointer.publish(spark, f"{root.rstrip('/')}/{FOLDER}/published", {"job": job})


def read_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per published archive under ``root`` (``SCHEMA``); None if nothing was ever published there."""
    root = root.rstrip("/")
    jobs = pointer.versions(f"{root}/{FOLDER}/published")
    if not jobs:
        return None
    order = spark.createDataFrame([(f"job-{r['job']}.parquet", n) for n, r in jobs], "_file string, _version bigint")
    rows = spark.read.schema(SCHEMA).parquet(*{f"{root}/{FOLDER}/job-{r['job']}.parquet" for _, r in jobs})
    if len(jobs) == 1:
        return rows
    rows = rows.withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1)).join(order, "_file")
    whole = F.struct(*(f.name for f in SCHEMA.fields))
    return rows.groupBy("archive").agg(F.max_by(whole, "_version").alias("_a")).select("_a.*")


def under(spark: SparkSession, folder: str) -> DataFrame | None:
    """The published archives in ``folder`` or below it, if it or the folder that holds it is a root; their
    names are relative to ``folder``."""
    folder = folder.rstrip("/")
    rows = read_manifest(spark, folder)
    if rows is not None:
        return rows
    above, name = posixpath.split(folder)
    rows = read_manifest(spark, above)
    if rows is None:
        return None
    inside = rows.filter(F.startswith("archive", F.lit(name + "/")))
    return inside.withColumn("archive", F.substring("archive", len(name) + 2, 1 << 30))


def missing(spark: SparkSession, root: str) -> DataFrame:
    """Published archives whose file is gone or has another size: archive, path, bytes, found_bytes (null: gone)."""
    from ledgerline.session import ship_package

    ship_package(spark)

    def sizes(batches):
        import pyarrow as pa

        from ledgerline.sinks.archives import filesystem

        for batch in batches:
            found = []
            for path in batch.column(1).to_pylist():
                fs, p = filesystem(path)
                found.append(fs.get_file_info(p).size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())],
                                             names=["archive", "path", "bytes", "found_bytes"])

    checked = read_manifest(spark, root).select("archive", "path", "bytes").mapInArrow(
        sizes, "archive string, path string, bytes bigint, found_bytes bigint")
    return checked.filter(~F.equal_null("bytes", "found_bytes"))
