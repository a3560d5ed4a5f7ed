"""Continuous skip-if-held ingestion of newly landed filings. Nothing is dropped for being late.

Held keys and sink are laid out in key buckets: folders by columns that the key decides (the filing year)
and by a hash of the key. A micro-batch looks up the buckets that its own keys fall into and reads no other
folder, of the held set as of the sink, so its cost follows what arrived and not what is stored. Rows that
arrive in time order touch the newest buckets only; a late row touches its own.

Each micro-batch is de-duplicated on the key, anti-joined with its buckets of the held set and with what
earlier epochs stored there, and written to ``<bucket>/epoch=<id>``: a replayed epoch overwrites its own
folders, so the sink is exactly-once. There is no watermark and no state beside the sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "key_bucket"
EPOCH = "epoch"


@dataclass(frozen=True)
class KeyBuckets:
    """Layout by ``by`` (columns that are the same for rows of one key) and ``n`` hash buckets of the key."""

    key: tuple[str, ...] = ("accession",)
    by: tuple[str, ...] = ("filing_year",)
    n: int = 8

    @property
    def columns(self) -> list[str]:
        return [*self.by, BUCKET]

    def add(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.n)).cast("int"))

    def touched(self, rows: DataFrame) -> list[Row]:
        """The buckets of a micro-batch (at most its values of ``by`` times ``n``)."""
        return rows.select(*self.columns).distinct().collect()

    def write(self, rows: DataFrame, root: str, epoch: int | None = None) -> None:
        """Add rows to their buckets, one file each; an epoch replaces what it wrote before."""
        rows = self.add(rows).repartition(*self.columns)
        inner = [] if epoch is None else [EPOCH]
        if inner:
            rows = rows.withColumn(EPOCH, F.lit(epoch).cast("bigint"))
        (rows.write.mode("overwrite" if inner else "append").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.columns, *inner).parquet(root))

    def read(self, spark: SparkSession, root: str, schema: T.StructType, touched: list[Row], before: int | None = None) -> DataFrame:
        """Keys stored in the touched buckets; only their folders are listed. ``before``: of earlier epochs."""
        jvm = spark._jvm
        paths = []
        for row in touched:
            path = jvm.org.apache.hadoop.fs.Path("/".join([root.rstrip("/"), *(
                f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in self.columns)]))
            if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
                paths.append(str(path.toString()))
        key = list(self.key)
        if not paths:
            return spark.createDataFrame([], T.StructType([schema[c] for c in key]))
        whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(EPOCH, T.LongType())])
        stored = spark.read.schema(whole).option("basePath", root).parquet(*paths)
        if before is not None:
            stored = stored.filter(F.col(EPOCH) < before)
        return stored.select(*key)


def write_held(held: DataFrame, root: str, buckets: KeyBuckets = KeyBuckets()) -> str:
    """Store the held keys (key and ``by`` columns) in buckets; returns the folder."""
    buckets.write(held.select(*buckets.key, *buckets.by).distinct(), root)
    return root


def ingest_new(spark: SparkSession, source: str, schema: T.StructType, held: str, sink: str, checkpoint: str,
               buckets: KeyBuckets = KeyBuckets(), files_per_trigger: int = 1) -> None:
    """Run the ingestion until all landed files are processed (availableNow). ``held``: see ``write_held``."""
    key = list(buckets.key)
    keys = T.StructType([schema[c] for c in dict.fromkeys([*buckets.key, *buckets.by])])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    root = spark._jvm.org.apache.hadoop.fs.Path(sink)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(root)  # so that a stream without news can be read

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            touched = buckets.touched(buckets.add(batch))
            kept = buckets.read(spark, held, keys, touched)
            earlier = buckets.read(spark, sink, keys, touched, before=epoch_id)
            new = batch.dropDuplicates(key).join(kept, key, "left_anti").join(earlier, key, "left_anti")
            buckets.write(new, sink, epoch_id)
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_ingested(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """Everything that was stored, with the landed rows' columns."""
    return spark.read.schema(schema).parquet(sink).select(*schema.names)
