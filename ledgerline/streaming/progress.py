"""Live progress: done and failed counts per run as completions stream in (complete mode; each
micro-batch replaces the snapshot of counts, so readers always see a consistent total)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def live_counts(spark: SparkSession, source: str, schema, sink: str, checkpoint: str,
                files_per_trigger: int = 1) -> None:
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    counts = stream.groupBy("run_id", "ok").agg(F.count(F.lit(1)).alias("n"))

    def publish(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id:09d}")

    q = (counts.writeStream.outputMode("complete").foreachBatch(publish)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The snapshot of the newest epoch (a scalar subquery picks it; no join)."""
    df = spark.read.parquet(sink)
    return df.filter(F.col("epoch") == df.select(F.max("epoch")).scalar()).drop("epoch")
