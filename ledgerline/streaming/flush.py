"""Count-triggered batch flushing: each success of a run gets a batch number on arrival; a batch is emitted
when its B-th member is in, and the open batch when the run's end is signalled.

Each micro-batch is one step of a ``foreachBatch``:

1. Its successes are ranked per run by (time, id) with the exact rank over range slices
   (``operators/ranking.py``): rows of one run, even if it is the only one, spread over many tasks.
2. A small table of counters, one row per run and epoch, says how many came before; rank plus counter is the
   position in the run, and the position decides the batch.
3. Members, emitted batches and the new counters are written under ``epoch=<id>``.

A replayed epoch starts from the counters of the epoch before it and overwrites its own folders, so each
success is numbered once. Across micro-batches the order is arrival order. A success that comes after its
run's end goes on in the batch that was open; the next end signal emits that batch again, and readers take the
latest emission.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators.ranking import ordered_rank

MEMBERS = "run_id string, item bigint, ticker string, seq bigint, batch_no bigint, batch_closed boolean"
EMITTED = "run_id string, batch_no bigint, n_companies bigint, closed_as string"
COUNTERS = "run_id string, n_done bigint"
FULL, REMAINDER = "full", "remainder"


def _at(sink: str, table: str, epoch: int) -> str:
    return f"{sink.rstrip('/')}/{table}/epoch={epoch:09d}"


def flush_batches(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, batch_size: int,
                  files_per_trigger: int = 1, end_col: str = "run_ended") -> None:
    """Stream landed completions into numbered batches. Rows where ``end_col`` is true are no completions but
    signal that their run is over; a source without such a column never ends a run."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    ended = F.coalesce(F.col(end_col), F.lit(False)) if end_col in schema.names else F.lit(False)

    def step(batch: DataFrame, epoch: int) -> None:
        def written(df: DataFrame, table: str) -> DataFrame:
            path = _at(sink, table, epoch)
            df.write.mode("overwrite").parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        before = (spark.read.schema(COUNTERS).parquet(_at(sink, "counters", epoch - 1)) if epoch
                  else spark.createDataFrame([], COUNTERS))
        done = batch.filter(F.col("ok") & ~ended).select("run_id", "item", "ticker", "ts")
        ranked = ordered_rank(done, ["ts", "item"], ["run_id"], rank_col="_rank")
        seq = F.coalesce("n_done", F.lit(0)).cast("bigint") + F.col("_rank")
        members = ranked.join(before, "run_id", "left").select("run_id", "item", "ticker", seq.alias("seq"))
        members = written(members.select("*", S.batch_of("seq", batch_size).alias("batch_no"),
                                         (F.col("seq") % batch_size == 0).alias("batch_closed")), "members")
        reached = members.groupBy("run_id").agg(F.max("seq").alias("n_done"))
        after = written(before.unionByName(reached).groupBy("run_id").agg(F.max("n_done").alias("n_done")), "counters")
        full = members.filter("batch_closed").select(
            "run_id", "batch_no", F.lit(batch_size).cast("bigint").alias("n_companies"), F.lit(FULL).alias("closed_as"))
        over = batch.filter(ended).select("run_id").distinct().join(after, "run_id").filter(F.col("n_done") % batch_size > 0)
        rest = over.select("run_id", S.batch_of("n_done", batch_size).alias("batch_no"),
                           (F.col("n_done") % batch_size).cast("bigint").alias("n_companies"), F.lit(REMAINDER).alias("closed_as"))
        written(full.unionByName(rest), "emitted")

    q = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_flushed(spark: SparkSession, sink: str) -> DataFrame:
    """Every numbered success; ``batch_closed`` marks the member that filled its batch."""
    return spark.read.schema(MEMBERS).parquet(f"{sink.rstrip('/')}/members")


def read_emitted(spark: SparkSession, sink: str) -> DataFrame:
    """The emitted batches: run_id, batch_no, n_companies and ``closed_as`` (full, or remainder at the run's end)."""
    rows = spark.read.schema(EMITTED + ", epoch bigint").parquet(f"{sink.rstrip('/')}/emitted")
    last = rows.groupBy("run_id", "batch_no").agg(F.max_by(F.struct("n_companies", "closed_as"), "epoch").alias("_e"))
    return last.select("run_id", "batch_no", "_e.*")
