"""Streaming queries: each lands its input in time-ordered files, runs the stream to completion
(availableNow) into a sink under the shared scratch area and returns the read of the sink. The
oracle is that of the batch counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import incremental
from ledgerline.plans.registry import query
from ledgerline.plans.run_queries import _BATCHES_SQL
from ledgerline.session import scratch_dir
from ledgerline.sources import fixtures as X
from ledgerline.streaming import flush, ingest, progress
from ledgerline.sources.landing import land_in_order

# Landed files are consecutive time slices, so taking two per trigger keeps arrival in time order
# (a micro-batch holds a contiguous time range) while state still spans several micro-batches.
FILES_PER_TRIGGER = 2

@query("stm_ingest_new", """
SELECT ticker, filing_year, form, accession FROM wanted w
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.k = w.k)
""")
def stm_ingest_new(spark, d):
    """Wanted filings arrive as a file stream (oldest first, the newest chunk delivered twice);
    filings that are held or already stored are skipped, however late they come."""
    idx = X.filing_index(spark, d)
    wanted = X.wanted(spark, d, idx).select("k", "ticker", "accession", "form", "filing_year", "filed_at")
    src = scratch_dir(spark, "landing-index")
    land_in_order(wanted, src, ["filed_at", "k"])
    # re-delivery: the newest year's filings land again, after everything else
    newest = wanted.filter(F.col("filing_year") == X.year_range()[1])
    land_in_order(newest, src, ["filed_at", "k"], min_chunks=1)
    sink, ckpt = scratch_dir(spark, "ingest-sink"), scratch_dir(spark, "ingest-ckpt")
    # the held keys are stored in buckets for the stream, which reads those that a micro-batch touches
    held = incremental.held_union(X.staged(spark, d, idx), X.archived(spark, d, idx), ["accession", "filing_year"])
    held = ingest.write_held(held, scratch_dir(spark, "held"))
    ingest.ingest_new(spark, src, wanted.schema, held, sink, ckpt, files_per_trigger=FILES_PER_TRIGGER)
    return ingest.read_ingested(spark, sink, wanted.schema).select("ticker", "filing_year", "form", "accession")


@query("stm_batch_flush", _BATCHES_SQL + """
SELECT run_id, item, ticker, seq, batch_no, CASE WHEN n < 12 THEN 'remainder' ELSE 'full' END AS closed_as, CAST(n AS BIGINT) AS n_companies
FROM (SELECT *, count(*) OVER (PARTITION BY run_id, batch_no) AS n FROM batches)
""")
def stm_batch_flush(spark, d):
    """Completions arrive in time order in chunks, each run's end after its last one; successes are numbered
    on arrival and their batches emitted: members of every emitted batch, the remainders among them."""
    done = X.completion(spark, d).withColumn("run_ended", F.lit(False))
    ends = done.groupBy("run_id").agg(F.max("ts").alias("ts")).select(
        "run_id", "ts", F.lit((1 << 63) - 1).alias("item"), F.lit(False).alias("ok"), F.lit(True).alias("run_ended"))
    landed = done.unionByName(ends, allowMissingColumns=True)
    src = scratch_dir(spark, "landing-events")
    land_in_order(landed, src, ["ts", "item"])
    sink, ckpt = scratch_dir(spark, "flush-sink"), scratch_dir(spark, "flush-ckpt")
    flush.flush_batches(spark, src, landed.schema, sink, ckpt, X.BATCH_SIZE, files_per_trigger=FILES_PER_TRIGGER)
    members = flush.read_flushed(spark, sink).join(flush.read_emitted(spark, sink), ["run_id", "batch_no"])
    return members.select("run_id", "item", "ticker", "seq", "batch_no", "closed_as", "n_companies")


@query("stm_progress", """
SELECT run_id, ok, CAST(count(*) AS BIGINT) AS n FROM completion GROUP BY run_id, ok
""")
def stm_progress(spark, d):
    """Live done / failed counts per run; the final snapshot equals the batch counts."""
    src = scratch_dir(spark, "landing-progress")
    land_in_order(X.completion(spark, d), src, ["ts", "item"])
    sink, ckpt = scratch_dir(spark, "progress-sink"), scratch_dir(spark, "progress-ckpt")
    schema = X.completion(spark, d).schema
    progress.live_counts(spark, src, schema, sink, ckpt, files_per_trigger=FILES_PER_TRIGGER)
    return progress.latest_counts(spark, sink).select("run_id", "ok", "n")
