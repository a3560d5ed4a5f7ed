import datetime as dt
import os
import subprocess
import sys

from pyspark.sql import functions as F

from ledgerline.streaming import flush, ingest
from ledgerline.sources.landing import land_in_order

IDX = "k long, accession string, filed_at timestamp_ntz"


def test_ingest_skips_duplicates_and_held_and_keeps_late_rows(spark, tmp):
    d = dt.datetime(2024, 1, 1)
    day = lambda n: d + dt.timedelta(days=n)
    landings = [
        [(1, "A", day(10)), (2, "B", day(20))],
        [(3, "H", day(21)), (5, "N", day(30))],
        [(1, "A", day(10)),      # re-delivered
         (4, "L", day(1))],      # late, and new
    ]
    src = os.path.join(tmp, "src")
    for rows in landings:  # three arrivals, three micro-batches
        land_in_order(spark.createDataFrame(rows, IDX), src, ["filed_at", "k"], min_chunks=1)
    buckets = ingest.KeyBuckets(key=("k",), by=(), n=2)
    held = ingest.write_held(spark.createDataFrame([(3,)], "k long"), os.path.join(tmp, "held"), buckets)
    sink = os.path.join(tmp, "sink")
    schema = spark.createDataFrame(landings[0], IDX).schema
    ingest.ingest_new(spark, src, schema, held, sink, os.path.join(tmp, "ckpt"), buckets)
    got = sorted(r.accession for r in ingest.read_ingested(spark, sink, schema).collect())
    assert got == ["A", "B", "L", "N"]


def test_ingest_reads_only_the_buckets_that_a_micro_batch_touches(tmp):
    """Counted from the event log of a session of its own: see ``ingest_job.py``."""
    here = os.path.dirname(os.path.abspath(__file__))
    r = subprocess.run([sys.executable, os.path.join(here, "ingest_job.py"), tmp], capture_output=True, text=True, timeout=600)
    assert "BUCKETS-OK" in r.stdout, r.stdout[-2000:] + r.stderr[-4000:]


def test_ingest_of_nothing_new_and_null_bucket_values(spark, tmp):
    schema = spark.createDataFrame([], "accession string, filing_year long").schema
    src = os.path.join(tmp, "src")
    land_in_order(spark.createDataFrame([("A", None), ("A", None), ("B", 2001), ("C", None)], schema), src, ["accession"], 1)
    held = ingest.write_held(spark.createDataFrame([("B", 2001), ("C", None)], schema), os.path.join(tmp, "held"))
    sink = os.path.join(tmp, "sink")
    ingest.ingest_new(spark, src, schema, held, sink, os.path.join(tmp, "ckpt"))
    assert [tuple(r) for r in ingest.read_ingested(spark, sink, schema).collect()] == [("A", None)]
    none = os.path.join(tmp, "none")
    ingest.ingest_new(spark, src, schema, ingest.write_held(spark.createDataFrame([("A", None), ("B", 2001), ("C", None)], schema),
                                                            os.path.join(tmp, "all")), none, os.path.join(tmp, "ckpt2"))
    assert ingest.read_ingested(spark, none, schema).count() == 0


def _flush(spark, tmp, landings, batch_size=4):
    schema = "run_id string, item long, ticker string, ts timestamp_ntz, ok boolean, run_ended boolean"
    src, sink = os.path.join(tmp, "src"), os.path.join(tmp, "sink")
    for rows in landings:
        df = spark.createDataFrame(rows, schema)
        land_in_order(df, src, ["ts", "item"], min_chunks=1)
    flush.flush_batches(spark, src, df.schema, sink, os.path.join(tmp, "ckpt"), batch_size)
    return sink


def test_a_hot_run_spreads_over_tasks(spark, tmp):
    t = dt.datetime(2024, 1, 1)
    sink = _flush(spark, tmp, [[("r", i, f"T{i}", t + dt.timedelta(seconds=i), True, False) for i in range(400)]])
    parts = spark.read.parquet(os.path.join(sink, "members", "epoch=000000000")).groupBy(F.input_file_name()).count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 400
    assert sorted(r.seq for r in flush.read_flushed(spark, sink).collect()) == list(range(1, 401))
    assert flush.read_emitted(spark, sink).count() == 100


def test_the_open_batch_is_emitted_at_the_end_of_its_run_and_again_after_late_rows(spark, tmp):
    t = dt.datetime(2024, 1, 1)
    row = lambda run, i, ok=True, end=False: (run, i, f"T{i}", t + dt.timedelta(minutes=i), ok, end)
    first = [row("a", i) for i in range(6)] + [row("b", i, ok=i != 1) for i in range(4)] + [row("a", 50, False, True)]
    late = [row("a", 60), row("b", 61), row("b", 62, False, True)]
    sink = _flush(spark, tmp, [first])
    got = {(r.run_id, r.batch_no): (r.n_companies, r.closed_as) for r in flush.read_emitted(spark, sink).collect()}
    assert got == {("a", 1): (4, "full"), ("a", 2): (2, "remainder")}  # b has not ended: its 3 stay open
    sink = _flush(spark, tmp, [late, [row("a", 70, False, True)]])
    got = {(r.run_id, r.batch_no): (r.n_companies, r.closed_as) for r in flush.read_emitted(spark, sink).collect()}
    assert got == {("a", 1): (4, "full"), ("a", 2): (3, "remainder"), ("b", 1): (4, "full")}


def test_a_replayed_epoch_numbers_nothing_twice(spark, tmp):
    t = dt.datetime(2024, 1, 1)
    rows = [("r", i, f"T{i}", t + dt.timedelta(minutes=i), True, False) for i in range(10)]
    sink = _flush(spark, tmp, [rows[:5], rows[5:]])
    # forget that the last epoch was committed, as a driver that dies between writing and committing would
    os.remove(os.path.join(tmp, "ckpt", "commits", "1"))
    crc = os.path.join(tmp, "ckpt", "commits", ".1.crc")
    if os.path.exists(crc):
        os.remove(crc)
    _flush(spark, tmp, [rows[:0]])
    assert sorted((r.item, r.seq) for r in flush.read_flushed(spark, sink).collect()) == [(i, i + 1) for i in range(10)]


def test_flush_numbers_across_micro_batches_in_arrival_order(spark, tmp):
    t = dt.datetime(2024, 1, 1)
    rows = [("run_1", i, f"T{i}", t + dt.timedelta(minutes=i), i % 4 != 3) for i in range(40)]
    df = spark.createDataFrame(rows, "run_id string, item long, ticker string, ts timestamp_ntz, ok boolean")
    src = os.path.join(tmp, "src")
    n = land_in_order(df, src, ["ts", "item"], min_chunks=5)
    assert n >= 5
    sink = os.path.join(tmp, "sink")
    flush.flush_batches(spark, src, df.schema, sink, os.path.join(tmp, "ckpt"), batch_size=4)
    out = sorted((r.item, r.seq, r.batch_no, r.batch_closed) for r in flush.read_flushed(spark, sink).collect())
    oks = [i for i in range(40) if i % 4 != 3]
    assert [o[0] for o in out] == oks
    assert [o[1] for o in out] == list(range(1, len(oks) + 1))
    assert [o[2] for o in out] == [(s - 1) // 4 + 1 for s in range(1, len(oks) + 1)]
    assert sum(o[3] for o in out) == len(oks) // 4


def test_micro_batches_do_not_follow_every_few_rows(spark, tmp):
    """Every micro-batch costs the driver the same, so a slice of the replay is large; order and rows stay."""
    src = os.path.join(tmp, "src")
    assert land_in_order(spark.range(300_000), src, ["id"]) == 4
    files = sorted((os.path.getmtime(os.path.join(src, f)), f) for f in os.listdir(src) if f.startswith("part-"))
    ranges = [spark.read.parquet(os.path.join(src, f)).selectExpr("min(id) AS lo", "max(id) AS hi", "count(*) AS n").first() for _, f in files]
    assert sum(r.n for r in ranges) == 300_000 and all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))
    assert land_in_order(spark.range(3_500), os.path.join(tmp, "b"), ["id"], min_chunks=1, max_chunk_rows=1_000) == 4
