"""Progress-log rendering: run events as the reference's text lines, written per run.

Lines are produced by joins and aggregations over the completion table (no driver loop). A run's
lines go to ``<root>/run_id=<run>/part-*``: the rows are range-partitioned by (run, time, line),
so a large run is split over several ordered part files rather than one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import runs
from ledgerline.session import partitions_for_size

# Fixed line formats of the reference's progress log.
RULE = "=" * 80
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
FAILED_PER_LINE = 100
LINES_PER_TASK = 1_000_000
# Places of lines that belong to no single completion, among lines of one instant.
FIRST, REMAINDER, LAST = -1, (1 << 62), (1 << 62) + 1


def _ts(c):
    return F.date_format(c, TS_FORMAT)


def _line(run, ts, order, text):
    return F.struct(run.alias("run_id"), ts.alias("ts"), F.lit(order).cast("int").alias("ord"), text.alias("value"))


def render(done: DataFrame, batch_size: int = S.DEFAULT_BATCH_SIZE, run_dir_prefix: str = "runs/",
           sizes: DataFrame | None = None, filings: DataFrame | None = None, workers: int = 1,
           raised: str | None = None, lost: DataFrame | None = None) -> DataFrame:
    """(run_id, ts, seq, ord, value) text lines of each run's progress log, in that order.

    ``raised`` names a column of ``done`` with the message of the exception that ended a failed company, null
    where the worker reported the failure itself. ``lost`` (run_id, batch_no, error) are batches whose archive
    could not be written: an error line stands in place of their record. Of a worker, the line that ends a
    company is written, not the one that starts it: completions do not tell when that was.

    ``sizes`` (ticker, bytes) gives the archive size shown for each batch (the bytes of its
    companies' data), ``filings`` (ticker, n_filings) the number shown for each success. The lines of
    a batch stand before the completion line of the success that closes it.
    """
    prog = runs.progress(done)                                   # n_done / n_total per completion
    by_outcome = runs.rank_by_outcome(done)                      # success / failure positions
    ok = runs.assign_batches(by_outcome, batch_size, seq_col="_oseq")
    if filings is not None:
        prog = prog.join(filings.select("ticker", F.col("n_filings").alias("_filings")), "ticker", "left")
    else:
        prog = prog.withColumn("_filings", F.lit(None).cast("bigint"))
    count = F.coalesce("_filings", F.lit(0)).cast("string")
    mark = F.when(F.col("ok"), F.lit("\u2713")).otherwise(F.lit("\u2717"))
    error = F.col(raised) if raised else F.lit(None).cast("string")
    thrown = ~F.col("ok") & error.isNotNull()
    msg = F.when(F.col("ok"), F.concat(F.lit("Downloaded "), count, F.lit(" filings"))).when(thrown, error).otherwise(
        F.concat(F.lit("Error processing "), F.col("ticker"), F.lit(": failed")))
    stamp = F.concat(F.lit("["), _ts("ts"), F.lit("] "))
    ended = F.concat(stamp, F.when(thrown, F.lit("Exception ")).otherwise(F.lit("Completed ")), F.col("n_done").cast("string"),
                     F.lit("/"), F.col("n_total").cast("string"), F.lit(": "), mark, F.lit(" "), F.col("ticker"), F.lit(" - "), msg)
    worker = F.concat(stamp, F.lit("[Worker "), (F.pmod("item", F.lit(workers)) + 1).cast("string"), F.lit("] "),
                      F.when(F.col("ok"), F.concat(F.lit("Completed "), F.col("ticker"), F.lit(": "), msg)).otherwise(msg))
    at_item = [_line(F.col("run_id"), F.col("ts"), 1, worker), _line(F.col("run_id"), F.col("ts"), 10, ended)]
    per_event = prog.select(F.col("item").alias("seq"), F.explode(
        F.when(thrown, F.array(at_item[1])).otherwise(F.array(*at_item))).alias("l"))

    summary = runs.run_summary(done).join(
        done.groupBy("run_id").agg(F.min("ts").alias("start"), F.max("ts").alias("end")), "run_id")
    # batches: closed when their last success is in; bounded by batch_size names each
    if sizes is not None:
        ok = ok.join(sizes.select("ticker", F.col("bytes").alias("_bytes")), "ticker", "left")
    else:
        ok = ok.withColumn("_bytes", F.lit(0).cast("bigint"))
    bt = ok.groupBy("run_id", "batch_no").agg(
        F.max("ts").alias("ts"), F.max_by("item", F.struct("ts", "item")).alias("item"),
        F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("_bytes"),
        F.sort_array(F.collect_list(F.struct("seq", "ticker"))).alias("_t"))
    bt = bt.join(summary.select("run_id", "n_success", "end"), "run_id")
    full = F.col("n") == batch_size
    names = F.array_join(F.transform("_t", lambda x: x["ticker"]), ", ")
    path = F.concat(F.lit(run_dir_prefix), F.col("run_id"), F.lit("/" + S.ARCHIVE_PREFIX), F.col("batch_no").cast("string"), F.lit(".tar"))
    size = F.format_string("%.1f", S.size_mb(F.coalesce(F.col("_bytes"), F.lit(0))))
    head = F.concat(F.lit("["), _ts(F.when(full, F.col("ts")).otherwise(F.col("end"))), F.lit("] "),
                    F.when(full, F.lit("ARCHIVED: ")).otherwise(F.lit("FINAL BATCH (REMAINDER): ")),
                    F.lit("Batch "), F.col("batch_no").cast("string"), F.lit(" with "), F.col("n").cast("string"),
                    F.lit(" companies ("), size, F.lit("MB)"))
    bts = F.when(full, F.col("ts")).otherwise(F.col("end"))
    note = F.concat(F.lit("  Note: This is the remainder batch ("), F.col("n_success").cast("string"),
                    F.lit(f" % {batch_size} = "), (F.col("n_success") % batch_size).cast("string"), F.lit(" companies)"))
    lines = [_line(F.col("run_id"), bts, 3, head),
             _line(F.col("run_id"), bts, 4, F.concat(F.lit("  Archive: "), path)),
             _line(F.col("run_id"), bts, 5, F.concat(F.lit("  Companies: "), names))]
    place = F.when(full, F.col("item")).otherwise(F.lit(REMAINDER))
    if lost is not None:
        bt = bt.join(lost.select("run_id", "batch_no", F.col("error").alias("_error")), ["run_id", "batch_no"], "left")
    else:
        bt = bt.withColumn("_error", F.lit(None).cast("string"))
    failed = _line(F.col("run_id"), bts, 3, F.concat(
        F.lit("["), _ts(bts), F.lit("] "), F.when(full, F.lit("ARCHIVE ERROR: ")).otherwise(F.lit("FINAL BATCH ERROR: ")),
        F.col("_error")))
    per_batch = bt.select(place.alias("seq"), F.explode(
        F.when(F.col("_error").isNotNull(), F.array(failed)).when(full, F.array(*lines))
        .otherwise(F.array(*lines, _line(F.col("run_id"), bts, 6, note)))).alias("l"))

    nb = ok.groupBy("run_id").agg(F.max("batch_no").alias("nb"))
    s = summary.join(nb, "run_id", "left")
    txt = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    head_lines = [
        txt("Download Progress Log - ", _ts("start")), txt("Total companies: ", F.col("n_total").cast("string")),
        txt(f"Workers: {workers}"), F.lit(RULE), F.lit(""),
    ]
    tail_lines = [
        F.lit(""), F.lit(RULE), txt("Download Summary - ", _ts("end")), txt("Total companies: ", F.col("n_total").cast("string")),
        txt("Successful: ", F.col("n_success").cast("string")), txt("Failed: ", F.col("n_failed").cast("string")),
        txt("Batches created: ", F.coalesce(F.col("nb"), F.lit(0)).cast("string")),
        txt("Archive directory: ", F.lit(run_dir_prefix), F.col("run_id")),
    ]
    opening = s.select(F.lit(FIRST).cast("bigint").alias("seq"), F.explode(F.array(
        *[_line(F.col("run_id"), F.col("start"), i, v) for i, v in enumerate(head_lines)])).alias("l"))
    closing = s.select(F.lit(LAST).cast("bigint").alias("seq"), F.explode(F.array(
        *[_line(F.col("run_id"), F.col("end"), 100 + i, v) for i, v in enumerate(tail_lines)])).alias("l"))
    fl = runs.failed_lines(by_outcome, FAILED_PER_LINE, seq_col="_oseq").join(summary.select("run_id", "end"), "run_id")
    per_fail = fl.select((F.lit(LAST) + F.col("line_no")).alias("seq"), _line(F.col("run_id"), F.col("end"), 200,
                                                              F.concat(F.lit("Failed companies: "), F.col("tickers"))).alias("l"))
    allx = per_event.unionByName(per_batch).unionByName(opening).unionByName(closing).unionByName(per_fail)
    return allx.select("l.run_id", "l.ts", "l.ord", "seq", "l.value")


def write_log(lines: DataFrame, root: str, expected: int | None = None) -> None:
    """Append the lines under ``root/run_id=<run>/``, ordered by (time, sequence, line kind). Tasks are sized by
    the ``expected`` number of lines (counted if not given)."""
    n = partitions_for_size(lines.sparkSession, lines.count() if expected is None else expected, LINES_PER_TASK)
    (lines.repartitionByRange(n, "run_id", "ts", "seq", "ord")
     .sortWithinPartitions("run_id", "ts", "seq", "ord")
     .select("run_id", "value").write.mode("append").partitionBy("run_id").text(root))
