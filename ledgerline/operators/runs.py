"""Run operators: batches over completion order, progress, outcomes and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators.ranking import ordered_rank

ORDER = ("ts", "item")


def rank_by_outcome(done: DataFrame, run: str = "run_id", order: Sequence[str] = ORDER,
                    max_runs: int | None = None) -> DataFrame:
    """``_oseq``: position of each completion among the run's completions with the same outcome
    (successes and failures numbered separately) — one exact rank serves both lists."""
    return ordered_rank(done, order, [run, "ok"], rank_col="_oseq",
                        max_groups=None if max_runs is None else 2 * max_runs)


def assign_batches(done: DataFrame, batch_size: int = S.DEFAULT_BATCH_SIZE, run: str = "run_id",
                   order: Sequence[str] = ORDER, max_runs: int | None = None, seq_col: str | None = None) -> DataFrame:
    """Number the successful completions of each run in completion order and cut them into
    batches of ``batch_size``: ranks 1..B -> batch 1 and so on; the remainder is the last batch.
    ``seq_col`` names an existing per-run success rank (see ``rank_by_outcome``)."""
    ok = done.filter(F.col("ok"))
    if seq_col:
        ranked = ok.withColumnRenamed(seq_col, "seq")
    else:
        ranked = ordered_rank(ok, order, [run], rank_col="seq", max_groups=max_runs)
    return ranked.withColumn("batch_no", S.batch_of("seq", batch_size))


def progress(done: DataFrame, run: str = "run_id", order: Sequence[str] = ORDER,
             max_runs: int | None = None) -> DataFrame:
    """At each completion: done count, total, percent, elapsed since the run's first completion,
    average per company and ETA (microseconds, doubles)."""
    r = ordered_rank(done, order, [run], rank_col="n_done", size_col="n_total", first_col="run_start",
                     max_groups=max_runs)
    elapsed = F.timestamp_diff("MICROSECOND", F.col("run_start"), F.col(order[0]))
    return r.select(
        "*",
        (F.col("n_done") / F.col("n_total") * 100.0).alias("pct"),
        elapsed.alias("elapsed_us"),
        (elapsed / F.col("n_done")).alias("avg_us"),
        (elapsed / F.col("n_done") * (F.col("n_total") - F.col("n_done"))).alias("eta_us"),
    ).drop("run_start")


def run_summary(done: DataFrame, run: str = "run_id", ts: str = "ts") -> DataFrame:
    """Per run: total, successful and failed companies, duration and average per company."""
    dur = F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts))
    g = done.groupBy(run).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("ok")).alias("n_success"),
        F.count_if(~F.col("ok")).alias("n_failed"),
        dur.alias("duration_us"),
    )
    return g.withColumn("avg_us", F.col("duration_us") / F.col("n_total"))


def failed_lines(done: DataFrame, per_line: int = 100, run: str = "run_id", order: Sequence[str] = ORDER,
                 max_runs: int | None = None, seq_col: str | None = None) -> DataFrame:
    """Failed tickers of each run as comma-joined text lines of at most ``per_line`` names, in
    completion order. Each line's group is bounded by ``per_line`` rows, so no run's failures are
    gathered into one row. ``seq_col`` names an existing per-run failure rank."""
    failed = done.filter(~F.col("ok"))
    if seq_col:
        r = failed.withColumnRenamed(seq_col, "_fpos")
    else:
        r = ordered_rank(failed, order, [run], rank_col="_fpos", max_groups=max_runs)
    r = r.withColumn("line_no", S.batch_of("_fpos", per_line))
    g = r.groupBy(run, "line_no").agg(
        F.sort_array(F.collect_list(F.struct("_fpos", "ticker"))).alias("_l"),
        F.count(F.lit(1)).alias("n_tickers"))
    return g.select(run, "line_no", "n_tickers",
                    F.array_join(F.transform("_l", lambda x: x["ticker"]), ", ").alias("tickers"))


def archived_with(batches: DataFrame, run: str = "run_id", key: str = "ticker") -> DataFrame:
    """The batch that takes each company's data along: the first one that lists it. Its data leaves staging
    with that batch, so any later batch lists the company without data."""
    first = batches.groupBy(key).agg(F.min(F.struct(run, "batch_no")).alias("_first"))
    return first.select(key, F.col("_first")[run].alias(run), F.col("_first.batch_no").alias("batch_no"))


def batch_plan(done: DataFrame, batches: DataFrame, batch_size: int = S.DEFAULT_BATCH_SIZE,
               run: str = "run_id") -> DataFrame:
    """Expected full batches (S div B) and remainder (S mod B) next to the batches actually made:
    ``batches`` are the archives that are there, by run and batch number."""
    s = done.groupBy(run).agg(F.count_if(F.col("ok")).alias("n_success"))
    actual = batches.groupBy(run).agg(F.count_distinct("batch_no").alias("n_batches"))
    full = F.call_function("div", F.col("n_success"), F.lit(int(batch_size)))
    return s.join(actual, run, "left").select(
        run, "n_success",
        full.alias("full_batches"),
        (F.col("n_success") % batch_size).cast("bigint").alias("remainder"),
        (full + F.when(F.col("n_success") % batch_size > 0, 1).otherwise(0)).cast("bigint").alias("expected_batches"),
        F.coalesce("n_batches", F.lit(0)).cast("bigint").alias("n_batches"),
    )


def latest_outcome(done: DataFrame, key: str = "ticker", order: Sequence[str] = ORDER) -> DataFrame:
    """Last completion of each company (a hash aggregate; a hot key is combined map-side)."""
    return done.groupBy(key).agg(
        F.max_by(F.struct("ok", "run_id", *order), F.struct(*order)).alias("_last")
    ).select(key, F.col("_last.ok").alias("success"), F.col("_last.run_id").alias("run_id"))


def outcome(company: DataFrame, last: DataFrame) -> DataFrame:
    """Company list joined to outcomes: success, failed, missing ticker or not run."""
    j = company.join(last, "ticker", "left")
    status = (
        F.when(~S.has_ticker("ticker") | F.col("ticker").isNull(), "missing_ticker")
        .when(F.col("success").isNull(), "not_run")
        .when(F.col("success"), "success")
        .otherwise("failed")
    )
    return j.select("list_pos", "ticker", status.alias("status"), "run_id")


def latest_run(df: DataFrame, run: str = "run_id") -> DataFrame:
    """Rows of the latest run (greatest run name) — a scalar subquery, no join."""
    latest = df.select(F.max(run)).scalar()
    return df.filter(F.col(run) == latest)


def last_writer(members: DataFrame, member: str = "member", batch: str = "batch_no") -> DataFrame:
    """Member present in several batches: the later batch overwrites (max_by, map-side combine).
    Ties on the batch number fall to the remaining columns, so the winner is deterministic."""
    rest = [c for c in members.columns if c != member]
    tie = [c for c in rest if c != batch]
    g = members.groupBy(member).agg(F.max_by(F.struct(*rest), F.struct(batch, *tie)).alias("_w"))
    return g.select(member, *[F.col("_w")[c].alias(c) for c in rest])
