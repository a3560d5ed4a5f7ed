"""Run queries: batches, progress, outcomes, summaries, status and doc-only reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import incremental, ranking, runs
from ledgerline.plans.registry import query
from ledgerline.session import scratch_dir
from ledgerline.sources import fixtures as X

B = X.BATCH_SIZE

_BATCHES_SQL = """
, batches AS (
  SELECT run_id, item, ticker, ts, CAST(rn AS BIGINT) AS seq, CAST((rn - 1) // 12 + 1 AS BIGINT) AS batch_no
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, item) AS rn FROM completion WHERE ok)
)
"""


def batches(spark, d):
    return runs.assign_batches(X.completion(spark, d), B)


@query("win_batch_assign", _BATCHES_SQL + "SELECT run_id, item, ticker, seq, batch_no FROM batches")
def win_batch_assign(spark, d):
    """Successful completions numbered per run in completion order, cut into batches of 12."""
    return batches(spark, d).select("run_id", "item", "ticker", "seq", "batch_no")


@query("win_progress", """
SELECT run_id, item, n_done, n_total, n_done / n_total * 100.0 AS pct, elapsed_us,
       elapsed_us / n_done AS avg_us, elapsed_us / n_done * (n_total - n_done) AS eta_us
FROM (SELECT run_id, item,
             CAST(row_number() OVER (PARTITION BY run_id ORDER BY ts, item) AS BIGINT) AS n_done,
             CAST(count(*) OVER (PARTITION BY run_id) AS BIGINT) AS n_total,
             CAST(date_diff('microsecond', min(ts) OVER (PARTITION BY run_id), ts) AS BIGINT) AS elapsed_us
      FROM completion)
""")
def win_progress(spark, d):
    p = runs.progress(X.completion(spark, d))
    return p.select("run_id", "item", "n_done", "n_total", "pct", "elapsed_us", "avg_us", "eta_us")


@query("win_position", """
SELECT list_pos, ticker, CAST(row_number() OVER (ORDER BY list_pos) AS BIGINT) AS pos,
       CAST(count(*) OVER () AS BIGINT) AS total
FROM company
""")
def win_position(spark, d):
    """Position i/total of each company in list order (exact global rank, no single partition)."""
    r = ranking.ordered_rank(X.company(spark, d), ["list_pos"], rank_col="pos", size_col="total")
    return r.select("list_pos", "ticker", "pos", "total")


@query("win_latest_run", """
SELECT item, ticker, run_id, ok FROM completion WHERE run_id = (SELECT max(run_id) FROM completion)
""")
def win_latest_run(spark, d):
    return runs.latest_run(X.completion(spark, d)).select("item", "ticker", "run_id", "ok")


_MANIFEST_SQL = """
, manifest AS (
  SELECT rel_path AS member, CAST(CAST(substr(ticker, 2) AS BIGINT) // 12 + 1 AS BIGINT) AS batch_no,
         'staged' AS source, size FROM files
  UNION ALL
  SELECT a.ticker || '/' || CAST(a.filing_year AS VARCHAR) || '/' || replace(a.form, '/', '%2F') || '/' || a.accession || '.html',
         CAST(a.k // 1000 + 1 AS BIGINT), 'archived', a.body_bytes FROM archived a
)
"""


def manifest(spark, d):
    """Copies of filings in numbered batches: staged copies batched by company, archived copies
    by filing key; filings in both appear in two batches."""
    idx = X.filing_index(spark, d)
    f = X.files(spark, d, idx)
    a = X.archived(spark, d, idx)
    staged_copies = f.select(
        F.col("rel_path").alias("member"),
        F.expr("CAST(substring(ticker, 2) AS BIGINT) div 12 + 1").alias("batch_no"),
        F.lit("staged").alias("source"), "size")
    archived_copies = a.select(
        S.rel_path("ticker", "filing_year", "form", "accession").alias("member"),
        (F.floor(F.col("k") / 1000) + 1).cast("bigint").alias("batch_no"),
        F.lit("archived").alias("source"), F.col("body_bytes").alias("size"))
    return staged_copies.unionByName(archived_copies)


@query("win_last_writer", _MANIFEST_SQL + """
SELECT member, batch_no, source, size FROM (
  SELECT *, row_number() OVER (PARTITION BY member ORDER BY batch_no DESC, source DESC, size DESC) AS rn FROM manifest)
WHERE rn = 1
""")
def win_last_writer(spark, d):
    """A member in several batches: the later batch overwrites it."""
    return runs.last_writer(manifest(spark, d)).select("member", "batch_no", "source", "size")


@query("agg_run_summary", """
SELECT run_id, CAST(count(*) AS BIGINT) AS n_total, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS n_success,
       CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS n_failed,
       CAST(date_diff('microsecond', min(ts), max(ts)) AS BIGINT) AS duration_us,
       date_diff('microsecond', min(ts), max(ts)) / count(*) AS avg_us
FROM completion GROUP BY run_id
""")
def agg_run_summary(spark, d):
    return runs.run_summary(X.completion(spark, d))


@query("agg_failed_list", """
SELECT run_id, CAST((rn - 1) // 100 + 1 AS BIGINT) AS line_no, CAST(count(*) AS BIGINT) AS n_tickers,
       string_agg(ticker, ', ' ORDER BY rn) AS tickers
FROM (SELECT run_id, ticker, row_number() OVER (PARTITION BY run_id ORDER BY ts, item) AS rn
      FROM completion WHERE NOT ok)
GROUP BY run_id, (rn - 1) // 100 + 1
""")
def agg_failed_list(spark, d):
    """Comma-joined failed tickers per run, in lines of at most 100 names."""
    return runs.failed_lines(X.completion(spark, d))


@query("join_outcome", """
SELECT c.list_pos, c.ticker,
       CASE WHEN c.ticker IS NULL OR length(c.ticker) = 0 THEN 'missing_ticker' WHEN o.ok IS NULL THEN 'not_run'
            WHEN o.ok THEN 'success' ELSE 'failed' END AS status,
       o.run_id
FROM company c LEFT JOIN (
  SELECT ticker, ok, run_id FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts DESC, item DESC) AS rn FROM completion)
  WHERE rn = 1) o ON o.ticker = c.ticker
""")
def join_outcome(spark, d):
    """Each listed company with its latest outcome: success, failed, missing ticker or not run."""
    return runs.outcome(X.company(spark, d), runs.latest_outcome(X.completion(spark, d)))


@query("join_batch_present", _BATCHES_SQL + """
SELECT b.run_id, b.batch_no, b.item, b.ticker, s.ticker IS NOT NULL AS present
FROM batches b LEFT JOIN (SELECT DISTINCT ticker FROM staged) s ON s.ticker = b.ticker
""")
def join_batch_present(spark, d):
    """Batch members flagged by whether the company has staged data (absent ones are omitted
    from the archive but still counted in the batch)."""
    have = X.staged(spark, d).select("ticker").distinct().withColumn("present", F.lit(True))
    b = batches(spark, d).select("run_id", "batch_no", "item", "ticker")
    j = b.join(have, "ticker", "left")
    return j.select("run_id", "batch_no", "item", "ticker", F.coalesce("present", F.lit(False)).alias("present"))


@query("set_held_union", "SELECT accession FROM staged UNION SELECT accession FROM archived")
def set_held_union(spark, d):
    idx = X.filing_index(spark, d)
    return incremental.held_union(X.staged(spark, d, idx), X.archived(spark, d, idx), ["accession"])


@query("set_not_succeeded", """
SELECT list_pos, ticker FROM listed l
WHERE NOT EXISTS (SELECT 1 FROM completion c WHERE c.ok AND c.ticker = l.ticker)
""")
def set_not_succeeded(spark, d):
    """Listed companies without any successful completion (listed minus succeeded)."""
    from ledgerline.operators.worklist import usable_companies

    ok = X.completion(spark, d).filter(F.col("ok")).select("ticker")
    return incremental.not_succeeded(usable_companies(X.company(spark, d)), ok, ["ticker"]).select("list_pos", "ticker")


@query("agg_status", """
SELECT CAST(count(DISTINCT ticker) AS BIGINT) AS n_companies, CAST(count(*) AS BIGINT) AS n_files,
       CAST(sum(size) AS BIGINT) AS total_bytes
FROM files
""")
def agg_status(spark, d):
    """Companies with data, file count and total size (bytes) of the staged tree."""
    f = X.files(spark, d)
    return f.agg(F.count_distinct("ticker").alias("n_companies"), F.count(F.lit(1)).alias("n_files"),
                 F.sum("size").cast("bigint").alias("total_bytes"))


@query("top_recent", """
SELECT rel_path, strftime(mtime, '%Y-%m-%d %H:%M:%S') AS mtime_text, size FROM files
ORDER BY mtime DESC, rel_path LIMIT 10
""")
def top_recent(spark, d):
    """The 10 most recently modified files (top-k, no global sort)."""
    f = X.files(spark, d)
    top = f.orderBy(F.col("mtime").desc(), F.col("rel_path").asc()).limit(10)
    return top.select("rel_path", F.date_format("mtime", "yyyy-MM-dd HH:mm:ss").alias("mtime_text"), "size")


@query("snk_staged_cleanup", """
SELECT accession, ticker, form, filing_year FROM staged s
WHERE NOT EXISTS (SELECT 1 FROM completion c WHERE c.ok AND c.ticker = s.ticker)
""")
def snk_staged_cleanup(spark, d):
    """Archived companies leave staging: their rows get tombstones, and years of which more than half is dead are
    rewritten; then the table is read back."""
    from ledgerline.sinks.staging import Staging

    st = X.staged(spark, d).select("accession", "ticker", "form", "filing_year")
    staging = Staging(scratch_dir(spark, "staged"), st.schema)
    staging.add(st)
    staging.remove(X.completion(spark, d).filter(F.col("ok")).select("ticker"))
    staging.compact(spark, threshold=0.5)
    return staging.read(spark)


@query("flt_log_retention", """
SELECT run_id, age_days FROM (
  SELECT run_id, CAST(date_diff('microsecond', max(ts), (SELECT max(ts) FROM completion)) // 86400000000 AS BIGINT) AS age_days
  FROM completion GROUP BY run_id)
WHERE age_days > 7
""")
def flt_log_retention(spark, d):
    """Run logs (last written at the run's last event) older than 7 whole days at the time of the
    newest event ('-mtime +7' semantics: age in whole days greater than 7)."""
    from ledgerline.operators.runlog import retention

    c = X.completion(spark, d)
    logs = c.groupBy("run_id").agg(F.max("ts").alias("mtime"))
    return retention(logs, c.select(F.max("ts")).scalar(), 7).select("run_id", "age_days")


@query("lim_sample", """
SELECT list_pos, ticker FROM listed ORDER BY md5(ticker) LIMIT 10
""")
def lim_sample(spark, d):
    """Sample mode: N companies picked by a stable hash order (reproducible, unlike sample())."""
    from ledgerline.operators.worklist import usable_companies

    c = usable_companies(X.company(spark, d))
    return c.orderBy(F.md5("ticker")).limit(10).select("list_pos", "ticker")


@query("flt_html_only", """
SELECT name FROM (
  SELECT CASE k % 4 WHEN 0 THEN rel_path WHEN 1 THEN replace(rel_path, '.html', '.HTM')
                    WHEN 2 THEN replace(rel_path, '.html', '.txt') ELSE rel_path || '.bak' END AS name FROM files)
WHERE regexp_matches(lower(name), '\\.html?$')
""")
def flt_html_only(spark, d):
    """Keep HTML/HTM names only (names of mixed kinds derived from the staged paths)."""
    f = X.files(spark, d)
    r = F.col("k") % 4
    name = (F.when(r == 0, F.col("rel_path"))
            .when(r == 1, F.replace("rel_path", F.lit(".html"), F.lit(".HTM")))
            .when(r == 2, F.replace("rel_path", F.lit(".html"), F.lit(".txt")))
            .otherwise(F.concat("rel_path", F.lit(".bak"))))
    return f.select(name.alias("name")).filter(S.is_html_path("name"))


@query("flt_month_range", """
SELECT accession, filing_date FROM filing_index
WHERE filing_date >= make_date(1999, 4, 1) AND filing_date < make_date(2000, 9, 1)
""")
def flt_month_range(spark, d):
    """Start year/month to end year/month (inclusive); the end is optional."""
    from ledgerline.operators.worklist import filter_month_range

    return filter_month_range(X.filing_index(spark, d), (1999, 4), (2000, 8)).select("accession", "filing_date")


@query("prj_year_month", "SELECT accession, strftime(filing_date, '%Y_%m') AS year_month FROM filing_index")
def prj_year_month(spark, d):
    return X.filing_index(spark, d).select("accession", S.year_month("filing_date").alias("year_month"))


@query("agg_monthly", """
SELECT strftime(filing_date, '%Y_%m') AS year_month, CAST(count(*) AS BIGINT) AS n_filings
FROM staged GROUP BY 1
""")
def agg_monthly(spark, d):
    st = X.staged(spark, d)
    return st.groupBy(S.year_month("filing_date").alias("year_month")).agg(F.count(F.lit(1)).alias("n_filings"))


@query("agg_annual", """
SELECT filing_year, CAST(count(*) AS BIGINT) AS n_filings, CAST(count(DISTINCT ticker) AS BIGINT) AS n_companies,
       CAST(sum(body_bytes) AS BIGINT) AS total_bytes
FROM staged GROUP BY filing_year
""")
def agg_annual(spark, d):
    st = X.staged(spark, d)
    return st.groupBy("filing_year").agg(
        F.count(F.lit(1)).alias("n_filings"), F.count_distinct("ticker").alias("n_companies"),
        F.sum("body_bytes").cast("bigint").alias("total_bytes"))


_PARAM_KEYS = ["run_id", "mode", "batch_size", "forms", "years", "companies"]


@query("snk_run_params", """
SELECT run_id, p.key AS param, p.value
FROM (SELECT run_id, CAST(count(*) AS VARCHAR) AS companies FROM completion GROUP BY run_id) r,
     LATERAL (SELECT unnest(['run_id', 'mode', 'batch_size', 'forms', 'years', 'companies']) AS key,
                     unnest([r.run_id, 'custom', '12', '10-K,10-Q', '1999-2001', r.companies]) AS value) p
""")
def snk_run_params(spark, d):
    """Keep each run's parameters: one map row per run appended to a parameters table, read back as
    (run_id, param, value)."""
    from ledgerline.sinks.snapshots import append_rows

    runs_df = X.completion(spark, d).groupBy("run_id").agg(F.count(F.lit(1)).cast("string").alias("companies"))
    values = [F.col("run_id"), F.lit("custom"), F.lit(str(B)), F.lit(",".join(X.FORMS)),
              F.lit(f"{X.year_range()[0]}-{X.year_range()[1]}"), F.col("companies")]
    params = runs_df.select("run_id", F.map_from_arrays(F.array(*[F.lit(k) for k in _PARAM_KEYS]),
                                                        F.array(*values)).alias("params"))
    back = append_rows(params, scratch_dir(spark, "run-params"))
    return back.select("run_id", F.explode("params").alias("param", "value"))
