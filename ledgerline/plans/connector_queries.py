"""Connector round trips: JSON company lists, HTML tables and progress logs written by Spark,
read back and compared with SQL over the base tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import runs
from ledgerline.operators.companies import WEB_COLUMNS
from ledgerline.plans.registry import query
from ledgerline.session import scratch_dir
from ledgerline.sinks import company_json, runlog
from ledgerline.sinks.archives import write_tree
from ledgerline.sources import company_json as cj
from ledgerline.sources import fixtures as X
from ledgerline.sources import html_tables
from ledgerline.sources import runlog as runlog_source
from ledgerline.sources.runlog import read_log
from ledgerline.functions import scalars as S

_COMPANY_SQL = """
SELECT ticker, company_name, CASE WHEN length(cik) >= 10 THEN cik ELSE lpad(cik, 10, '0') END AS cik FROM company
"""


@query("snk_company_json", _COMPANY_SQL)
def snk_company_json(spark, d):
    """Write the company list as JSON records and read it back."""
    path = scratch_dir(spark, "company-lines")
    company_json.write_company_lines(X.company(spark, d), path)
    return cj.read_company_list(spark, path, multiline=False)


@query("src_company_json", _COMPANY_SQL)
def src_company_json(spark, d):
    """Read the company list in the reference's shape (JSON arrays of records), FAILFAST."""
    path = scratch_dir(spark, "company-arrays")
    company_json.write_company_arrays(X.company(spark, d), path)
    return cj.read_company_list(spark, path, multiline=True)


@query("src_company_validate", """
, rec AS (
  SELECT (row_number() OVER (ORDER BY list_pos) - 1) // 100 AS file_no, list_pos, ticker,
         '{' || CASE WHEN ticker IS NULL THEN '' ELSE '"Ticker":"' || ticker || '",' END
             || CASE WHEN company_name IS NULL THEN '' ELSE '"Company Name":"' || company_name || '",' END
             || '"CIK":"' || CASE WHEN length(cik) >= 10 THEN cik ELSE lpad(cik, 10, '0') END || '"}' AS txt
  FROM company
), f AS (
  SELECT file_no, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE ticker IS NULL) AS BIGINT) AS missing,
         CAST(sum(length(txt)) AS BIGINT) AS chars, CAST(length(arg_max(txt, list_pos)) AS BIGINT) AS last_chars,
         arg_min(coalesce(ticker, ''), list_pos) = '' AS first_missing
  FROM rec GROUP BY file_no
)
SELECT kind || '_' || CAST(file_no AS VARCHAR) || '.json' AS name, outcome, n_records, n_missing_ticker,
       CAST(CASE WHEN outcome = 'malformed' THEN 1 ELSE 0 END AS BIGINT) AS n_corrupt, outcome = 'valid' AS valid,
       error_line, error_column, error_offset
FROM (
  SELECT file_no, 'list' AS kind, 'valid' AS outcome, n AS n_records, missing AS n_missing_ticker, NULL::BIGINT AS error_line,
         NULL::BIGINT AS error_column, NULL::BIGINT AS error_offset FROM f
  UNION ALL SELECT file_no, 'cut', 'malformed', 0, 0, n + 1, last_chars + 1, chars + 2 * n FROM f
  UNION ALL SELECT file_no, 'zero', 'malformed', 0, 0, 1, 1, 0 FROM f
  UNION ALL SELECT file_no, 'empty', 'empty', 0, 0, NULL, NULL, NULL FROM f
  UNION ALL SELECT file_no, 'object', 'single_object', 1, CAST(first_missing AS BIGINT), NULL, NULL, NULL FROM f)
""")
def src_company_validate(spark, d):
    """Company-list files of every kind, each list also cut before its end, without a byte, without a record, and
    as its first record alone: one outcome a file, and where a malformed one stops being JSON."""
    root = scratch_dir(spark, "company-validate")
    texts = company_json.company_arrays(X.company(spark, d), per_file=100)
    whole = F.col("value")
    first = F.regexp_replace(F.split(whole, "\n")[1], ",$", "")
    kinds = [("list", whole), ("cut", F.expr("substring(value, 1, length(value) - 2)")), ("zero", F.lit("")), ("empty", F.lit("[]")),
             ("object", first)]
    files = texts.select("file_no", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), t.alias("content")) for k, t in kinds))).alias("f"))
    member = F.concat(F.col("f.kind"), F.lit("_"), F.col("file_no").cast("string"), F.lit(".json"))
    write_tree(files.select(member.alias("member"), F.col("f.content").alias("content")), root, mtime=None)
    v = cj.validate_company_list(spark, root)
    return v.select(F.element_at(F.split("file_path", "/"), -1).alias("name"), "outcome", "n_records", "n_missing_ticker", "n_corrupt",
                    "valid", "error_line", "error_column", "error_offset")


@query("src_html_table", _COMPANY_SQL)
def src_html_table(spark, d):
    """The company list rendered as web pages (50 rows per table, extra columns, entities, a
    second table to skip), stored, then parsed back: first table, three columns, CIK padded."""
    c = X.company(spark, d).select(
        "*", F.floor(F.col("list_pos") / 50).cast("bigint").alias("page_no"),
        F.concat(F.lit("Sector & <"), (F.col("list_pos") % 11).cast("string"), F.lit(">")).alias("sector"))
    cols = [("Symbol", "ticker"), ("Security", "company_name"), ("GICS Sector", "sector"), ("CIK", "list_pos")]
    pages = html_tables.render_tables(c, cols, "page_no", "list_pos")
    path = scratch_dir(spark, "pages")
    pages.write.parquet(path)
    cells = html_tables.table_cells(spark.read.parquet(path))
    t = html_tables.first_table(cells, dict(WEB_COLUMNS))
    return t.select("ticker", "company_name", S.cik_pad("cik").alias("cik"))


# Fixture of the logs: every third failed company raised an exception, and the archives of every fifth batch
# could not be written.
RAISED_EVERY, LOST_EVERY, WORKERS = 3, 5, 4

_LOG_SQL = """
, ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY run_id ORDER BY ts, item) AS BIGINT) AS n_done,
         CAST(count(*) OVER (PARTITION BY run_id) AS BIGINT) AS n_total, NOT ok AND item % 3 = 0 AS raised
  FROM completion
), members AS (
  SELECT run_id, ticker, ts, seq, CAST((seq - 1) // 12 + 1 AS BIGINT) AS batch_no
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, item) AS seq FROM completion WHERE ok)
), run AS (
  SELECT run_id, min(ts) AS first_ts, max(ts) AS last_ts, CAST(count(*) AS BIGINT) AS n_total,
         CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS n_success, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS n_failed
  FROM completion GROUP BY run_id
), batch AS (
  SELECT m.run_id, m.batch_no, count(*) AS n, count(*) < 12 AS remainder, m.batch_no % 5 = 0 AS lost,
         string_agg(m.ticker, ', ' ORDER BY m.seq) AS companies,
         strftime(CASE WHEN count(*) < 12 THEN max(r.last_ts) ELSE max(m.ts) END, '%Y-%m-%d %H:%M:%S') AS ts_text,
         max(r.n_success) AS n_success
  FROM members m JOIN run r ON r.run_id = m.run_id GROUP BY m.run_id, m.batch_no
)
"""


def _written_logs(spark, d) -> str:
    """The logs of all runs: each company's staged bytes are its share of an archive, its staged filings what a
    success reports."""
    per_company = X.files(spark, d).groupBy("ticker").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_filings"))
    done = X.completion(spark, d)
    raised = F.when(~F.col("ok") & (F.col("item") % RAISED_EVERY == 0), F.concat(F.lit("worker died at "), F.col("item").cast("string")))
    batches = runs.assign_batches(done).select("run_id", "batch_no").distinct().filter(F.col("batch_no") % LOST_EVERY == 0)
    lost = batches.withColumn("error", F.concat(F.lit("no space for batch "), F.col("batch_no").cast("string")))
    lines = runlog.render(done.withColumn("raised", raised), sizes=per_company, filings=per_company, workers=WORKERS,
                          raised="raised", lost=lost)
    root = scratch_dir(spark, "logs")
    runlog.write_log(lines, root, expected=3 * done.count())
    return root


@query("snk_progress_log", _LOG_SQL + """
SELECT run_id, kind, CAST(n AS BIGINT) AS n_lines FROM (
  SELECT run_id, 'header' AS kind, 1 AS n FROM run UNION ALL SELECT run_id, 'summary', 1 FROM run
  UNION ALL SELECT run_id, 'rule', 4 FROM run
  UNION ALL SELECT run_id, 'field', 7 + (n_failed + 99) // 100 FROM run
  UNION ALL SELECT run_id, CASE WHEN raised THEN 'exception' ELSE 'completed' END, count(*) FROM ranked GROUP BY ALL
  UNION ALL SELECT run_id, 'worker', count(*) FROM ranked WHERE NOT raised GROUP BY ALL
  UNION ALL SELECT run_id, CASE WHEN lost THEN CASE WHEN remainder THEN 'final_batch_error' ELSE 'archive_error' END
                                WHEN remainder THEN 'final_batch' ELSE 'archived' END, count(*) FROM batch GROUP BY ALL
  UNION ALL SELECT run_id, 'detail', sum(CASE WHEN remainder THEN 3 ELSE 2 END) FROM batch WHERE NOT lost GROUP BY ALL)
""")
def snk_progress_log(spark, d):
    """Write every run's progress log (header, worker, completion and exception lines, the records of archived batches
    and of the remainder, archive errors, summary, failed list); the lines read back are counted by their kind."""
    p = read_log(spark, _written_logs(spark, d))
    return p.groupBy("run_id", "kind").agg(F.count(F.lit(1)).alias("n_lines"))


@query("src_progress_log", _LOG_SQL + """
SELECT run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, n_done, n_total, ok, ticker,
       CASE WHEN raised THEN 'exception' ELSE 'completed' END AS kind
FROM ranked
""")
def src_progress_log(spark, d):
    """Parse progress logs back into completion events (written as for ``snk_progress_log``)."""
    p = read_log(spark, _written_logs(spark, d)).filter(F.col("kind").isin("completed", "exception"))
    return p.select("run_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"), "n_done", "n_total",
                    (F.col("mark") == "✓").alias("ok"), "ticker", "kind")


@query("src_log_batches", _LOG_SQL + """
SELECT run_id, batch_no, ts_text, remainder, CAST(n AS BIGINT) AS n_companies, companies,
       'runs/' || run_id || '/sp500_filings_data_' || CAST(batch_no AS VARCHAR) || '.tar' AS archive,
       CASE WHEN remainder THEN 'This is the remainder batch (' || CAST(n_success AS VARCHAR) || ' % 12 = '
                                || CAST(n_success % 12 AS VARCHAR) || ' companies)' END AS note
FROM batch WHERE NOT lost
""")
def src_log_batches(spark, d):
    """The archived batches that the logs tell of, each put together from its three or four lines."""
    b = runlog_source.log_batches(runlog_source.records(read_log(spark, _written_logs(spark, d))))
    return b.select("run_id", "batch_no", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"), "remainder", "n_companies",
                    F.array_join("companies", ", ").alias("companies"), "archive", "note")


@query("src_log_summary", _LOG_SQL + """
SELECT r.run_id, strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS started_text, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS ended_text,
       n_total AS n_listed, CAST(4 AS BIGINT) AS workers, n_total, n_success, n_failed,
       CAST((n_success + 11) // 12 AS BIGINT) AS n_batches, 'runs/' || r.run_id AS archive_dir, n_failed AS n_failed_listed
FROM run r
""")
def src_log_summary(spark, d):
    """Each run's log head and summary as fields."""
    s = runlog_source.log_summaries(runlog_source.records(read_log(spark, _written_logs(spark, d))))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return s.select("run_id", text("started_at").alias("started_text"), text("ended_at").alias("ended_text"), "n_listed", "workers",
                    "n_total", "n_success", "n_failed", "n_batches", "archive_dir", "n_failed_listed")


@query("src_log_errors", _LOG_SQL + """
SELECT run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, 'exception' AS kind, ticker, 'worker died at ' || CAST(item AS VARCHAR) AS message
FROM ranked WHERE raised
UNION ALL
SELECT run_id, ts_text, CASE WHEN remainder THEN 'final_batch_error' ELSE 'archive_error' END, NULL,
       'no space for batch ' || CAST(batch_no AS VARCHAR)
FROM batch WHERE lost
""")
def src_log_errors(spark, d):
    """Exceptions and archive errors that the logs tell of."""
    e = runlog_source.log_errors(read_log(spark, _written_logs(spark, d)))
    return e.select("run_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"), "kind", "ticker", "message")
