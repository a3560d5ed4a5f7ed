"""Registry of queries and their SQL oracles.

Query modules register with the ``query`` decorator; ``FIXTURE_SQL`` is the SQL twin of
``ledgerline.sources.fixtures`` (same mapping rules, written independently in SQL).
"""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

_MODULES = (
    "ledgerline.plans.corpus_queries",
    "ledgerline.plans.run_queries",
    "ledgerline.plans.archive_queries",
    "ledgerline.plans.connector_queries",
    "ledgerline.plans.stream_queries",
)

FIXTURE_SQL = """
WITH company AS (
  SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 'T' || CAST(c_custkey AS VARCHAR) END AS ticker,
         CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE c_name END AS company_name,
         CAST(c_custkey AS VARCHAR) AS cik,
         c_custkey AS list_pos
  FROM customer
), filing_index AS (
  SELECT o_orderkey AS k,
         'T' || CAST(o_custkey AS VARCHAR) AS ticker,
         CAST(o_orderkey AS VARCHAR) AS accession,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '10-K' WHEN '2' THEN '10-Q' WHEN '3' THEN '8-K'
              WHEN '4' THEN '10-K/A' WHEN '5' THEN 'DEF 14A' END AS form,
         CAST(o_orderdate AS DATE) AS filing_date,
         CAST(year(o_orderdate) AS BIGINT) AS filing_year,
         o_orderdate AS filed_at
  FROM orders
), body_pages AS (
  SELECT page_id, max(length(html)) AS page_chars, max(strlen(html)) AS page_bytes,
         max(md5(html)) AS page_md5, max(html) AS page_html
  FROM pages GROUP BY page_id
), body_state AS (
  SELECT i.k,
         CASE WHEN i.k % 101 = 0 THEN 0 ELSE p.page_chars END AS body_chars,
         CASE WHEN i.k % 101 = 0 THEN 0 ELSE p.page_bytes END AS body_bytes,
         CASE WHEN i.k % 101 = 0 THEN md5('') ELSE p.page_md5 END AS body_md5,
         CASE WHEN i.k % 101 = 0 THEN '' ELSE p.page_html END AS html
  FROM filing_index i JOIN body_pages p ON p.page_id = i.k % (SELECT max(page_id) + 1 FROM pages)
  WHERE i.k % 10 <> 7
), staged AS (
  SELECT i.*, b.body_chars, b.body_bytes, b.body_md5
  FROM filing_index i JOIN body_state b ON b.k = i.k
  WHERE i.k % 3 = 0 AND b.body_chars > 0
), archived AS (
  SELECT i.*, b.body_chars, b.body_bytes, b.body_md5
  FROM filing_index i JOIN body_state b ON b.k = i.k
  WHERE i.k % 5 = 0 AND b.body_chars > 0
), held AS (
  SELECT k FROM staged UNION SELECT k FROM archived
), listed AS (
  SELECT * FROM company WHERE ticker IS NOT NULL AND length(ticker) > 0
), wanted AS (
  SELECT * FROM filing_index
  WHERE form IN ('10-K', '10-Q') AND filing_year BETWEEN 1999 AND 2001
    AND ticker IN (SELECT ticker FROM listed)
), completion AS (
  SELECT event_id AS item, 'T' || CAST(user_id AS VARCHAR) AS ticker, ts,
         CAST(ts AS DATE) AS run_day, 'run_' || strftime(ts, '%Y%m%d') AS run_id,
         event_type <> 'error' AS ok
  FROM events
), files AS (
  SELECT k, ticker, accession, form, filing_year,
         ticker || '/' || CAST(filing_year AS VARCHAR) || '/' || replace(form, '/', '%2F') || '/' || accession || '.html' AS rel_path,
         body_bytes AS size, filed_at AS mtime
  FROM staged
)
"""


def query(key: str, sql: str | None = None):
    """Register a query builder under ``key``; ``sql`` (without the fixture prefix) is its oracle."""

    def wrap(fn: QueryFn) -> QueryFn:
        prev = _QUERIES.get(key)
        if prev is not None and (prev.__module__, prev.__qualname__) != (fn.__module__, fn.__qualname__):
            raise ValueError(f"duplicate query key {key}")  # a re-import of the same module is fine

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        _QUERIES[key] = run
        if sql is not None:
            _SQL[key] = FIXTURE_SQL + sql
        return fn

    return wrap


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
