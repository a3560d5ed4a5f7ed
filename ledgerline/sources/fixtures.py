"""Fixture views: the filings data model mapped onto the driver's tables.

The mapping rules (which customer becomes which company, which order becomes which filing,
which filings count as staged or archived) are fixed values of the test mapping and are
stated together here. Every view is a lazy DataFrame over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.sources.tables import table

# ---- fixed values of the fixture mapping -------------------------------------------------
TICKER_PREFIX = "T"
NO_TICKER_EVERY = 97          # customer keys divisible by this have no ticker
NO_NAME_EVERY = 89            # ... and by this have no company name
FORM_BY_PRIORITY = [("1", "10-K"), ("2", "10-Q"), ("3", "8-K"), ("4", "10-K/A"), ("5", "DEF 14A")]
BODY_MISSING_EVERY = (10, 7)  # k % 10 = 7: body never arrived
BODY_EMPTY_EVERY = 101        # k % 101 = 0: body arrived empty
# body html = pages.html with page_id = k % (largest page_id + 1), over the whole pages table
STAGED_EVERY = 3              # staged: landed and k % 3 = 0
ARCHIVED_EVERY = 5            # archived: landed and k % 5 = 0
AS_OF_YEAR = 2001
N_YEARS = 3
FORMS = ("10-K", "10-Q")
BATCH_SIZE = 12
ERROR_EVENT = "error"
# -------------------------------------------------------------------------------------------


def year_range(as_of_year: int = AS_OF_YEAR, n_years: int = N_YEARS) -> tuple[int, int]:
    return as_of_year - n_years + 1, as_of_year


def company(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, d, "customer", "c_custkey", "c_name").select(
        F.when(key % NO_TICKER_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(TICKER_PREFIX), key.cast("string"))).alias("ticker"),
        F.when(key % NO_NAME_EVERY == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("company_name"),
        key.cast("string").alias("cik"),
        key.alias("list_pos"),
    )


def _form(priority: Column) -> Column:
    digit = F.substring(priority, 1, 1)
    expr = None
    for p, form in FORM_BY_PRIORITY:
        expr = (F.when(digit == p, form) if expr is None else expr.when(digit == p, form))
    return expr


def filing_index(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("k"),
        F.concat(F.lit(TICKER_PREFIX), F.col("o_custkey").cast("string")).alias("ticker"),
        F.col("o_orderkey").cast("string").alias("accession"),
        _form(F.col("o_orderpriority")).alias("form"),
        F.to_date(F.col("o_orderdate")).alias("filing_date"),
        F.year("o_orderdate").cast("bigint").alias("filing_year"),
        F.col("o_orderdate").alias("filed_at"),
    )


def _page_modulus(spark: SparkSession, d: str) -> int:
    """Largest page_id + 1 (read from the Parquet footers' statistics by Spark's aggregate)."""
    return (table(spark, d, "pages", "page_id").agg(F.max("page_id")).first()[0] or 0) + 1


def body_pages(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and digest of every page, one row per page id; no html leaves the scan."""
    p = table(spark, d, "pages", "page_id", "html")
    return p.select(
        "page_id",
        F.length("html").cast("bigint").alias("page_chars"),
        F.octet_length("html").cast("bigint").alias("page_bytes"),
        F.md5(F.col("html")).alias("page_md5"),
    ).groupBy("page_id").agg(*[F.max(c).alias(c) for c in ("page_chars", "page_bytes", "page_md5")])


def attach_body(rows: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Rows (with key ``k``) whose body arrived, with body_chars / body_bytes / body_md5; empty
    bodies have 0 chars. Joined on the page key; Spark picks broadcast or shuffle by size."""
    k = F.col("k")
    empty = k % BODY_EMPTY_EVERY == 0
    zero = F.lit(0).cast("bigint")
    landed = rows.filter(k % BODY_MISSING_EVERY[0] != BODY_MISSING_EVERY[1])
    landed = landed.withColumn("_page", k % F.lit(_page_modulus(spark, d)))
    j = landed.join(body_pages(spark, d).withColumnRenamed("page_id", "_page"), "_page")
    return j.select(
        *rows.columns,
        F.when(empty, zero).otherwise(F.col("page_chars")).alias("body_chars"),
        F.when(empty, zero).otherwise(F.col("page_bytes")).alias("body_bytes"),
        F.when(empty, F.md5(F.lit(""))).otherwise(F.col("page_md5")).alias("body_md5"),
    )


def page_share(page: Column, n: int) -> Column:
    """The share (0 to n - 1) of a page id."""
    return F.pmod(F.xxhash64(page.cast("bigint")), F.lit(n))


def page_of(spark: SparkSession, d: str) -> Column:
    """The page id of the body of filing ``k``."""
    return F.col("k") % F.lit(_page_modulus(spark, d))


def attach_html(rows: DataFrame, spark: SparkSession, d: str, share: tuple[int, int] | None = None) -> DataFrame:
    """Add ``html`` to rows that already have a body (key ``k``). Called last: everything that
    needs keys, sizes or digests alone is done before the text is moved, once. ``share`` (i, n): all rows
    are of the i-th of n shares of the pages, and no other page is moved."""
    k = F.col("k")
    pages = table(spark, d, "pages", "page_id", "html")
    if share:
        pages = pages.filter(page_share(F.col("page_id"), share[1]) == share[0])
    p = pages.groupBy(F.col("page_id").alias("_page")).agg(F.max("html").alias("_html"))
    j = rows.withColumn("_page", k % F.lit(_page_modulus(spark, d))).join(p, "_page")
    return j.select(*rows.columns, F.when(k % BODY_EMPTY_EVERY == 0, F.lit("")).otherwise(F.col("_html")).alias("html"))


def body_state(spark: SparkSession, d: str, index: DataFrame | None = None) -> DataFrame:
    """(k, body_chars, body_bytes, body_md5) for filings whose body arrived; empty bodies have 0.
    Bodies that never arrived have no row."""
    index = index if index is not None else filing_index(spark, d)
    return attach_body(index.select("k"), spark, d)


def filing_body(spark: SparkSession, d: str, index: DataFrame | None = None) -> DataFrame:
    """(k, accession, html): the landed bodies with their text. Only used where text is needed
    (archives, stores); the html column is attached after all key-only work is done."""
    index = index if index is not None else filing_index(spark, d)
    rows = attach_body(index.select("k", "accession"), spark, d)
    return attach_html(rows.select("k", "accession"), spark, d)


def _landed(spark, d, index, every) -> DataFrame:
    cand = index.filter(F.col("k") % every == 0)
    return attach_body(cand, spark, d).filter(F.col("body_chars") > 0)


def staged(spark: SparkSession, d: str, index: DataFrame | None = None) -> DataFrame:
    """Filings held in the staging tree, with body sizes."""
    index = index if index is not None else filing_index(spark, d)
    return _landed(spark, d, index, STAGED_EVERY)


def archived(spark: SparkSession, d: str, index: DataFrame | None = None) -> DataFrame:
    """Filings held in batch archives (overlaps staged)."""
    index = index if index is not None else filing_index(spark, d)
    return _landed(spark, d, index, ARCHIVED_EVERY)


def holdings(spark: SparkSession, d: str, index: DataFrame | None = None) -> DataFrame:
    """(k, body_chars, held) of every filing whose body arrived, from one scan: held says that it is staged or
    archived."""
    index = index if index is not None else filing_index(spark, d)
    kept = (F.col("k") % STAGED_EVERY == 0) | (F.col("k") % ARCHIVED_EVERY == 0)
    return body_state(spark, d, index).select("k", "body_chars", (kept & (F.col("body_chars") > 0)).alias("held"))


def held(spark: SparkSession, d: str, index: DataFrame | None = None) -> DataFrame:
    """Keys of staged ∪ archived (a filing has one row in the index, so they are distinct)."""
    return holdings(spark, d, index).filter("held").select("k")


def wanted(spark: SparkSession, d: str, index: DataFrame | None = None, comp: DataFrame | None = None) -> DataFrame:
    from ledgerline.operators.worklist import wanted_filings

    index = index if index is not None else filing_index(spark, d)
    comp = comp if comp is not None else company(spark, d)
    return wanted_filings(index, comp, year_range(), FORMS)


def completion(spark: SparkSession, d: str) -> DataFrame:
    """Company completions of runs: one row per event, run = calendar day of the event."""
    e = table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    return e.select(
        F.col("event_id").alias("item"),
        F.concat(F.lit(TICKER_PREFIX), F.col("user_id").cast("string")).alias("ticker"),
        F.col("ts"),
        F.to_date("ts").alias("run_day"),
        F.concat(F.lit(S.RUN_PREFIX), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        (F.col("event_type") != ERROR_EVENT).alias("ok"),
    )


def files(spark: SparkSession, d: str, index: DataFrame | None = None) -> DataFrame:
    """Staged files: relative path, byte size and modification time."""
    st = staged(spark, d, index)
    return st.select(
        "k", "ticker", "accession", "form", "filing_year",
        S.rel_path("ticker", "filing_year", "form", "accession").alias("rel_path"),
        F.col("body_bytes").alias("size"),
        F.col("filed_at").alias("mtime"),
    )
