"""Worklist planning: companies × years × forms, matched against the filing index.

The worklist is generated with ``explode`` over parameter arrays (no join); the index is
matched with a sort-merge join on (ticker, year, form). Spark's size of generated rows is that of the
rows before ``explode``, so that left to choose it would broadcast a worklist of any size to every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S


def year_window(as_of_year: int, n_years: int = S.DEFAULT_YEARS) -> tuple[int, int]:
    """Calendar years [Y-N+1, Y]; Y is a parameter (the reference reads the clock)."""
    return as_of_year - n_years + 1, as_of_year


def usable_companies(company: DataFrame, ticker: str = "ticker") -> DataFrame:
    return company.filter(S.has_ticker(ticker))


def missing_ticker(company: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Rows that cannot be processed: they count as failed with a fixed message."""
    return company.filter(~S.has_ticker(ticker) | F.col(ticker).isNull()).select(
        "*",
        F.lit(False).alias("success"),
        F.lit("Missing ticker information").alias("message"),
    )


def filter_forms(df: DataFrame, forms: Sequence[str] = S.DEFAULT_FORMS, include_amendments: bool = False,
                 form: str = "form") -> DataFrame:
    """Exact form match; with ``include_amendments`` also '<form>/A'."""
    wanted = list(forms) + ([f + "/A" for f in forms] if include_amendments else [])
    return df.filter(F.col(form).isin(wanted))


def filter_year_window(df: DataFrame, years: tuple[int, int], year: str = "filing_year",
                       ts: str | None = "filed_at") -> DataFrame:
    """Compare on the year column itself so a store partitioned by year is pruned. When the rows
    also carry the filing timestamp (``ts``), the same window is added as a timestamp range:
    ``year(ts) BETWEEN ..`` cannot reach a Parquet scan, a range on ``ts`` can (row-group skip)."""
    lo, hi = years
    cond = F.col(year).between(lo, hi)
    if ts and ts in df.columns:
        start = F.lit(f"{lo}-01-01 00:00:00").cast("timestamp_ntz")
        end = F.lit(f"{hi + 1}-01-01 00:00:00").cast("timestamp_ntz")
        cond = cond & (F.col(ts) >= start) & (F.col(ts) < end)
    return df.filter(cond)


def plan_work(company: DataFrame, years: tuple[int, int], forms: Sequence[str] = S.DEFAULT_FORMS) -> DataFrame:
    """Every usable company × year × form, as generated rows (no join, no shuffle)."""
    lo, hi = years
    return (
        usable_companies(company)
        .select("ticker", F.explode(F.sequence(F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint"))).alias("work_year"))
        .select("ticker", "work_year", F.explode(F.array(*[F.lit(f) for f in forms])).alias("form"))
    )


def match_work_index(work: DataFrame, index: DataFrame) -> DataFrame:
    """Worklist ⋈ index on ticker, form and the year guard (filing year = requested year)."""
    idx = index.withColumnRenamed("ticker", "i_ticker").withColumnRenamed("form", "i_form")
    cond = (
        (F.col("ticker") == F.col("i_ticker"))
        & (F.col("form") == F.col("i_form"))
        & (F.col("work_year") == F.year("filing_date").cast("bigint"))
    )
    return work.hint("merge").join(idx, cond, "inner").drop("i_ticker", "i_form")


def empty_cells(work: DataFrame, index: DataFrame) -> DataFrame:
    """Work cells for which the index has no filing ('Found 0 filings')."""
    idx = index.select(F.col("ticker").alias("i_ticker"), F.col("form").alias("i_form"),
                       F.year("filing_date").cast("bigint").alias("i_year"))
    cond = (F.col("ticker") == F.col("i_ticker")) & (F.col("form") == F.col("i_form")) & (F.col("work_year") == F.col("i_year"))
    return work.join(idx, cond, "left_anti")


def wanted_filings(index: DataFrame, company: DataFrame, years: tuple[int, int],
                   forms: Sequence[str] = S.DEFAULT_FORMS) -> DataFrame:
    """Index rows of listed companies inside the year window and form list (a semi join, so a
    repeated ticker in the list cannot multiply filings)."""
    idx = filter_year_window(filter_forms(index, forms), years)
    return idx.join(usable_companies(company).select("ticker"), "ticker", "left_semi")


def year_guard(index: DataFrame, years: tuple[int, int], slack_days: int = 1) -> DataFrame:
    """Index lookups by year may return filings dated just outside the year; each filing is a
    candidate for every requested year whose widened date range contains it, and the guard keeps
    only the (filing, year) pairs whose filing year equals the requested year."""
    lo, hi = years
    d = F.col("filing_date")
    cand = F.array_distinct(F.array(
        F.year(F.date_sub(d, slack_days)), F.year(d), F.year(F.date_add(d, slack_days))).cast("array<bigint>"))
    ex = index.select("*", F.explode(cand).alias("work_year"))
    ex = ex.filter(F.col("work_year").between(lo, hi))
    return ex.filter(F.col("work_year") == F.year(d).cast("bigint"))


def filter_month_range(df: DataFrame, start: tuple[int, int], end: tuple[int, int] | None = None,
                       date: str = "filing_date") -> DataFrame:
    """Dates from the first day of the start month to the last day of the end month (optional)."""
    y0, m0 = start
    cond = F.col(date) >= F.make_date(F.lit(y0), F.lit(m0), F.lit(1))
    if end is not None:
        y1, m1 = end
        y1, m1 = (y1 + 1, 1) if m1 == 12 else (y1, m1 + 1)
        cond = cond & (F.col(date) < F.make_date(F.lit(y1), F.lit(m1), F.lit(1)))
    return df.filter(cond)
