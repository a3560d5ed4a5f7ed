"""Per-company coverage: expected, held, new, failed filings and empty work cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.worklist import usable_companies


def company_coverage(company: DataFrame, wanted: DataFrame, held: DataFrame, body: DataFrame,
                     n_cells: int, key: str = "k") -> DataFrame:
    """One row per listed company with a ticker.

    ``wanted``: index rows (key, ticker, filing_year, form) in the window; ``held``: held keys;
    ``body``: (key, body_chars) for bodies that arrived. Joins are on the filing key, so they
    share one hash partitioning; the aggregation runs in two steps (cells, then companies) with
    map-side combine, so a company holding a large share of filings is reduced before any
    shuffle on ticker.
    """
    h = held.select(key).withColumn("held", F.lit(True))
    b = body.select(key, "body_chars")
    w = wanted.select(key, "ticker", "filing_year", "form").join(h, key, "left").join(b, key, "left")
    return coverage_of(company, w, n_cells)


def coverage_of(company: DataFrame, w: DataFrame, n_cells: int) -> DataFrame:
    """The same over wanted filings (ticker, filing_year, form) that already carry ``held`` and ``body_chars``."""
    is_held = F.coalesce(F.col("held"), F.lit(False))
    has_body = F.coalesce(F.col("body_chars"), F.lit(0)) > 0
    cells = w.groupBy("ticker", "filing_year", "form").agg(
        F.count(F.lit(1)).alias("c_expected"),
        F.count_if(is_held).alias("c_held"),
        F.count_if(~is_held & has_body).alias("c_new"),
        F.count_if(~is_held & ~has_body).alias("c_failed"),
    )
    per_company = cells.groupBy("ticker").agg(
        F.sum("c_expected").alias("n_expected"),
        F.sum("c_held").alias("n_held"),
        F.sum("c_new").alias("n_new"),
        F.sum("c_failed").alias("n_failed"),
        F.count(F.lit(1)).alias("n_cells_found"),
    )
    listed = usable_companies(company).select("ticker")
    out = listed.join(per_company, "ticker", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "ticker",
        F.coalesce("n_expected", zero).cast("bigint").alias("n_expected"),
        F.coalesce("n_held", zero).cast("bigint").alias("n_held"),
        F.coalesce("n_new", zero).cast("bigint").alias("n_new"),
        F.coalesce("n_failed", zero).cast("bigint").alias("n_failed"),
        (F.lit(n_cells) - F.coalesce("n_cells_found", zero)).cast("bigint").alias("n_empty_cells"),
        # the reference reports success even when nothing was stored; this says whether every
        # expected filing is held or newly landed
        (F.coalesce("n_failed", zero) == 0).alias("complete"),
    )
