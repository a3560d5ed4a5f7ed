"""Company-list operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S

# Fixed column names of the web company table and of the company list.
WEB_COLUMNS = {"Symbol": "ticker", "Security": "company_name", "CIK": "cik"}


def company_columns(web: DataFrame) -> DataFrame:
    """Keep Symbol / Security / CIK, rename them, pad the CIK (column pruning reaches the scan)."""
    return web.select(
        F.col("Symbol").cast("string").alias("ticker"),
        F.col("Security").cast("string").alias("company_name"),
        S.cik_pad(F.col("CIK")).alias("cik"),
    )


def lookup_tickers(company: DataFrame, tickers: DataFrame) -> DataFrame:
    """Company rows whose ticker is in a ticker list (semi join; the list is de-duplicated by
    the join itself, so a repeated ticker cannot multiply rows)."""
    return company.join(tickers.select("ticker"), "ticker", "left_semi")
