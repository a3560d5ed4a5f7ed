"""Company list writers: JSON records (one per line) or JSON-array files of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S

# Fixed record keys of the company list.
KEY_TICKER, KEY_NAME, KEY_CIK = "Ticker", "Company Name", "CIK"


def _records(company: DataFrame) -> DataFrame:
    return company.select(
        F.col("ticker").alias(KEY_TICKER), F.col("company_name").alias(KEY_NAME), S.cik_pad("cik").alias(KEY_CIK))


def write_company_lines(company: DataFrame, path: str) -> None:
    """JSON Lines (splittable, one record per line); a missing value is an absent key."""
    _records(company).write.mode("errorifexists").json(path)


def company_arrays(company: DataFrame, per_file: int = 1000, order: str = "list_pos") -> DataFrame:
    """(file_no, value): the reference's shape, a JSON array of records, cut into texts of at most ``per_file``
    records in list order. File numbers come from the exact rank (unique even when positions repeat), so every
    file's group is bounded by ``per_file``."""
    from ledgerline.operators.ranking import ordered_rank

    rec = company.select(
        F.col(order).alias("_pos"),
        F.to_json(F.struct(F.col("ticker").alias(KEY_TICKER), F.col("company_name").alias(KEY_NAME),
                           S.cik_pad("cik").alias(KEY_CIK))).alias("_json"),
    )
    rec = ordered_rank(rec, ["_pos", "_json"], rank_col="_rank")
    rec = rec.withColumn("file_no", S.batch_of("_rank", per_file) - 1)
    files = rec.groupBy("file_no").agg(F.sort_array(F.collect_list(F.struct("_rank", "_json"))).alias("_r"))
    text = F.concat(F.lit("[\n"), F.array_join(F.transform("_r", lambda x: x["_json"]), ",\n"), F.lit("\n]"))
    return files.select("file_no", text.alias("value"))


def write_company_arrays(company: DataFrame, path: str, per_file: int = 1000, order: str = "list_pos") -> None:
    """Write the array texts, one file each."""
    company_arrays(company, per_file, order).write.mode("errorifexists").partitionBy("file_no").text(path)
