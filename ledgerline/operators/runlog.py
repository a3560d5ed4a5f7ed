"""Run-log operators: retention selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def retention(logs: DataFrame, as_of: Column, days: int, mtime: str = "mtime") -> DataFrame:
    """Log records whose age in whole days exceeds ``days`` ('find -mtime +N' semantics).
    The deletion itself is left to the caller."""
    age = F.floor(F.timestamp_diff("MICROSECOND", F.col(mtime), as_of) / F.lit(DAY_US)).cast("bigint")
    return logs.withColumn("age_days", age).filter(F.col("age_days") > days)
