"""The filing store: one row per filing, in folders by (filing_year, form), bucketed by path and sorted by ticker.

A filing's path in the staged tree (``rel_path``: ticker/year/form/accession) is its key: two filings with one
path are one file. Rows lie in a fixed number of buckets by the hash of that path, so what a load shares with
the store is found without moving the store: the load is hashed into the same buckets once, and in that one
exchange its rows are de-duplicated, compared with the stored paths of the years that it touches, and
written. A company that holds a third of all filings spreads over all buckets; inside a file rows are sorted
by ticker, whose min/max statistics let a ticker filter skip row groups.

Spark keeps bucketing in its catalog only, so the number of buckets is recorded beside the data and the folder
is registered as a table in each session that compares with it. Reads by path (``read_store``) need no table.
Appends are incremental: re-running a load adds nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import scalars as S
from ledgerline.session import partitions_for_size
from ledgerline.sinks import pointer

KEY = "rel_path"
STORE_TASK_BYTES = 512 << 20  # body bytes per bucket at the first load
PARTITIONS = ("filing_year", "form")
SORT = ("ticker", "accession")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The store with ``filing_year`` as BIGINT (partition inference would make it INT); a
    filter on it is still a partition filter."""
    return spark.read.parquet(path).withColumn("filing_year", F.col("filing_year").cast("bigint"))


def _layout(path: str) -> dict | None:
    return pointer.newest(f"{path.rstrip('/')}/_layout")[1]


def _table(spark: SparkSession, path: str) -> str:
    """The catalog name of the store at ``path``, registered with its buckets and the folders that are there."""
    name = "ledgerline_store_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        layout = _layout(path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(layout["schema"]).fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(PARTITIONS)}) "
                  f"CLUSTERED BY ({KEY}) SORTED BY ({', '.join(SORT)}) INTO {int(layout['buckets'])} BUCKETS "
                  f"LOCATION '{path.rstrip('/')}'")
    spark.catalog.recoverPartitions(name)
    return name


def stored_keys(spark: SparkSession, path: str) -> DataFrame:
    """``rel_path`` and ``filing_year`` of the stored filings, read by buckets: a join on ``rel_path`` with rows that
    are hashed into as many partitions moves none of them."""
    return spark.table(_table(spark, path)).select(KEY, "filing_year")


def _with_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn(KEY, S.rel_path("ticker", "filing_year", "form", "accession"))


def not_stored(rows: DataFrame, path: str) -> DataFrame:
    """The rows of filings that the store at ``path`` does not hold, with their ``rel_path``. Rows cross one exchange,
    the store none."""
    spark = rows.sparkSession
    rows = _with_key(rows)
    layout = _layout(path)
    if layout is None:
        return rows
    # only the years that the load touches are compared
    touched = [r[0] for r in rows.select("filing_year").distinct().collect()]
    have = stored_keys(spark, path).filter(F.col("filing_year").isin(touched)).select(KEY)
    return rows.repartition(int(layout["buckets"]), KEY).join(have, KEY, "left_anti")


def new_filings(rows: DataFrame, path: str) -> DataFrame:
    """What ``store_filings`` writes: rows hashed into the store's buckets, one for each path, none that is stored."""
    return not_stored(rows, path).dropDuplicates([KEY])


def store_filings(rows: DataFrame, path: str, num_buckets: int | None = None, body: str = "html") -> None:
    """Append the filings that the store at ``path`` does not hold yet. The first load decides the buckets: about
    ``STORE_TASK_BYTES`` of bodies each."""
    spark = rows.sparkSession
    if _layout(path) is None:
        if not num_buckets:  # known body sizes if the rows carry them, else measured
            size = F.col("body_bytes") if "body_bytes" in rows.columns else F.octet_length(body)
            num_buckets = partitions_for_size(spark, rows.agg(F.sum(size)).first()[0] or 0, STORE_TASK_BYTES)
        schema = _with_key(rows.drop("body_bytes")).schema
        try:
            pointer.publish(spark, f"{path.rstrip('/')}/_layout", {"buckets": num_buckets, "schema": schema.jsonValue()}, after=0)
        except pointer.VersionConflict:
            pass  # another first load decided
    table = _table(spark, path)
    names = [f["name"] for f in _layout(path)["schema"]["fields"]]
    new = new_filings(rows.drop("body_bytes"), path)
    (new.select(*(n for n in names if n not in PARTITIONS), *PARTITIONS).write.mode("append").format("parquet")
     .partitionBy(*PARTITIONS).bucketBy(int(_layout(path)["buckets"]), KEY).sortBy(*SORT).saveAsTable(table))
