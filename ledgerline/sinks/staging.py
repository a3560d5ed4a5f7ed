"""The staging table: rows leave by tombstones that are merged on read, and partitions are rewritten when enough
of them is dead.

    <root>/rows/set=<id>/<by>=<value>/       rows, never changed once written
    <root>/gone/set=<id>/<by>=<value>/       tombstones: keys whose rows left
    <root>/_versions/v<number>.json          which sets count, and since when

Removing a company writes one key per partition that holds it, whatever the size of its rows; its tombstone
covers the rows that were there in the version it was made from, so rows that are staged again later stay. A
partition whose share of dead rows passes a threshold is rewritten alone: its live rows become a new set, and
the older sets count without it.

Versions are numbered by the file that only one writer can create. Adding rows and removing keys both hold
on top of any newer version, so a writer that comes second tries again with the next number. A rewrite does
not: if another version came first it is given up (``VersionConflict``), and nothing of it is visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sinks import pointer

EMPTY = {"rows": [], "gone": []}


@dataclass(frozen=True)
class Staging:
    """A staging table of ``schema`` rows, in folders by ``by`` (few values), that leave by ``key``."""

    root: str
    schema: T.StructType
    by: str = "filing_year"
    key: str = "ticker"

    def _versions(self) -> str:
        return f"{self.root.rstrip('/')}/_versions"

    def _state(self) -> tuple[int, dict]:
        number, record = pointer.newest(self._versions())
        return number, record or EMPTY

    def version(self) -> int:
        return self._state()[0]

    def _write(self, df: DataFrame, kind: str) -> str:
        name = uuid.uuid4().hex
        df.repartition(self.by).write.partitionBy(self.by).parquet(f"{self.root.rstrip('/')}/{kind}/set={name}")
        return name

    def _publish(self, spark: SparkSession, change: Callable[[dict, int], dict]) -> int:
        """Apply a change that holds on top of any version."""
        while True:
            number, record = self._state()
            try:
                return pointer.publish(spark, self._versions(), change(record, number + 1), after=number)
            except pointer.VersionConflict:
                continue

    def add(self, rows: DataFrame) -> int:
        """Stage rows; returns the version that holds them."""
        name = self._write(rows.select(*self.schema.names), "rows")
        return self._publish(rows.sparkSession, lambda record, number: record | {
            "rows": [*record["rows"], {"set": name, "since": number, "without": []}]})

    def _sets(self, spark: SparkSession, record: dict, kind: str, schema: T.StructType) -> DataFrame | None:
        """Rows of the sets of one kind that count, each with ``_since``, less the partitions that were rewritten."""
        sets = record[kind]
        if not sets:
            return None
        base = f"{self.root.rstrip('/')}/{kind}"
        whole = T.StructType([*schema.fields, T.StructField("set", T.StringType())])
        found = spark.read.schema(whole).option("basePath", base).parquet(*(f"{base}/set={s['set']}" for s in sets))
        marks = spark.createDataFrame([(s["set"], s["since"]) for s in sets], "set string, _since bigint")
        for s in sets:
            if s.get("without"):
                values = [v for v in s["without"] if v is not None]
                dead = F.col(self.by).isin(values) if values else F.lit(False)
                if None in s["without"]:
                    dead = dead | F.col(self.by).isNull()
                found = found.filter((F.col("set") != s["set"]) | ~F.coalesce(dead, F.lit(False)))
        return found.join(F.broadcast(marks), "set").drop("set")  # one row per set

    def _tombstones(self, spark: SparkSession, record: dict) -> DataFrame | None:
        keys = T.StructType([self.schema[self.by], self.schema[self.key]])
        gone = self._sets(spark, record, "gone", keys)
        return None if gone is None else gone.groupBy(
            F.col(self.by).alias("_by"), F.col(self.key).alias("_key")).agg(F.max("_since").alias("_until"))

    def _marked(self, spark: SparkSession, record: dict, columns: list[str]) -> DataFrame:
        """All rows with ``_live``: no tombstone of their key is younger than they are."""
        rows = self._sets(spark, record, "rows", self.schema)
        if rows is None:
            return spark.createDataFrame([], self.schema).select(*columns).withColumn("_live", F.lit(True))
        gone = self._tombstones(spark, record)
        rows = rows.select(*dict.fromkeys([*columns, self.by, self.key]), "_since")
        if gone is None:
            return rows.select(*columns, F.lit(True).alias("_live"))
        rows = rows.join(gone, F.equal_null(self.by, "_by") & (F.col(self.key) == F.col("_key")), "left")
        return rows.select(*columns, F.coalesce(F.col("_until") < F.col("_since"), F.lit(True)).alias("_live"))

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows that are staged now."""
        return self._marked(spark, self._state()[1], self.schema.names).filter("_live").select(*self.schema.names)

    def remove(self, keys: DataFrame) -> int:
        """Let the rows of these keys leave: a tombstone for each key and partition that holds it now."""
        spark = keys.sparkSession
        number, record = self._state()
        live = self._marked(spark, record, [self.by, self.key]).filter("_live")
        gone = live.join(keys.select(self.key).distinct(), self.key, "left_semi").select(self.by, self.key).distinct()
        name = self._write(gone, "gone")
        # it covers rows up to the version that was read, whatever is published in between
        return self._publish(spark, lambda record, _: record | {
            "gone": [*record["gone"], {"set": name, "since": number, "without": []}]})

    def dead_share(self, spark: SparkSession) -> DataFrame:
        """Partition value, rows, and how many of them are dead."""
        marked = self._marked(spark, self._state()[1], [self.by])
        return marked.groupBy(self.by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_live")).alias("dead"))

    def compact(self, spark: SparkSession, threshold: float = 0.5) -> list:
        """Rewrite the partitions of which more than ``threshold`` is dead; returns their values. Gives up with
        ``VersionConflict`` if another version is published meanwhile."""
        number, record = self._state()
        marked = self._marked(spark, record, [self.by])
        worn = marked.groupBy(self.by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_live")).alias("dead"))
        values = [r[0] for r in worn.filter(F.col("dead") > F.col("rows") * threshold).select(self.by).collect()]
        if not values:
            return []
        chosen = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("_chosen", self.schema[self.by].dataType)]))
        live = self._marked(spark, record, self.schema.names).filter("_live").select(*self.schema.names)
        name = self._write(live.join(F.broadcast(chosen), F.equal_null(self.by, "_chosen"), "left_semi"), "rows")
        without = lambda s: s | {"without": [*s["without"], *values]}
        pointer.publish(spark, self._versions(), {
            "rows": [*map(without, record["rows"]), {"set": name, "since": number + 1, "without": []}],
            "gone": list(map(without, record["gone"]))}, after=number)
        return values
