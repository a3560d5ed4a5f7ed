"""Exact ordered rank without a single-partition window.

``Window.partitionBy(run).orderBy(ts)`` sends a whole run to one task; a run may hold a third of
all rows. Instead the rows are range-partitioned on (group, order...) — Spark samples the keys,
so even one huge group is cut into balanced contiguous slices — and sorted inside each slice.
A running id then numbers rows inside a slice, and a small table of per-(slice, group) counts
turns slice-local positions into exact group-wide ranks.

The numbered rows are checkpointed (reliable checkpoint in ``spark.checkpoint.dir``) before they
are read twice: range bounds come from a sample seeded by the RDD id, so two separate evaluations
could cut different slices. The checkpoint fixes slice ids and running ids once and also cuts the
lineage, so a lost executor does not force the ranking to be recomputed.

The per-(slice, group) table has at most ``slices + groups`` rows. Its size is checked before
it is broadcast; beyond the limit it is joined by shuffle instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_root, partitions_for_size

# Above this many (slice, group) rows (about 10 MB of offsets) the offsets are joined by shuffle
# instead of broadcast.
BROADCAST_MAX_ROWS = 200_000


# Rows per range slice when the slice count is not given (slices hold key-sized rows).
SLICE_ROWS = 2_000_000


def ordered_rank(df: DataFrame, order: Sequence[str], groups: Sequence[str] = (), rank_col: str = "rank",
                 size_col: str | None = None, first_col: str | None = None, slices: int | None = None,
                 max_groups: int | None = None) -> DataFrame:
    """Add ``rank_col``: 1-based row_number over ``groups`` ordered by ``order``.

    ``order`` must be a total order inside a group (end it with a unique id). Optional outputs:
    ``size_col`` = rows in the group, ``first_col`` = value of ``order[0]`` on the group's first row.
    ``max_groups`` is a proven upper bound on distinct groups; without it the groups are counted
    (in the same aggregate that counts rows for the slice count) before choosing broadcast or
    shuffle for the offsets. A null group key is a group of its own.
    """
    groups, order = list(groups), list(order)
    spark = df.sparkSession
    # one narrow aggregate measures what sizing needs: rows (slice count), groups (offsets bound)
    need_groups = bool(groups) and max_groups is None
    measured = None
    if slices is None or need_groups:
        aggs = [F.count(F.lit(1)).alias("rows")]
        if need_groups:
            aggs.append(F.count_distinct(*groups).alias("groups"))
        measured = df.agg(*aggs).first()
    n = int(slices) if slices else partitions_for_size(spark, measured["rows"], SLICE_ROWS)
    keys = groups + order
    # repartitionByRange with an explicit count is never coalesced by AQE, so slice ids are stable
    r = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_rid", F.monotonically_increasing_id())
    )
    checkpoint_root(df.sparkSession)
    r = r.checkpoint(eager=True)
    aggs = [F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_first")]
    if first_col:
        aggs.append(F.min(order[0]).alias("_omin"))
    stats = r.groupBy("_slice", *groups).agg(*aggs)
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    cols = ["_slice", *groups, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")]
    if size_col:
        cols.append(F.sum("_n").over(whole).cast("bigint").alias(size_col))
    if first_col:
        cols.append(F.min("_omin").over(whole).alias(first_col))
    stats = stats.select(*cols)

    # +1: a null group key is not counted by count_distinct
    bound = n if not groups else n + (max_groups if max_groups is not None else measured["groups"] + 1)
    # null-safe on the group keys: rows of a null group are ranked like any other group
    renamed = {g: f"_g{i}" for i, g in enumerate(groups)}
    stats = stats.select(*[F.col(c).alias(renamed.get(c, "_s_slice" if c == "_slice" else c)) for c in stats.columns])
    if bound <= BROADCAST_MAX_ROWS:
        stats = F.broadcast(stats)
    cond = F.col("_slice") == F.col("_s_slice")
    for g, a in renamed.items():
        cond = cond & F.col(g).eqNullSafe(F.col(a))
    out = r.join(stats, cond, "inner")
    out = out.withColumn(rank_col, (F.col("_rid") - F.col("_first") + F.col("_before") + 1).cast("bigint"))
    return out.drop("_slice", "_s_slice", "_rid", "_first", "_before", *renamed.values())
