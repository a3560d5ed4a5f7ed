"""Incremental operators: what is new, what is already held, what failed to land."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skip_existing(candidates: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates not yet held (left anti join on the keys only: bodies are attached later)."""
    return candidates.join(held.select(*keys), list(keys), "left_anti")


def already_held(candidates: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candidates.join(held.select(*keys), list(keys), "left_semi")


def held_union(staged: DataFrame, archived: DataFrame, keys: Sequence[str], include_archived: bool = True) -> DataFrame:
    """Staged ∪ archived as the held set (distinct keys; partial aggregation before the shuffle).
    ``include_archived=False`` reproduces a skip test that only sees the staging tree (so a
    re-run after cleanup fetches archived filings again)."""
    held = staged.select(*keys)
    if include_archived:
        held = held.unionByName(archived.select(*keys))
    return held.distinct()


def distinct_by_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the row with the smallest ``order`` value winning (deterministic).
    A hash aggregate with map-side combine: a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(order, *rest)).alias("_w"))
    return agg.select(*keys, *[F.col("_w")[c].alias(c) for c in rest])


def not_succeeded(listed: DataFrame, succeeded: DataFrame, keys: Sequence[str]) -> DataFrame:
    return listed.join(succeeded.select(*keys), list(keys), "left_anti")


def landed(body: DataFrame, size_col: str = "body_chars") -> DataFrame:
    """Bodies that arrived with content (a zero-length body counts as not landed)."""
    return body.filter(F.col(size_col) > 0)


def failed_bodies(index: DataFrame, body: DataFrame, key: str = "k", size_col: str = "body_chars") -> DataFrame:
    """Index rows whose body did not arrive or arrived empty."""
    return index.join(landed(body, size_col).select(key), key, "left_anti")
