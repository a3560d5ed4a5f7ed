"""Exact deduplication of incoming rows against immutable snapshots.

Texts are equal when they are identical after lower-casing A-Z; null counts as the empty text.
1. Every row gets the SHA-256 of its normalised text; digests are reduced per batch (count, largest
   id), so a group of copies is one row per task before anything is shuffled.
2. Each snapshot has one static binary-fuse filter per digest bucket, written once. Incoming
   digests meet only their bucket's filters: no match means new, for certain.
3. Possible matches join the snapshot's exact digest rows. Digests that are new are grouped among
   the incoming rows alone.
4. Rows of groups of two or more are compared byte by byte with the text of the row that stays.
   Their texts alone are shuffled: a filter over the repeated digests, broadcast while below
   ``FILTER_BYTES``, screens the scan; beyond that the join alone decides. Should texts of equal
   digest differ, they are grouped again by the texts themselves.
The row with the largest id stays. Repeated rows of one id count as copies of each other; all of
them carry the same keep_id, and kept is true for each row whose id is the keep_id. A null id is
never kept while another id is in the group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import fuse
from ledgerline.session import partitions_for_size, scratch_dir, ship_package

BUCKET_DIGESTS = 500_000
FILTER_BYTES = 16 << 20


def normalised(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def _sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=_sha256) -> DataFrame:
    """doc_id, n_bytes, digest (of the normalised text), text_sha256 (hex)."""
    ship_package(docs.sparkSession)
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, digest binary, text_sha256 string"

    def run(batches):
        for batch in batches:
            texts = [x.encode() for x in normalised(batch.column(1)).to_pylist()]
            strong = [_sha256(x) for x in texts]
            own = strong if digest is _sha256 else [digest(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(own, pa.binary()),
                 pa.array([x.hex() for x in strong], pa.string())], names=["doc_id", "n_bytes", "digest", "text_sha256"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def filter_keys(column: pa.Array) -> np.ndarray:
    """64-bit keys from the first bytes of the digests."""
    raw = b"".join(x[:8].ljust(8, b"\0") for x in column.to_pylist())
    return np.frombuffer(raw, dtype="<u8")


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    """``bucket``: the first two digest bytes, reduced (see ``_bucket_of``)."""
    head = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")
    return groups.withColumn("bucket", F.coalesce(head, F.lit(0)) % F.lit(buckets))


def _bucket_of(digest: bytes, buckets: int) -> int:
    return int.from_bytes(digest[:2], "big") % buckets


def filters(groups: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket over the distinct digests: bucket, n, seed, fingerprints."""
    def make(table: pa.Table) -> pa.Table:
        keys = np.unique(filter_keys(table.column("digest").combine_chunks()))
        seed, marks = fuse.build(keys)
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "n": [len(keys)], "seed": [seed],
                         "fingerprints": pa.array([marks.tobytes()], pa.binary())})

    return (_bucketed(groups.select("digest"), buckets).groupBy("bucket")
            .applyInArrow(make, "bucket int, n long, seed long, fingerprints binary"))


def screen(groups: DataFrame, snapshot_filters: DataFrame, buckets: int) -> DataFrame:
    """Incoming digest groups with ``maybe``: false means that no filter of the bucket knows it."""
    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.drop_columns(["bucket"])
        maybe = np.zeros(left.num_rows, dtype=bool)
        if left.num_rows:
            keys = filter_keys(left.column("digest").combine_chunks())
            for row in right.to_pylist():
                maybe |= fuse.contains(keys, row["n"], row["seed"], np.frombuffer(row["fingerprints"], np.uint8))
        return left.append_column("maybe", pa.array(maybe))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema.fields) + ", maybe boolean"
    return (_bucketed(groups, buckets).groupBy("bucket")
            .cogroup(snapshot_filters.groupBy("bucket")).applyInArrow(probe, schema))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))


def dedup(incoming: DataFrame, snapshots: list[DataFrame], id_col: str = "doc_id", text_col: str = "text",
          digest=_sha256) -> DataFrame:
    """One row per incoming and snapshot row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = incoming.sparkSession
    at = scratch_dir(spark, "exact")
    tables = [incoming, *snapshots]
    parts = [digests(t, id_col, text_col, digest).withColumn("part", F.lit(i)) for i, t in enumerate(tables)]
    rows = _written(spark, _union(parts), f"{at}/digests")

    fresh = _written(spark, _groups(rows.filter("part = 0")), f"{at}/incoming")
    held = _written(spark, rows.filter("part > 0").groupBy("part", "digest")
                    .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")), f"{at}/held")
    total = held.count() + fresh.count()
    buckets = max(1, -(-total // BUCKET_DIGESTS), min(64, partitions_for_size(spark, 0, 1)))
    made = [filters(held.filter(F.col("part") == i), buckets) for i in range(1, len(tables))]
    screened = fresh.withColumn("maybe", F.lit(False))
    if made:
        screened = screen(fresh, _written(spark, _union(made), f"{at}/filters"), buckets)
    screened = _written(spark, screened, f"{at}/screened")

    held_sums = held.groupBy("digest").agg(F.sum("n").alias("held_n"), F.max("last").alias("held_last"))
    hits = screened.filter("maybe").drop("maybe").join(held_sums, "digest", "left")
    matched = hits.select("digest", (F.col("n") + F.coalesce("held_n", F.lit(0))).alias("n"),
                          F.greatest("last", "held_last").alias("last"))
    new = screened.filter("not maybe").select("digest", "n", "last")
    known = held_sums.join(screened.filter("maybe").select("digest"), "digest", "left_anti")
    groups = _written(spark, matched.unionByName(new).unionByName(
        known.select("digest", F.col("held_n").alias("n"), F.col("held_last").alias("last"))), f"{at}/groups")

    repeated = _repeated(spark, tables, groups.filter("n > 1"), buckets, id_col, text_col, digest, at)
    differ = _written(spark, _differing(repeated, groups.filter("n > 1")), f"{at}/differ")
    final = rows.join(groups, "digest")
    if not differ.isEmpty():  # equal digests of unequal texts: those texts are groups of their own
        own = differ.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("own_n"), F.max("doc_id").alias("own_last"))
        own = own.select("digest", F.sha2("text", 256).alias("text_sha256"), "own_n", "own_last")
        moved = differ.groupBy("digest").agg(F.count(F.lit(1)).alias("moved"))
        final = (final.join(moved, "digest", "left").join(own, ["digest", "text_sha256"], "left")
                 .withColumn("n", F.coalesce("own_n", F.col("n") - F.coalesce("moved", F.lit(0))))
                 .withColumn("last", F.when(F.col("own_n").isNull(), F.col("last")).otherwise(F.col("own_last"))))
    return final.select("doc_id", F.col("last").alias("keep_id"), F.col("n").cast("bigint").alias("group_size"),
                        F.coalesce(F.col("doc_id") == F.col("last"), F.lit(False)).alias("kept"), "text_sha256")


def _repeated(spark: SparkSession, tables: list[DataFrame], groups: DataFrame, buckets: int, id_col: str,
              text_col: str, digest, at: str) -> DataFrame:
    """Rows of repeated digests with their normalised texts (and a few others that the filter lets by)."""
    n = groups.count()
    known = None
    if n * 1.3 <= FILTER_BYTES:
        known = spark.sparkContext.broadcast({
            r["bucket"]: (r["n"], r["seed"], np.frombuffer(r["fingerprints"], np.uint8))
            for r in filters(groups, buckets).collect()} if n else {})

    def run(batches):
        for batch in batches:
            texts = [x.encode() for x in normalised(batch.column(1)).to_pylist()]
            marks = pa.array([digest(x) for x in texts], pa.binary())
            take = np.ones(len(texts), dtype=bool)
            if known is not None:
                take[:] = False
                keys = filter_keys(marks)
                places = np.array([_bucket_of(x, buckets) for x in marks.to_pylist()], dtype=np.int64)
                for b in np.unique(places).tolist():
                    if b in known.value:
                        here = np.flatnonzero(places == b)
                        take[here] = fuse.contains(keys[here], *known.value[b])
            rows = np.flatnonzero(take)
            for i in range(0, len(rows), 1024):
                some = rows[i:i + 1024]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(some)), marks.take(pa.array(some)),
                     pa.array([texts[k].decode() for k in some], pa.string())], names=["doc_id", "digest", "text"])

    schema = f"doc_id {tables[0].schema[id_col].dataType.simpleString()}, digest binary, text string"
    return _union([t.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema) for t in tables])


def _differing(repeated: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows whose text is not that of their group's row that stays.

    Texts of one digest are compared by the least and the greatest of them, which tasks reduce before they
    meet; only where these differ are the rows of the digest joined with the row that stays.
    """
    unlike = repeated.groupBy("digest").agg(F.min("text").alias("lo"), F.max("text").alias("hi")).filter("lo <> hi").select("digest")
    at = scratch_dir(repeated.sparkSession, "unlike-digests")
    unlike = _written(repeated.sparkSession, unlike, at)
    if unlike.isEmpty():
        return repeated.select("digest", "doc_id", "text").limit(0)
    repeated = repeated.join(unlike, "digest", "left_semi")
    stays = (repeated.join(groups.select("digest", F.col("last").alias("doc_id")), ["digest", "doc_id"])
             .groupBy("digest").agg(F.min("text").alias("text_of_last")))
    nameless = (repeated.filter("doc_id IS NULL").join(groups.filter("last IS NULL").select("digest"), "digest")
                .groupBy("digest").agg(F.min("text").alias("text_of_last")))
    return (repeated.join(stays.unionByName(nameless), "digest").filter("text <> text_of_last")
            .select("digest", "doc_id", "text"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return spark.read.parquet(path)
