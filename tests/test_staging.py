import os

import pytest
from pyspark.sql import functions as F

from ledgerline.sinks import pointer, snapshots
from ledgerline.sinks.staging import Staging

SCHEMA = "accession string, ticker string, filing_year long"


def bytes_under(root):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def staging(spark, tmp):
    return Staging(tmp, spark.createDataFrame([], SCHEMA).schema)


def rows(spark, n=2000, years=4, companies=50):
    return spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("accession"),
                                 F.concat(F.lit("T"), (F.col("id") % companies).cast("string")).alias("ticker"),
                                 (F.col("id") % years + 2000).alias("filing_year"))


def keys(spark, *tickers):
    return spark.createDataFrame([(t,) for t in tickers], "ticker string")


def test_removal_writes_keys_only(spark, tmp):
    st = staging(spark, tmp)
    st.add(rows(spark))
    before = bytes_under(tmp)
    st.remove(keys(spark, "T1", "T2", "none"))
    after = bytes_under(tmp)
    assert all(after[p] == size for p, size in before.items()), "rows were rewritten"
    new = sum(size for p, size in after.items() if p not in before)
    assert 0 < new < sum(before.values()) / 20
    assert {r.ticker for r in st.read(spark).collect()} == {f"T{i}" for i in range(50) if i not in (1, 2)}
    assert st.read(spark).count() == 1920
    assert st.compact(spark, 0.5) == [] and bytes_under(tmp) == after


def test_worn_partitions_are_rewritten_alone(spark, tmp):
    st = staging(spark, tmp)
    st.add(rows(spark, years=2, companies=10))  # even companies in 2000, odd ones in 2001
    st.remove(keys(spark, "T0", "T2", "T4", "T1"))
    want = sorted(map(tuple, st.read(spark).collect()))
    share = {r.filing_year: (r["rows"], r.dead) for r in st.dead_share(spark).collect()}
    assert share == {2000: (1000, 600), 2001: (1000, 200)}
    before = bytes_under(tmp)
    assert st.compact(spark, 0.5) == [2000]
    new = [p for p in bytes_under(tmp) if p not in before]
    assert new and all("/filing_year=2000/" in p for p in new)
    assert sorted(map(tuple, st.read(spark).collect())) == want
    assert {r.filing_year: r.dead for r in st.dead_share(spark).collect()} == {2000: 0, 2001: 200}
    st.remove(keys(spark, "T6"))  # tombstones hold for rewritten rows too
    assert {r.ticker for r in st.read(spark).collect()} == {"T3", "T5", "T7", "T9", "T8"}


def test_rows_staged_again_stay(spark, tmp):
    st = staging(spark, tmp)
    one = spark.createDataFrame([("1", "A", 2000), ("2", "A", None), ("3", "B", None)], SCHEMA)
    st.add(one)
    st.remove(keys(spark, "A"))
    assert [r.accession for r in st.read(spark).collect()] == ["3"]
    st.add(spark.createDataFrame([("4", "A", 2000)], SCHEMA))
    assert sorted(r.accession for r in st.read(spark).collect()) == ["3", "4"]
    assert sorted(map(str, st.compact(spark, 0.3))) == ["2000", "None"]
    assert sorted(r.accession for r in st.read(spark).collect()) == ["3", "4"]
    st.remove(keys(spark, "A", "B"))
    assert st.read(spark).count() == 0


def test_empty_table(spark, tmp):
    st = staging(spark, tmp)
    assert st.read(spark).count() == 0 and st.version() == 0 and st.compact(spark) == []
    st.remove(keys(spark, "A"))
    assert st.read(spark).count() == 0


def test_of_two_rewrites_one_wins_and_additions_both_hold(spark, tmp, monkeypatch):
    """Between reading a version and publishing, another writer publishes."""
    st = staging(spark, tmp)
    st.add(rows(spark, 200, 2, 4))
    st.remove(keys(spark, "T0", "T2"))
    real, other = pointer.publish, rows(spark, 40, 2, 4).withColumn("ticker", F.lit("late"))

    def raced(spark_, folder, record, after=None):
        monkeypatch.setattr(pointer, "publish", real)
        st.add(other)
        return real(spark_, folder, record, after)

    monkeypatch.setattr(pointer, "publish", raced)
    with pytest.raises(pointer.VersionConflict):
        st.compact(spark, 0.5)
    assert st.read(spark).count() == 100 + 40
    monkeypatch.setattr(pointer, "publish", raced)
    st.remove(keys(spark, "late", "T1"))  # covers what was there when it was made, not what came meanwhile
    assert st.read(spark).groupBy("ticker").count().filter("ticker = 'late'").first()["count"] == 40
    assert [n for n, _ in pointer.versions(f"{tmp}/_versions")] == list(range(1, st.version() + 1))


def test_snapshots_are_ordered_without_a_clock(spark, tmp):
    first = spark.createDataFrame([(1,)], "k long")
    snapshots.publish_snapshot(first, tmp)
    seen = snapshots.current_version(tmp)
    snapshots.publish_snapshot(spark.createDataFrame([(2,)], "k long"), tmp, after=seen)
    with pytest.raises(pointer.VersionConflict):
        snapshots.publish_snapshot(spark.createDataFrame([(3,)], "k long"), tmp, after=seen)
    assert [r.k for r in snapshots.read_current(spark, tmp).collect()] == [2]
