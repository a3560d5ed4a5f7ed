import gzip
import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import archives as A
from ledgerline.operators import runs
from ledgerline.sinks import manifest, pointer
from ledgerline.sinks.archives import FORMAT, register, write_archives
from ledgerline.sources.archives import list_archives, list_files, read_members


def _rows(spark):
    data = []
    for b in (1, 2, 10):
        for t in range(3):
            for k in range(4):
                data.append((f"run_x/sp500_filings_data_{b}.tar",
                             f"sp500_filings_data/T{b}{t}/2001/10-K/{k}.html", f"<html>{b}-{t}-{k}</html>", 1000 + k))
    return spark.createDataFrame(data, "archive string, member string, content string, mtime long")


def test_pack_unpack_round_trip(spark, tmp):
    rows = _rows(spark)
    write_archives(rows, tmp)
    lst = list_archives(spark, os.path.join(tmp, "run_x"))
    assert sorted(r.batch_no for r in lst.collect()) == [1, 2, 10]
    got = read_members(lst).filter("is_file").select("batch_no", "member", F.col("content").cast("string").alias("c"))
    exp = {(int(a.split("_")[-1][:-4]), m, c) for a, m, c, _ in rows.collect()}
    assert {(r.batch_no, r.member, r.c) for r in got.collect()} == exp
    # directories added as a recursive add does (ticker, year, form), not the staging root
    dirs = {r.member for r in read_members(lst, with_content=False).filter("is_dir").collect()}
    assert "sp500_filings_data/T10/2001" in dirs and "sp500_filings_data" not in dirs
    assert _tars(tmp) == {r.path for r in manifest.read_manifest(spark, tmp).collect()}


def _tars(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if ".tar" in f}


def test_archive_bytes_reproducible(spark, tmp):
    a, b = os.path.join(tmp, "a"), os.path.join(tmp, "b")
    write_archives(_rows(spark), a)
    write_archives(_rows(spark).repartition(3), b)
    one, two = ({r.archive: r.path for r in manifest.read_manifest(spark, root).collect()} for root in (a, b))
    assert one.keys() == two.keys() and len(one) == 3
    for name in one:
        with open(one[name], "rb") as x, open(two[name], "rb") as y:
            assert x.read() == y.read()


def test_failed_write_leaves_nothing(spark, tmp):
    bad = _rows(spark).withColumn(
        "content", F.when(F.col("member").endswith("3.html"), F.raise_error(F.lit("boom"))).otherwise(F.col("content")))
    with pytest.raises(Exception):
        write_archives(bad, tmp)
    assert not _tars(tmp) and manifest.read_manifest(spark, tmp) is None


def test_nothing_is_visible_before_publication(spark, tmp):
    """A driver that dies after its tasks leaves files, but no archive; a later job is not disturbed."""
    register(spark)
    rows = _rows(spark).repartition(2, "archive").sortWithinPartitions("archive", "member")
    rows.write.format(FORMAT).mode("append").option("job", "dead").save(tmp)
    run = os.path.join(tmp, "run_x")
    assert len(_tars(tmp)) == 3 and list_archives(spark, run).count() == 0 and list_files(spark, tmp).count() == 0
    job = write_archives(_rows(spark).filter(F.col("archive").endswith("_2.tar")), tmp)
    listed = list_archives(spark, run).collect()
    assert [r.batch_no for r in listed] == [2] and job in listed[0].archive_path
    manifest.publish(spark, tmp, "dead")  # published after all: the later version of batch 2 counts
    listed = {r.batch_no: r.archive_path for r in list_archives(spark, run).collect()}
    assert set(listed) == {1, 2, 10} and all("_job-dead" in path for path in listed.values())


def test_commit_moves_no_file(spark, tmp, monkeypatch):
    """The archives stay where the tasks wrote them: their inodes are older than the manifest's."""
    write_archives(_rows(spark), tmp)
    rows = manifest.read_manifest(spark, tmp).collect()
    assert {r.archive: (r.members, r.files, r.companies, r.listed) for r in rows} == {
        f"run_x/sp500_filings_data_{b}.tar": (3 * (3 + 4), 12, 3, 0) for b in (1, 2, 10)}
    assert all(f"/{manifest.JOB_PREFIX}" in r.path and os.path.getsize(r.path) == r.bytes for r in rows)
    assert not os.path.exists(os.path.join(tmp, "run_x"))


def test_lost_and_damaged_files_are_reported(spark, tmp):
    write_archives(_rows(spark), tmp)
    assert manifest.missing(spark, tmp).count() == 0
    path = {r.archive: r.path for r in manifest.read_manifest(spark, tmp).collect()}
    os.remove(path["run_x/sp500_filings_data_2.tar"])
    open(path["run_x/sp500_filings_data_10.tar"], "wb").write(b"short")
    found = {r.archive: r.found_bytes for r in manifest.missing(spark, tmp).collect()}
    assert found == {"run_x/sp500_filings_data_2.tar": None, "run_x/sp500_filings_data_10.tar": 5}


def test_companies_without_data_are_listed_and_an_empty_batch_is_an_archive(spark, tmp):
    data = [("r/sp500_filings_data_1.tar", None, None), ("r/sp500_filings_data_1.tar", None, None),
            ("r/sp500_filings_data_1.tar", "sp500_filings_data/A/2001/10-K/1.html", "x"), ("r/sp500_filings_data_2.tar", None, None)]
    write_archives(spark.createDataFrame(data, "archive string, member string, content string"), tmp, mtime=None)
    got = {r.archive[-5]: (r.members, r.companies, r.listed, r.bytes) for r in manifest.read_manifest(spark, tmp).collect()}
    assert got == {"1": (4, 1, 2, 10240), "2": (0, 0, 1, 10240)}
    members = read_members(list_archives(spark, os.path.join(tmp, "r")))
    assert members.filter("error IS NOT NULL").count() == 0 and members.filter("is_file").count() == 1


def test_one_of_two_publishers_wins(spark, tmp):
    folder = os.path.join(tmp, "versions")
    assert pointer.newest(folder) == (0, None)
    first = pointer.publish(spark, folder, {"of": "a"})
    assert pointer.publish(spark, folder, {"of": "b"}, after=first) == 2
    with pytest.raises(pointer.VersionConflict):  # made from version 1, which is no longer the newest
        pointer.publish(spark, folder, {"of": "c"}, after=first)
    assert pointer.publish(spark, folder, {"of": "d"}) == 3
    assert [r["of"] for _, r in pointer.versions(folder)] == ["a", "b", "d"] and pointer.newest(folder)[1] == {"of": "d"}
    # the way of Hadoop file systems refuses a taken name as well
    assert pointer._rename(spark, f"file:{folder}/v00000000000000000009.json", b"{}")
    assert not pointer._rename(spark, f"file:{folder}/v00000000000000000009.json", b"[]")
    assert pointer.newest(folder) == (9, {}) and not [f for f in os.listdir(folder) if f.startswith(".") and not f.endswith(".crc")]


def _tar_bytes(members):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as t:
        for name, data in members:
            if data is None:
                info = tarfile.TarInfo(name)
                info.type = tarfile.DIRTYPE
                t.addfile(info)
            else:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    return buf.getvalue()


def test_zero_truncated_compressed_and_unsafe(spark, tmp):
    run = os.path.join(tmp, "run_y")
    os.makedirs(run)
    good = _tar_bytes([("sp500_filings_data/A", None), ("sp500_filings_data/A/x.html", b"abc"),
                       ("/abs/a", b"1"), ("a/../../b", b"2"), ("sp500_filings_data/A/empty.html", b"")])
    open(os.path.join(run, "sp500_filings_data_1.tar"), "wb").write(good)
    open(os.path.join(run, "sp500_filings_data_2.tar"), "wb").write(b"")
    open(os.path.join(run, "sp500_filings_data_3.tar"), "wb").write(good[:700])
    open(os.path.join(run, "sp500_filings_data_4.tar"), "wb").write(gzip.compress(good))
    open(os.path.join(run, "sp500_filings_data_x.tar"), "wb").write(good)
    lst = list_archives(spark, run)
    assert sorted(r.batch_no for r in lst.collect()) == [1, 2, 3, 4]
    m = read_members(lst, with_content=True)
    rep = {r.batch_no: r for r in A.inspect(m, keys=("batch_no",)).collect()}
    assert rep[1].readable and rep[4].readable and rep[1].n_files == 4 and rep[1].n_dirs == 1
    assert not rep[2].readable and not rep[3].readable
    from ledgerline.functions import scalars as S
    unsafe = {r.member for r in m.filter(S.is_unsafe_member("member")).collect()}
    assert unsafe == {"/abs/a", "a/../../b"}
    zero = {r.member for r in m.filter("is_file AND size = 0").collect()}
    assert zero == {"sp500_filings_data/A/empty.html"}


def test_one_archive_is_read_by_many_tasks(spark, tmp, monkeypatch):
    from ledgerline.sources import archives

    data = {f"sp500_filings_data/T/2001/10-K/{i:03}.html": os.urandom(50 + 37 * i) for i in range(120)}
    os.makedirs(os.path.join(tmp, "run_h"))
    open(os.path.join(tmp, "run_h", "sp500_filings_data_1.tar"), "wb").write(_tar_bytes(data.items()))
    lst = list_archives(spark, os.path.join(tmp, "run_h"))
    index = archives.member_index(lst).collect()
    assert len(index) == 120 and all(r.content is None and r.offset % 512 == 0 for r in index)
    for name, value in (("RANGE_BYTES", 20_000), ("READ_BYTES", 3_000), ("READ_GAP", 600), ("CHUNK_BYTES", 9_000)):
        monkeypatch.setattr(archives, name, value)
    got = read_members(lst).select("member", "content", "batch_no", F.spark_partition_id().alias("task")).collect()
    assert {r.member: bytes(r.content) for r in got} == data and {r.batch_no for r in got} == {1}
    assert len({r.task for r in got}) >= 8


def test_a_damaged_tail_fails_alone(spark, tmp):
    data = [(f"sp500_filings_data/T/2001/10-K/{i:02}.html", os.urandom(1000)) for i in range(20)]
    whole = _tar_bytes(data)
    run = os.path.join(tmp, "run_t")
    os.makedirs(run)
    open(os.path.join(run, "sp500_filings_data_1.tar"), "wb").write(whole[:10 * 1536 + 700])  # in the eleventh's content
    open(os.path.join(run, "sp500_filings_data_2.tar"), "wb").write(whole)
    rows = read_members(list_archives(spark, run)).collect()
    good = {(r.batch_no, r.member): bytes(r.content) for r in rows if r.error is None}
    assert good == {(1, n): c for n, c in data[:10]} | {(2, n): c for n, c in data}
    assert {r.batch_no for r in rows if r.error} == {1} and [r.member for r in rows if r.member == data[10][0] and r.batch_no == 1 and r.error]


def test_links_and_sparse_files(spark, tmp):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w", format=tarfile.GNU_FORMAT) as t:
        info = tarfile.TarInfo("sp500_filings_data/A/" + "long" * 60 + ".html")  # a name in a header of its own
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
        link = tarfile.TarInfo("sp500_filings_data/A/link.html")
        link.type, link.linkname = tarfile.SYMTYPE, "elsewhere"
        t.addfile(link)
    run = os.path.join(tmp, "run_l")
    os.makedirs(run)
    open(os.path.join(run, "sp500_filings_data_1.tar"), "wb").write(buf.getvalue())
    got = {r.member.split("/")[-1][:5]: (r.is_file, r.content and bytes(r.content), r.error)
           for r in read_members(list_archives(spark, run)).collect()}
    assert got == {"longl": (True, b"abc", None), "link.": (False, None, None)}


def test_last_writer_later_batch_wins(spark):
    m = spark.createDataFrame([("a/x", 2, "old"), ("a/x", 10, "new"), ("a/y", 2, "only")],
                              "member string, batch_no long, content string")
    out = {r.member: (r.batch_no, r.content) for r in runs.last_writer(m).collect()}
    assert out == {"a/x": (10, "new"), "a/y": (2, "only")}


def test_list_files_prunes_content(spark, tmp):
    open(os.path.join(tmp, "a.tar"), "wb").write(b"x" * 10)
    plan = list_files(spark, tmp)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_parts_belong_to_one_archive(spark, tmp):
    from ledgerline.functions import scalars as S
    from ledgerline.sources.archives import list_files

    rows = _rows(spark).withColumn("archive", F.concat(
        F.lit("run_z/"), A.archive_name(S.ARCHIVE_PREFIX, F.lit(7), A.part_of(F.col("member"), F.lit(1 << 20), 1 << 18))))
    write_archives(rows, tmp)
    parts = list_files(spark, os.path.join(tmp, "run_z"), "*.tar.part*")
    whole = parts.select(A.whole_name(F.col("name")).alias("name")).distinct().select(
        "name", S.batch_no_from_name("name").alias("batch_no")).collect()
    assert parts.count() > 1 and [(r.name, r.batch_no) for r in whole] == [("sp500_filings_data_7.tar", 7)]
    assert read_members(parts).filter("is_file").count() == rows.count()


@pytest.mark.parametrize("key", ["snk_tree_archive", "snk_annual_archive"])
def test_part_size_does_not_change_rows(spark, key):
    from conftest import SF_SMALL
    from ledgerline.plans import archive_queries as Q

    def rows(part_bytes):
        return sorted(map(str, getattr(Q, key)(spark, SF_SMALL, part_bytes=part_bytes).collect()))

    assert rows(40_000) == rows(1 << 40)


def test_html_moves_once(spark):
    """With broadcast off, the text crosses one exchange on its way to the page join and one to its archive."""
    from conftest import SF_SMALL
    from ledgerline.plans import archive_queries as Q

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = Q.with_content(spark, SF_SMALL, Q.staged_keys(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
        # above the join that brings the text there is nothing but projections
        above = plan.split("Join")[0]
        assert "html" in plan and "Aggregate" not in above and "Repartition" not in above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_killed_task_attempt_is_retried_cleanly(tmp):
    import subprocess
    import sys

    here = os.path.dirname(os.path.abspath(__file__))
    r = subprocess.run([sys.executable, os.path.join(here, "retry_job.py"), tmp], capture_output=True, text=True,
                       timeout=600)
    assert "RETRY-OK" in r.stdout, r.stdout[-2000:] + r.stderr[-4000:]


def test_list_tree_distributed_includes_zero_byte_files(spark, tmp):
    from ledgerline.sources.archives import list_tree

    os.makedirs(os.path.join(tmp, "A", "2001", "10-K"))
    os.makedirs(os.path.join(tmp, "B"))
    open(os.path.join(tmp, "A", "2001", "10-K", "x.html"), "w").write("abc")
    open(os.path.join(tmp, "A", "2001", "10-K", "empty.html"), "w").close()
    open(os.path.join(tmp, "B", "z.txt"), "w").write("no")
    open(os.path.join(tmp, "top.html"), "w").write("t")
    got = {(r.name, r.archive_bytes) for r in list_tree(spark, tmp).collect()}
    assert got == {("x.html", 3), ("empty.html", 0), ("top.html", 1)}


def test_extract_tree_last_writer_and_quarantine(spark, tmp):
    from ledgerline.operators.archives import extract_tree

    run = os.path.join(tmp, "run_e")
    os.makedirs(run)
    open(os.path.join(run, "sp500_filings_data_2.tar"), "wb").write(
        _tar_bytes([("sp500_filings_data/A/x.html", b"old"), ("sp500_filings_data/A/y.html", b"y2")]))
    open(os.path.join(run, "sp500_filings_data_10.tar"), "wb").write(
        _tar_bytes([("sp500_filings_data/A/x.html", b"new"), ("../evil.html", b"no"), ("/abs.html", b"no")]))
    out = os.path.join(tmp, "out")
    rep = {r.batch_no: r for r in extract_tree(read_members(list_archives(spark, run)), out).collect()}
    assert open(os.path.join(out, "sp500_filings_data/A/x.html"), "rb").read() == b"new"   # batch 10 wins
    assert open(os.path.join(out, "sp500_filings_data/A/y.html"), "rb").read() == b"y2"
    assert not os.path.exists(os.path.join(tmp, "evil.html")) and not os.path.exists(os.path.join(out, "abs.html"))
    assert (rep[10].n_written, rep[10].n_quarantined) == (1, 2) and (rep[2].n_written, rep[2].n_quarantined) == (1, 0)


def test_list_single_batch_and_zero_is_not_all(spark, tmp):
    write_archives(_rows(spark), tmp)
    run = os.path.join(tmp, "run_x")
    assert [r.batch_no for r in list_archives(spark, run, batch_no=10).collect()] == [10]
    assert list_archives(spark, run, batch_no=0).count() == 0          # only None means all (D11)
    assert list_archives(spark, run).count() == 3


def test_reader_plan_spreads_archives_without_join_back(spark, tmp):
    write_archives(_rows(spark), tmp)
    m = read_members(list_archives(spark, os.path.join(tmp, "run_x")))
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "Join" not in plan
    assert "REPARTITION_BY_NUM" in plan          # an explicit spread AQE will not coalesce


def test_rejected_archive_names_are_reported(spark, tmp):
    from ledgerline.sources.archives import rejected_archives

    for n in ("sp500_filings_data_3.tar", "sp500_filings_data_x.tar", "sp500_filings_data_x_4.tar", "other_1.tar"):
        open(os.path.join(tmp, n), "wb").write(_tar_bytes([("sp500_filings_data/A", None)]))
    assert {r.name for r in rejected_archives(spark, tmp).collect()} == {"sp500_filings_data_x.tar"}
    assert sorted(r.batch_no for r in list_archives(spark, tmp).collect()) == [3, 4]


def _one_archive(tmp, members, mtime=1000):
    """Written by the sink's writer itself: the bytes, and what this process held at most meanwhile."""
    import tracemalloc

    import pyarrow as pa
    from ledgerline.sinks.archives import TarArchiveWriter

    def batches(rows=2000):
        for at in range(0, len(members), rows):
            names, content = zip(*members[at:at + rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array(["r/x.tar"] * len(names)), pa.array(names), pa.array(content, pa.binary()), pa.array([mtime] * len(names))],
                names=["archive", "member", "content", "mtime"])

    tracemalloc.start()
    try:
        done = TarArchiveWriter({"path": tmp, "job": "j"}, "j").write(batches())
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    return done.entries[0], held


def test_writer_memory_does_not_follow_the_members(tmp):
    small = [(f"s/T{i:06}/2001/10-K/{i}.html", b"x") for i in range(2000)]
    large = [(f"s/T{i:06}/2001/10-K/{i}.html", b"x") for i in range(16000)]
    one, few = _one_archive(os.path.join(tmp, "a"), small)
    two, many = _one_archive(os.path.join(tmp, "b"), large)
    assert (one[3], two[3]) == (4 * 2000, 4 * 16000) and many < 1.5 * few


def test_archives_are_those_of_tarfile(tmp):
    """Odd names, explicit directories and times outside the header's field, byte for byte as tarfile adds them."""
    members = sorted([("s/a", None), ("s/a!x", b"1"), ("s/a-b/c.html", b""), ("s/a/b.html", b"22"), ("s/a/c/d.html", b"3" * 512),
                      ("s/é/ü.html", "é".encode()), ("s/" + "long/" * 30 + "x.html", b"y"), ("s/" + "n" * 97, None), ("s/" + "m" * 98, b"z")])
    for mtime in (1000, -5):
        entry, _ = _one_archive(os.path.join(tmp, str(mtime)), members, mtime)
        buf, seen = io.BytesIO(), set()
        with tarfile.open(fileobj=buf, mode="w|", format=tarfile.PAX_FORMAT) as t:
            for name, data in members:
                parts = name.split("/")
                for d in ["/".join(parts[:i]) for i in range(2, len(parts))] + [name] * (data is None):
                    if d not in seen:
                        info = tarfile.TarInfo(d)
                        info.type, info.mode, info.mtime = tarfile.DIRTYPE, 0o755, mtime
                        t.addfile(info)
                        seen.add(d)
                if data is not None:
                    info = tarfile.TarInfo(name)
                    info.size, info.mode, info.mtime = len(data), 0o644, mtime
                    t.addfile(info, io.BytesIO(data))
        with open(entry[1], "rb") as f:
            assert f.read() == buf.getvalue() and entry[2] == len(buf.getvalue())


def test_contents_read_are_let_go_and_small_archives_share_a_chunk(tmp):
    import tracemalloc

    import pandas as pd
    import pyarrow as pa
    from ledgerline.sources import archives

    size, n = 1 << 20, 96
    at = os.path.join(tmp, "x.tar")
    open(at, "wb").write(_tar_bytes([(f"s/{i:03}", os.urandom(size)) for i in range(n)]))
    listing = pd.DataFrame({"archive_path": [at] * 3, "batch_no": [1, 2, 3]})
    index = list(archives._index(["batch_no"])(iter([listing])))
    assert len(index) == 1 and list(index[0]["batch_no"]) == [1] * n + [2] * n + [3] * n
    fields = [("archive_path", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("content", pa.binary()), ("error", pa.string())]
    batch = pa.RecordBatch.from_pylist(
        [{"archive_path": at, "offset": int(o), "size": size} for o in index[0]["offset"][:n]], schema=pa.schema(fields))
    tracemalloc.start()
    rows, before = 0, pa.total_allocated_bytes()
    for part in archives._read_ranges(iter([batch])):
        rows += part.num_rows
        del part
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n and held < 64 * size and pa.total_allocated_bytes() - before < size


@pytest.mark.parametrize("key", ["snk_annual_archive", "src_archive_unpack", "snk_batch_archive"])
def test_packing_by_several_jobs_gives_the_same_archives(spark, key, monkeypatch):
    """Archives packed by three jobs, each with whole archives: the same rows, and no shuffle of all contents."""
    from conftest import SF_SMALL
    from ledgerline.plans import archive_queries as Q

    def rows():
        return sorted(map(str, getattr(Q, key)(spark, SF_SMALL).collect()))

    want, jobs, write = rows(), [], Q.write_archives
    monkeypatch.setattr(Q, "PACK_BYTES", 10_000)
    monkeypatch.setattr(Q, "PACK_JOBS", 3)
    monkeypatch.setattr(Q, "write_archives", lambda df, *a, **k: jobs.append({r.archive for r in df.select("archive").collect()}) or write(df, *a, **k))
    assert rows() == want
    assert len(jobs) == 3 and all(not (a & b) for i, a in enumerate(jobs) for b in jobs[:i])


@pytest.mark.parametrize("key", ["src_tree_scan", "qa_zero_length"])
def test_a_scanned_tree_is_on_disk_in_shares(spark, key, monkeypatch):
    """All files are written and found whatever the share, a share holds a part of them, and none is left."""
    from conftest import SF_SMALL
    from ledgerline.plans import archive_queries as Q
    from ledgerline.session import checkpoint_root, local_path

    held, scan = [], Q.list_tree

    def watched(spark, root, pattern):
        if "/tree-files-" in root:
            held.append(sum(len(fs) for _, _, fs in os.walk(local_path(root))))
        return scan(spark, root, pattern)

    monkeypatch.setattr(Q, "list_tree", watched)
    rows = lambda: sorted(map(str, getattr(Q, key)(spark, SF_SMALL).collect()))
    whole, (n, *_) = rows(), held
    held.clear()
    monkeypatch.setattr(Q, "TREE_FILES", 50)
    assert rows() == whole and len(held) == -(-n // 50) and sum(held) == n and max(held) < n // 2
    assert not [f for d, _, fs in os.walk(f"{local_path(checkpoint_root(spark))}/ledgerline-scratch") if "/tree-files-" in d for f in fs]


def _tar(names, fmt=tarfile.PAX_FORMAT, content=b"x" * 700):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=fmt) as t:
        for k, name in enumerate(names):
            info = tarfile.TarInfo(name)
            info.mtime = 1000 + k
            if name.endswith("/"):
                info.type = tarfile.DIRTYPE
                t.addfile(info)
            else:
                info.size = 0 if k % 5 == 0 else len(content) * (k % 40 if k % 7 == 0 else 1)
                t.addfile(info, io.BytesIO(content * 40))
    return out.getvalue()


def _indexed(paths):
    import pandas as pd

    from ledgerline.sources import archives

    listing = pd.DataFrame({"archive_path": paths, "batch_no": list(range(len(paths)))})
    return [tuple(None if v is pd.NA or v != v else v for v in row)
            for pdf in archives._index(["batch_no"])([listing]) for row in pdf.itertuples(index=False)]


def test_usual_headers_are_read_without_tarfile(tmp, monkeypatch):
    """Members of every kind of archive, whole or cut anywhere, are those that ``tarfile`` finds; the usual ones
    without its steps."""
    from ledgerline.sources import archives

    usual = ["root/T/", "root/T/2001/"] + [f"root/T/2001/{k}.html" for k in range(60)]
    kinds = [_tar(usual), _tar(usual, tarfile.GNU_FORMAT), _tar(usual, tarfile.USTAR_FORMAT), _tar([]),
             _tar(usual[:5] + ["root/" + "long/" * 30 + "name", "root/\u00fc.html"] + usual[5:9]),
             _tar(usual[:3] + ["root/" + "l" * 60 + "/" + "m" * 60] + usual[5:9], tarfile.USTAR_FORMAT)]
    wrong = bytearray(kinds[0])
    wrong[2048 + 10] ^= 1
    few = _tar(usual[:6])
    kinds += [bytes(wrong), kinds[0] + kinds[0], *(few[:n] for n in range(0, len(few) + 1, 171)), *(few[:512 * n] for n in range(1, 20))]
    paths = []
    for k, data in enumerate(kinds):
        paths.append(f"{tmp}/{k}.tar")
        with open(paths[-1], "wb") as f:
            f.write(data)
    got = _indexed(paths)
    steps = []
    step = tarfile.TarInfo.frombuf.__func__
    monkeypatch.setattr(tarfile.TarInfo, "frombuf", classmethod(lambda cls, *a: steps.append(1) or step(cls, *a)))
    assert len(_indexed(paths[:1])) == len(usual) and len(steps) <= 2  # the end
    monkeypatch.setattr(archives, "_usual", lambda raw, size: [(None, None, None, None, 0)])
    assert got == _indexed(paths)
    assert sum(e is not None for *_, e, _, _ in got) > 40


def test_staged_filings_are_found_once(spark):
    """Ranks, sums and packing read the stored filings, not the orders and pages again."""
    from conftest import SF_SMALL
    from ledgerline.plans import archive_queries as Q

    read = Q.staged_keys(spark, SF_SMALL).inputFiles()
    assert read and not [f for f in read if "orders.parquet" in f or "pages.parquet" in f]


def test_small_members_share_a_write():
    """Headers, contents and fill of small members go to the file together, and are counted as written."""
    from ledgerline.sinks import archives

    class Sink:
        def __init__(self):
            self.writes, self.size = 0, 0

        def create_dir(self, *args, **kwargs):
            pass

        def open_output_stream(self, *args, **kwargs):
            return self

        def write(self, data):
            self.writes, self.size = self.writes + 1, self.size + len(data)

        def close(self):
            pass

    sink = Sink()
    a = archives._Archive(sink, "x/x.tar", "x.tar", "x/x.tar")
    for k in range(5000):
        m = f"s/T{k // 10:04}/2001/{k % 10}/{k}.html"
        a.add_parents(m, 1, 1000)
        a.add_file(m, 1000, b"x" * (k % 700))
    entry = a.close()
    assert entry[2] == sink.size and entry[3] == 5000 + 500 * 2 + 5000 and entry[6] == 500
    assert sink.writes < 20


@pytest.mark.parametrize("size", [1, 100, 255, 256])
def test_byte_sums(size):
    from ledgerline.sinks.archives import byte_sum

    for block in (b"\xff" * size, b"\0" * size, os.urandom(size)):
        assert byte_sum(block) == sum(block)


def test_headers_of_many_forms(tmp):
    from ledgerline.sources import archives

    buf = io.BytesIO()
    n = 3 * archives.KNOWN_FORMS
    with tarfile.open(fileobj=buf, mode="w", format=tarfile.PAX_FORMAT) as t:
        for i in [*range(n), *range(n)]:
            info = tarfile.TarInfo(f"r/{i}")
            info.uname, info.mode, info.size = f"owner{i}", i % 512, i
            t.addfile(info, io.BytesIO(b"\xff" * i))
    at = f"{tmp}/forms.tar"
    with open(at, "wb") as f:
        f.write(buf.getvalue())
    with open(at, "rb") as f, tarfile.open(at) as t:
        raw = type("Raw", (), {"read_at": staticmethod(lambda n, at: (f.seek(at), f.read(n))[1])})
        got = [r for r in archives._usual(raw, len(buf.getvalue())) if r[0] is not None]
        assert got == [(m.name, True, m.size, m.mtime, m.offset_data) for m in t.getmembers()] and len(got) == 2 * n


@pytest.mark.parametrize("key", ["snk_tree_archive", "snk_annual_archive"])
def test_a_small_company_is_in_one_part(spark, key, monkeypatch):
    """Its directories are written once, however many parts there are; a large company is spread over parts."""
    from conftest import SF_SMALL
    from ledgerline.plans import archive_queries as Q

    listed, part_bytes = [], 120_000
    monkeypatch.setattr(Q, "list_files", lambda *args: listed.append(list_files(*args)) or listed[-1])
    getattr(Q, key)(spark, SF_SMALL, part_bytes=part_bytes).count()
    files = [r.asDict() for r in read_members(listed[0], with_content=False).filter("is_file").select("name", "member", "size").collect()]
    held, parts = {}, {}
    for f in files:
        archive, company = f["name"].rsplit(".part", 1)[0], f["member"].split("/")[1]
        held[archive, company] = held.get((archive, company), 0) + f["size"]
        parts.setdefault((archive, company), set()).add(f["name"])
    small = [c for c, size in held.items() if size * A.PIECES_PER_PART <= part_bytes]
    assert len({f["name"] for f in files}) > len({a for a, _ in held}) and len([c for c in small if len(parts[c]) > 1]) == 0
    assert small and any(len(p) > 1 for p in parts.values())
