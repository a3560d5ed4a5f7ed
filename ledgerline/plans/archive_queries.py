"""Archive round trips: staged filings packed into batch, tree and annual archives by Spark
jobs, listed, unpacked and inspected, each compared with SQL over the staged table (tar sizes
follow from the 512-byte block layout)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import archives as A
from ledgerline.operators import runs
from ledgerline.plans.registry import query
from ledgerline.plans.run_queries import _BATCHES_SQL, batches
from ledgerline.session import partitions_for_size, scratch_dir, short_lived_shuffles
from ledgerline.sinks import manifest
from ledgerline.sinks.archives import WRITER_TASK_BYTES, remove_tree, write_archives, write_tree
from ledgerline.sinks.snapshots import append_rows, write_snapshot
from ledgerline.sources import fixtures as X
from ledgerline.sources.archives import list_archives, list_files, list_tree, read_members, rejected_archives

RUN_ID = "run_20240101_000000"
B = X.BATCH_SIZE
# Part sizes of the archives that grow with the corpus (a run's tree, a year); results do not depend on them.
TREE_PART_BYTES = 1 << 30
ANNUAL_PART_BYTES = 1 << 30
# Files and bytes of a tree that are on disk at a time, where a tree is written only to be scanned; no result
# depends on them. A file and the folders that hold it take blocks of their own, whatever its size.
TREE_FILES = 200_000
TREE_BYTES = 2 << 30
# Contents whose shuffle is on disk at a time beside the archives, and how many jobs a packing becomes for that at
# most, as each reads the pages; no result depends on them.
PACK_BYTES = 4 << 30
PACK_JOBS = 4
DAMAGED_BYTES = 700  # fixture: a batch archive cut after one header and part of the next
LOST_EVERY = 5  # fixture: batches whose archive was never written
UNSAFE_EVERY = 97  # fixture: these filings are packed under a name that climbs out with '../'

_ARCHIVE_SQL = """
, tb AS (
  SELECT ticker, CAST((row_number() OVER (ORDER BY CAST(substr(ticker, 2) AS BIGINT), ticker) - 1) // 12 + 1 AS BIGINT) AS batch_no
  FROM (SELECT DISTINCT ticker FROM staged)
), am AS (
  SELECT t.batch_no, 'sp500_filings_data/' || f.rel_path AS member, true AS is_file, false AS is_dir,
         CAST(f.size AS BIGINT) AS size, s.body_md5 AS content_md5, f.ticker, f.filing_year
  FROM files f JOIN tb t ON t.ticker = f.ticker JOIN staged s ON s.k = f.k
  UNION ALL
  SELECT DISTINCT t.batch_no, 'sp500_filings_data/' || f.ticker, false, true, CAST(0 AS BIGINT), NULL, f.ticker, NULL
  FROM files f JOIN tb t ON t.ticker = f.ticker
  UNION ALL
  SELECT DISTINCT t.batch_no, 'sp500_filings_data/' || f.ticker || '/' || CAST(f.filing_year AS VARCHAR), false, true,
         CAST(0 AS BIGINT), NULL, f.ticker, f.filing_year
  FROM files f JOIN tb t ON t.ticker = f.ticker
  UNION ALL
  SELECT DISTINCT t.batch_no, 'sp500_filings_data/' || f.ticker || '/' || CAST(f.filing_year AS VARCHAR) || '/' || replace(f.form, '/', '%2F'),
         false, true, CAST(0 AS BIGINT), NULL, f.ticker, f.filing_year
  FROM files f JOIN tb t ON t.ticker = f.ticker
), ab AS (
  SELECT batch_no, CAST(ceil((sum(512 + ceil(size / 512.0) * 512) + 1024) / 10240.0) * 10240 AS BIGINT) AS archive_bytes
  FROM am GROUP BY batch_no
)
"""


def staged_keys(spark, d):
    """Staged filings with their batch (12 companies per batch in list order), member name, body
    size and mtime. Keys and sizes only: whatever decides archives and parts happens here. The filings are found
    once and stored, as ranks, sums and the packing itself read them again."""
    st = X.staged(spark, d).select("k", "ticker", "filing_year", "form", "accession", "body_bytes", "filed_at")
    st = write_snapshot(st, scratch_dir(spark, "staged"))
    tb = A.company_batches(st, B, order=F.expr("substring(ticker, 2)").cast("bigint"))
    rows = st.join(tb, "ticker")
    path = S.rel_path("ticker", "filing_year", "form", "accession")
    return rows.select("k", "ticker", "filing_year", "batch_no", "body_bytes", S.member_name(path).alias("member"),
                       path.alias("rel_path"), A.epoch_seconds(F.col("filed_at")).alias("mtime"))


def with_content(spark, d, rows):
    """The text joins last; the writer then moves it once, to the task of its archive."""
    return X.attach_html(rows, spark, d).withColumnRenamed("html", "content")


def _written(spark, d, rows, root, part_bytes=WRITER_TASK_BYTES, named=None):
    """Write the archives of ``rows`` (with an ``archive`` column), and those that ``named`` only names: tasks sized from
    known sizes. Many contents are packed by several jobs, each with whole archives, so that on disk are the archives
    and the shuffle of one job."""
    total = rows.agg(F.sum("body_bytes")).first()[0] or 0
    n = max(1, min(PACK_JOBS, -(-total // PACK_BYTES)))
    columns = ["archive", "member", "content", "mtime"]
    if n > 1:  # found once for all jobs
        rows = write_snapshot(rows.select("k", "archive", "member", "mtime"), scratch_dir(spark, "packed"))
    for i in range(n):
        own = F.lit(True) if n == 1 else F.pmod(F.xxhash64("archive"), F.lit(n)) == i
        with short_lived_shuffles(spark):
            content = with_content(spark, d, rows.filter(own)).select(*columns)
            if named is not None:
                content = content.unionByName(named.filter(own))
            write_archives(content, root, num_partitions=partitions_for_size(spark, total // n, part_bytes))


def pack_batches(spark, d) -> str:
    """Write one archive per batch under <scratch>/<run_id>/ and return the run folder."""
    root = scratch_dir(spark, "runs")
    rows = staged_keys(spark, d).withColumn(
        "archive", F.concat(F.lit(RUN_ID + "/"), A.archive_name(S.ARCHIVE_PREFIX, F.col("batch_no"))))
    _written(spark, d, rows, root)
    return f"{root}/{RUN_ID}"


def scanned_tree(spark, d, rows):
    """Every row's file (``k``, ``member``, ``mtime``, ``body_bytes``) written as a real file of a tree and the tree
    listed by ``list_tree``: the files found, with their path below the tree's root (``rel_path``).

    The tree goes through the disk in shares of the pages. Each share's files are written, listed, and removed
    when the listing is stored, so what is on disk does not grow with the table, and each page moves once."""
    root, keys, found = (scratch_dir(spark, tag) for tag in ("tree-files", "tree-keys", "tree-listing"))
    rows = rows.select("k", "member", "mtime", "body_bytes", X.page_of(spark, d).alias("_page"))
    rows = write_snapshot(rows, keys)
    size = rows.agg(F.count(F.lit(1)).alias("files"), F.sum("body_bytes").alias("bytes")).first()
    n = max(1, -(-size["files"] // TREE_FILES), -(-(size["bytes"] or 0) // TREE_BYTES))
    for i in range(n):
        tree = f"{root}/{i}"
        part = rows.filter(X.page_share(F.col("_page"), n) == i).select("k", "member", "mtime")
        write_tree(X.attach_html(part, spark, d, share=(i, n)), tree, content="html")
        below = F.element_at(F.split("archive_path", f"/{root.rsplit('/', 1)[-1]}/{i}/"), -1)
        files = append_rows(list_tree(spark, tree, "*.html").withColumn("rel_path", below), found)
        remove_tree(spark, tree)
    return files


def _listing(spark, d):
    return list_archives(spark, pack_batches(spark, d))


_RUNS_SQL = _BATCHES_SQL + """
, made AS (SELECT * FROM batches{where})
, rb AS (
  SELECT ticker, run_id, batch_no FROM (
    SELECT ticker, run_id, batch_no, row_number() OVER (PARTITION BY ticker ORDER BY run_id, batch_no, seq) AS nth FROM made)
  WHERE nth = 1
), rm AS (
  SELECT r.run_id, r.batch_no, f.ticker, f.rel_path AS name, f.size FROM files f JOIN rb r ON r.ticker = f.ticker
  UNION ALL
  SELECT DISTINCT r.run_id, r.batch_no, f.ticker, unnest([f.ticker, f.ticker || '/' || CAST(f.filing_year AS VARCHAR),
         f.ticker || '/' || CAST(f.filing_year AS VARCHAR) || '/' || replace(f.form, '/', '%2F')]), 0
  FROM files f JOIN rb r ON r.ticker = f.ticker
), rp AS (
  SELECT run_id, batch_no, sum(512 + ceil(size / 512.0) * 512) AS packed, count(DISTINCT ticker) AS n_companies
  FROM rm GROUP BY run_id, batch_no
), ra AS (
  SELECT b.run_id, b.batch_no, CAST(b.n_listed AS BIGINT) AS n_listed, CAST(coalesce(p.n_companies, 0) AS BIGINT) AS n_companies,
         CAST(ceil((coalesce(p.packed, 0) + 1024) / 10240.0) * 10240 AS BIGINT) AS archive_bytes
  FROM (SELECT run_id, batch_no, count(*) AS n_listed FROM made GROUP BY run_id, batch_no) b
  LEFT JOIN rp p ON p.run_id = b.run_id AND p.batch_no = b.batch_no
)
"""
# the data of a batch that was lost stays in staging, and goes with the next batch that lists the company
_LOST_SQL = _RUNS_SQL.format(where=" WHERE batch_no % 5 <> 0")
_RUNS_SQL = _RUNS_SQL.format(where="")


def pack_runs(spark, d, lost=False) -> str:
    """Write every run's archives under <scratch>/<run_id>/ and return the folder of runs: the batches of
    ``win_batch_assign``, each with the data of the companies that it is the first to list. A company
    without data is left out of the archive but listed. ``lost``: the fixture's failed batches have none, and
    their data stays in staging for the next batch that lists the company."""
    root = scratch_dir(spark, "runs")
    listed = batches(spark, d).select("run_id", "batch_no", "ticker")
    if lost:
        listed = listed.filter(F.col("batch_no") % LOST_EVERY != 0)
    listed = write_snapshot(listed, scratch_dir(spark, "batches"))
    name = F.concat("run_id", F.lit("/"), A.archive_name(S.ARCHIVE_PREFIX, F.col("batch_no"))).alias("archive")
    path = S.rel_path("ticker", "filing_year", "form", "accession")
    rows = X.staged(spark, d).join(runs.archived_with(listed), "ticker").select(
        "k", "body_bytes", name, S.member_name(path).alias("member"), A.epoch_seconds(F.col("filed_at")).alias("mtime"))
    named = listed.select(name, *(F.lit(None).cast(t).alias(c) for c, t in (("member", "string"), ("content", "string"),
                                                                            ("mtime", "bigint"))))
    _written(spark, d, rows, root, named=named)
    return root


def packed_batches(spark, root):
    """The published archives under a folder of runs, with run and batch number from their names."""
    rows = manifest.read_manifest(spark, root)
    return rows.select("*", F.split("archive", "/")[0].alias("run_id"), F.element_at(F.split("archive", "/"), -1).alias("name")
                       ).withColumn("batch_no", S.batch_no_from_name("name"))


@query("snk_batch_archive", _RUNS_SQL + """
SELECT run_id, batch_no, 'sp500_filings_data_' || CAST(batch_no AS VARCHAR) || '.tar' AS name, archive_bytes,
       archive_bytes / (1024.0 * 1024.0) AS size_mb, n_listed, n_companies
FROM ra
""")
def snk_batch_archive(spark, d):
    """Each run's successes, in completion order, packed into archives of 12 companies, the rest as the last;
    returns what the manifest says of each: size, companies listed, and companies that had data."""
    p = packed_batches(spark, pack_runs(spark, d))
    return p.select("run_id", "batch_no", "name", F.col("bytes").alias("archive_bytes"), S.size_mb("bytes").alias("size_mb"),
                    F.col("listed").alias("n_listed"), F.col("companies").alias("n_companies"))


@query("agg_batch_plan", _LOST_SQL + """
SELECT s.run_id, CAST(s.n_success AS BIGINT) AS n_success, CAST(s.n_success // 12 AS BIGINT) AS full_batches,
       CAST(s.n_success % 12 AS BIGINT) AS remainder,
       CAST(s.n_success // 12 + CASE WHEN s.n_success % 12 > 0 THEN 1 ELSE 0 END AS BIGINT) AS expected_batches,
       CAST(coalesce(a.nb, 0) AS BIGINT) AS n_batches
FROM (SELECT run_id, count(*) FILTER (WHERE ok) AS n_success FROM completion GROUP BY run_id) s
LEFT JOIN (SELECT run_id, count(*) AS nb FROM ra GROUP BY run_id) a ON a.run_id = s.run_id
""")
def agg_batch_plan(spark, d):
    """Expected batches of each run against the archives that are there (the fixture lost some)."""
    return runs.batch_plan(X.completion(spark, d), packed_batches(spark, pack_runs(spark, d, lost=True)), B)


@query("agg_status_by_run", _LOST_SQL + """
SELECT run_id, CAST(count(*) AS BIGINT) AS n_archives, CAST(sum(n_listed) AS BIGINT) AS n_listed,
       CAST(sum(n_companies) AS BIGINT) AS n_companies, CAST(sum(archive_bytes) AS BIGINT) AS total_bytes
FROM ra GROUP BY run_id
""")
def agg_status_by_run(spark, d):
    """Per run: the archives that are there (the fixture lost some), companies listed and packed, and bytes."""
    p = packed_batches(spark, pack_runs(spark, d, lost=True))
    return p.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_archives"), F.sum("listed").alias("n_listed"), F.sum("companies").alias("n_companies"),
        F.sum("bytes").alias("total_bytes"))


@query("src_archive_list", _ARCHIVE_SQL + """
SELECT 'sp500_filings_data_' || CAST(batch_no AS VARCHAR) || '.tar' AS name, batch_no, archive_bytes, 'run_20240101_000000' AS run_id
FROM ab
""")
def src_archive_list(spark, d):
    return _listing(spark, d).select("name", "batch_no", "archive_bytes", "run_id")


@query("srt_archives", _ARCHIVE_SQL + """
SELECT 'sp500_filings_data_' || CAST(batch_no AS VARCHAR) || '.tar' AS name, batch_no,
       CAST(row_number() OVER (ORDER BY batch_no) AS BIGINT) AS position
FROM ab
""")
def srt_archives(spark, d):
    """Archives in numeric batch order (``_10`` after ``_9``), as an exact rank."""
    from ledgerline.operators.ranking import ordered_rank

    lst = _listing(spark, d).select("name", "batch_no")
    return ordered_rank(lst, ["batch_no", "name"], rank_col="position")


@query("src_archive_unpack", _ARCHIVE_SQL + "SELECT batch_no, member, is_file, is_dir, size, content_md5 FROM am")
def src_archive_unpack(spark, d):
    """Every member of every archive of the run, with its content digest."""
    m = read_members(_listing(spark, d), with_content=True)
    return m.select("batch_no", "member", "is_file", "is_dir", "size",
                    F.when(F.col("is_file"), F.md5("content")).alias("content_md5"))


@query("src_archive_pick", _ARCHIVE_SQL + "SELECT batch_no, member, size, content_md5 FROM am WHERE batch_no = 2 AND is_file")
def src_archive_pick(spark, d):
    """The files of one chosen batch (here the second): only its archive is opened."""
    m = read_members(list_archives(spark, pack_batches(spark, d), batch_no=2), with_content=True).filter("is_file")
    return m.select("batch_no", "member", "size", F.md5("content").alias("content_md5"))


@query("qa_unsafe_members", _ARCHIVE_SQL + """
SELECT t.batch_no,
       CASE WHEN f.k % 97 = 0 THEN '../' ELSE '' END || 'sp500_filings_data/' || f.rel_path AS member,
       f.k % 97 = 0 AS unsafe
FROM files f JOIN tb t ON t.ticker = f.ticker
""")
def qa_unsafe_members(spark, d):
    """Archives of the batches in which some members climb out of the target folder ('../'),
    packed, read back, and every file member flagged: absolute or '..' names are quarantined by
    the extractor instead of being written."""
    root = scratch_dir(spark, "unsafe")
    rows = staged_keys(spark, d)
    rows = rows.withColumn("member", F.when(F.col("k") % UNSAFE_EVERY == 0, F.concat(F.lit("../"), F.col("member")))
                           .otherwise(F.col("member")))
    rows = rows.withColumn("archive", F.concat(F.lit(RUN_ID + "/"), A.archive_name(S.ARCHIVE_PREFIX, F.col("batch_no"))))
    _written(spark, d, rows, root)
    m = read_members(list_archives(spark, f"{root}/{RUN_ID}"), with_content=False).filter(F.col("is_file"))
    return m.select("batch_no", "member", S.is_unsafe_member("member").alias("unsafe"))


@query("agg_archive_inspect", _ARCHIVE_SQL + """
SELECT a.batch_no, ab.archive_bytes, a.n_members, a.n_files, a.n_dirs, a.n_companies, a.companies_text, true AS readable
FROM (SELECT batch_no, CAST(count(*) AS BIGINT) AS n_members, CAST(count(*) FILTER (WHERE is_file) AS BIGINT) AS n_files,
             CAST(count(*) FILTER (WHERE is_dir) AS BIGINT) AS n_dirs, CAST(count(DISTINCT ticker) AS BIGINT) AS n_companies,
             array_to_string(list_slice(list_sort(list(DISTINCT ticker)), 1, 5), ', ')
               || CASE WHEN count(DISTINCT ticker) > 5 THEN '...' ELSE '' END AS companies_text
      FROM am GROUP BY batch_no) a JOIN ab ON ab.batch_no = a.batch_no
UNION ALL
SELECT CAST(0 AS BIGINT), CAST(700 AS BIGINT), CAST(1 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT), CAST(1 AS BIGINT),
       split_part(min(member), '/', 2), false
FROM am WHERE batch_no = 1 AND is_file
""")
def agg_archive_inspect(spark, d):
    """Per archive: size, members, files, directories, companies and the first five names,
    read from the member headers only (no content is copied). The damaged archive (batch 0) is
    reported as unreadable with what could be read before the cut."""
    run = pack_batches(spark, d)
    listing = list_archives(spark, run).unionByName(list_archives(spark, damaged_run(spark, run)))
    return A.inspect(read_members(listing, with_content=False)).drop("archive_path")


@query("agg_archive_totals", _ARCHIVE_SQL + """
SELECT 'run_20240101_000000' AS run_id, CAST(count(*) AS BIGINT) AS n_archives, CAST(sum(archive_bytes) AS BIGINT) AS total_bytes,
       sum(archive_bytes) / (1024.0 * 1024.0) AS total_mb
FROM ab
""")
def agg_archive_totals(spark, d):
    lst = _listing(spark, d)
    return lst.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_archives"), F.sum("archive_bytes").cast("bigint").alias("total_bytes"),
        S.size_mb(F.sum("archive_bytes")).alias("total_mb"))


def damaged_run(spark, run) -> str:
    """A sibling run folder holding one damaged archive: a copy of batch 1 cut after 700 bytes
    (one member header and part of the next), named as batch 0."""
    from ledgerline.sinks.archives import filesystem

    damaged = f"{scratch_dir(spark, 'damaged')}/{RUN_ID}"
    fs, src = filesystem(list_archives(spark, run, batch_no=1).first()["archive_path"])
    with fs.open_input_stream(src) as f:
        head = f.read(DAMAGED_BYTES)
    dfs, dst = filesystem(f"{damaged}/{S.ARCHIVE_PREFIX}0.tar")
    dfs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
    with dfs.open_output_stream(dst) as out:
        out.write(head)
    return damaged


@query("agg_extract_summary", _ARCHIVE_SQL + """
SELECT CAST(count(*) + 1 AS BIGINT) AS n_archives, CAST(count(*) AS BIGINT) AS n_extracted, CAST(1 AS BIGINT) AS n_failed
FROM ab
""")
def agg_extract_summary(spark, d):
    """Archives extracted and failed: the run's archives plus one damaged archive (a truncated
    copy of batch 1, in a sibling run folder). A failure is per archive; the others go on."""
    run = pack_batches(spark, d)
    listing = list_archives(spark, run).unionByName(list_archives(spark, damaged_run(spark, run)))
    m = read_members(listing, with_content=False)
    per = m.groupBy("archive_path").agg(F.count_if(F.col("error").isNotNull()).alias("errors"))
    return per.agg(F.count(F.lit(1)).alias("n_archives"), F.count_if(F.col("errors") == 0).alias("n_extracted"),
                   F.count_if(F.col("errors") > 0).alias("n_failed"))


@query("snk_tree_archive", _ARCHIVE_SQL + "SELECT DISTINCT member, is_file, size, content_md5 FROM am")
def snk_tree_archive(spark, d, part_bytes=TREE_PART_BYTES):
    """The whole staged tree of a run as one archive, in parts by company (a large one's members are spread) so that
    no single task packs everything; read back over all parts (directories of large companies repeat across them)."""
    root = scratch_dir(spark, "tree")
    rows = A.part_keys(staged_keys(spark, d), part_bytes)
    total = F.lit(rows.agg(F.sum("body_bytes")).first()[0])
    rows = rows.withColumn("archive", A.archive_name(RUN_ID, F.lit(""), A.part_of(F.col("part_key"), total, part_bytes)))
    _written(spark, d, rows, root, part_bytes)
    m = read_members(list_files(spark, root, "*.tar.part*"), with_content=True)
    return m.select("member", "is_file", "size", F.when(F.col("is_file"), F.md5("content")).alias("content_md5")).distinct()


@query("snk_annual_archive", _ARCHIVE_SQL + """
SELECT filing_year, member, size, content_md5 FROM am WHERE is_file
""")
def snk_annual_archive(spark, d, part_bytes=ANNUAL_PART_BYTES):
    """One archive per filing year, in parts by size, read back: the year parsed from the name."""
    root = scratch_dir(spark, "annual")
    rows = staged_keys(spark, d)
    per_year = rows.groupBy("filing_year").agg(F.sum("body_bytes").alias("_year_bytes"))
    rows = rows.join(per_year, "filing_year")
    rows = A.part_keys(rows, part_bytes, groups=["filing_year"])
    part = A.part_of(F.col("part_key"), F.col("_year_bytes"), part_bytes)
    rows = rows.withColumn("archive", A.archive_name(S.ARCHIVE_PREFIX, F.col("filing_year"), part)).drop("_year_bytes")
    _written(spark, d, rows, root, part_bytes)
    files = list_files(spark, root, S.ARCHIVE_PREFIX + "*.tar.part*")
    files = files.withColumn("filing_year", S.batch_no_from_name(A.whole_name(F.col("name"))))
    m = read_members(files, with_content=True).filter(F.col("is_file"))
    return m.select("filing_year", "member", "size", F.md5("content").alias("content_md5"))


@query("agg_extract_tree", _ARCHIVE_SQL + """
SELECT batch_no, CAST(count(*) FILTER (WHERE is_file) AS BIGINT) AS n_written,
       CAST(count(*) FILTER (WHERE is_dir) AS BIGINT) AS n_dirs, CAST(0 AS BIGINT) AS n_quarantined, CAST(0 AS BIGINT) AS n_errors
FROM am GROUP BY batch_no
""")
def agg_extract_tree(spark, d):
    """Unpack every batch archive into a tree; per archive, what was written and quarantined."""
    members = read_members(_listing(spark, d), with_content=True)
    return A.extract_tree(members, scratch_dir(spark, "extracted")).drop("archive_path")


@query("qa_rejected_archives", _ARCHIVE_SQL + """
SELECT 'sp500_filings_data_x' || CAST(batch_no AS VARCHAR) || '.tar' AS name, 'unparsable batch number' AS reason
FROM ab WHERE batch_no % 7 = 0
""")
def qa_rejected_archives(spark, d):
    """Archives whose name holds no batch number (every seventh one here) are listed with the reason."""
    root = scratch_dir(spark, "misnamed")
    rows = staged_keys(spark, d)
    key = F.when(F.col("batch_no") % 7 == 0, F.concat(F.lit("x"), F.col("batch_no").cast("string"))).otherwise(
        F.col("batch_no").cast("string"))
    _written(spark, d, rows.withColumn("archive", F.concat(F.lit(RUN_ID + "/"), A.archive_name(S.ARCHIVE_PREFIX, key))), root)
    return rejected_archives(spark, f"{root}/{RUN_ID}").select("name", "reason")


@query("qa_zero_length", _ARCHIVE_SQL + """
SELECT 'body' AS kind, i.accession || '.html' AS name, i.ticker, i.accession, true AS checked
FROM filing_index i JOIN body_state b ON b.k = i.k WHERE b.body_chars = 0
UNION ALL
SELECT 'archive', 'sp500_filings_data_' || CAST(batch_no AS VARCHAR) || '.tar', NULL, NULL, NULL FROM ab WHERE batch_no % 6 = 0
""")
def qa_zero_length(spark, d):
    """Objects without a byte, from file metadata: bodies that arrived empty, in the tree of all that arrived of the
    staged third and of the empty ones, each checked against what is known of the filing's body (``checked``), and
    archives of a run, of which the copies of every sixth batch broke off at once."""
    idx = X.filing_index(spark, d)
    state = X.body_state(spark, d, idx).select("k", "body_chars", "body_bytes")
    arrived = idx.join(state, "k").filter((F.col("k") % X.STAGED_EVERY == 0) | (F.col("body_chars") == 0))
    path = S.rel_path("ticker", "filing_year", "form", "accession")
    rows = arrived.select("k", path.alias("member"), A.epoch_seconds(F.col("filed_at")).alias("mtime"), "body_bytes")
    empty = A.zero_byte(scanned_tree(spark, d, rows), "body")
    empty = empty.select("kind", "name", F.element_at(F.split("path", "/"), -4).alias("ticker"), F.regexp_replace("name", r"\.html$", "").alias("accession"))
    known = idx.join(state, "k").select("accession", (F.col("body_chars") == 0).alias("checked"))
    bodies = empty.join(known, "accession", "left").select("kind", "name", "ticker", "accession", "checked")

    run = scratch_dir(spark, "copied-runs")
    copies = _listing(spark, d).select("name", F.when(F.col("batch_no") % 6 == 0, F.lit("")).otherwise(F.col("archive_path")).alias("content"))
    write_tree(copies.select(F.concat(F.lit(RUN_ID + "/"), "name").alias("member"), "content"), run, mtime=None)
    archives = A.zero_byte(list_archives(spark, f"{run}/{RUN_ID}"), "archive")
    return bodies.unionByName(archives.select("kind", "name"), allowMissingColumns=True)


@query("src_tree_scan", """
SELECT rel_path, size, CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', mtime) AS BIGINT) AS mtime_s FROM files
""")
def src_tree_scan(spark, d):
    """The staged tree written as real files (one per filing, some at a time) and scanned back: relative path,
    byte size and modification time of every .html file (metadata only; company folders listed by
    tasks). Local files keep the time they are given; object stores would show the write time."""
    f = scanned_tree(spark, d, staged_keys(spark, d).withColumn("member", F.col("rel_path")))
    return f.select("rel_path", F.col("archive_bytes").alias("size"), F.col("archive_mtime").cast("bigint").alias("mtime_s"))
