"""Archive operators: batch and part keys for packing, and reports over unpacked members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators.ranking import ordered_rank

# Tar layout constants (POSIX tar): 512-byte blocks, two zero blocks at the end, records of 20 blocks.
BLOCK = 512
RECORD = 20 * BLOCK
# slices of an archive's companies when its first names are picked
NAME_SLICES = 1024
# a company with more than this share of a part's bytes is spread over the parts
PIECES_PER_PART = 16


def company_batches(rows: DataFrame, batch_size: int = S.DEFAULT_BATCH_SIZE, order: Column | None = None) -> DataFrame:
    """(ticker, batch_no): companies numbered in list order, ``batch_size`` per archive.
    Ranks the distinct companies only (narrow), never the filings."""
    tick = rows.select("ticker").distinct()
    tick = tick.withColumn("_ord", order if order is not None else F.col("ticker"))
    r = ordered_rank(tick, ["_ord", "ticker"], rank_col="_trank")
    return r.select("ticker", S.batch_of("_trank", batch_size).alias("batch_no"))


def part_of(member: Column, total_bytes: Column, part_bytes: int) -> Column:
    """Part number (from 0) of a member of an archive whose content totals ``total_bytes``: about
    ``part_bytes`` each, spread by hash: of the members, or of what ``part_keys`` gives in their place."""
    n = F.greatest(F.lit(1), F.ceil(total_bytes / F.lit(float(part_bytes)))).cast("bigint")
    return F.pmod(F.xxhash64(member), n)


def part_keys(rows: DataFrame, part_bytes: int, company: str = "ticker", size: str = "body_bytes",
              groups: Sequence[str] = ()) -> DataFrame:
    """Add ``part_key``, by which ``part_of`` spreads the members of an archive (one per value of ``groups``): the
    company, so that its directories are written once, or the member, where the company is a large piece of a part.
    By members alone every part repeats the directories of nearly each of its files."""
    by = [company, *groups]
    per = rows.groupBy(*by).agg(F.sum(size).alias("_company_bytes"))
    small = F.col("_company_bytes") * PIECES_PER_PART <= part_bytes
    key = F.when(small, F.col(company)).otherwise(F.col("member"))
    return rows.join(per, by).withColumn("part_key", key).drop("_company_bytes")


def archive_name(prefix: str, key: Column, part: Column | None = None) -> Column:
    """``{prefix}{key}.tar``; parts of one archive are ``{prefix}{key}.tar.part{n}``."""
    base = F.concat(F.lit(prefix), key.cast("string"), F.lit(".tar"))
    return base if part is None else F.concat(base, F.lit(".part"), part.cast("string"))


def whole_name(name: Column) -> Column:
    """Name of the archive that a part belongs to: reports count archives, whatever the part size."""
    return F.regexp_replace(name, r"\.part[0-9]+$", "")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 of a timestamp without time zone (no session time zone involved)."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def zero_byte(files: DataFrame, kind: str) -> DataFrame:
    """Files of a listing without a byte: kind, name and path."""
    return files.filter(F.col("archive_bytes") == 0).select(F.lit(kind).alias("kind"), "name", F.col("archive_path").alias("path"))


def inspect(members: DataFrame, root: str = S.STAGING_ROOT, keys=("archive_path", "batch_no", "archive_bytes"),
            first_n: int = 5) -> DataFrame:
    """Per archive: members, files, directories, companies (from directories, or files at depth 3
    or more) and the first ``first_n`` company names.

    Two aggregations on one scan: per (archive, company), then per archive. The names are folded
    into a sorted list cut to ``first_n`` per task and company slice, so no archive's whole list of
    companies is ever gathered. ``keys`` must identify the archive."""
    keys = list(keys)
    parts = F.split("member", "/")
    comp = F.when((F.col("is_dir") | (F.size(parts) >= 3)), S.path_company("member", root))
    level1 = members.groupBy(*keys, comp.alias("company")).agg(
        F.count("member").alias("c_members"),
        F.count_if(F.col("is_file")).alias("c_files"),
        F.count_if(F.col("is_dir")).alias("c_dirs"),
        F.count_if(F.col("error").isNotNull()).alias("c_errors"),
    )
    # slices of companies first: at most first_n names leave each
    level2 = level1.groupBy(*keys, F.pmod(F.xxhash64("company"), F.lit(NAME_SLICES)).alias("_slice")).agg(
        *[F.sum(c).alias(c) for c in ("c_members", "c_files", "c_dirs", "c_errors")],
        F.count("company").alias("c_companies"),
        F.slice(F.sort_array(F.collect_list("company")), 1, first_n).alias("names"))
    g = level2.groupBy(*keys).agg(
        F.sum("c_members").alias("n_members"), F.sum("c_files").alias("n_files"), F.sum("c_dirs").alias("n_dirs"),
        F.sum("c_errors").alias("n_errors"), F.sum("c_companies").alias("n_companies"),
        F.slice(F.sort_array(F.flatten(F.collect_list("names"))), 1, first_n).alias("_first"))
    n = F.col("n_companies").cast("bigint")
    text = F.concat(F.array_join("_first", ", "), F.when(n > first_n, F.lit("...")).otherwise(F.lit("")))
    return g.select(*keys, F.col("n_members").cast("bigint").alias("n_members"),
                    F.col("n_files").cast("bigint").alias("n_files"), F.col("n_dirs").cast("bigint").alias("n_dirs"),
                    n.alias("n_companies"), text.alias("companies_text"), (F.col("n_errors") == 0).alias("readable"))


def extract_tree(members: DataFrame, out_dir: str) -> DataFrame:
    """Unpack archive members into a folder tree, as extracting every batch in order would.

    * Members whose name is absolute or climbs out with '..' are quarantined, not written.
    * A member present in several batches is written once, from the latest batch (of equal
      batches, the greatest archive path): the overwrite of a sequential extraction.
    * Winners are chosen on names and batch numbers alone; content joins them once.

    ``members`` is read twice (winners, then content): pass a listing read, not a computed frame.
    Returns per-archive counts: files written, directories, members quarantined, errors.
    """
    from ledgerline.sinks.archives import write_tree

    unsafe = S.is_unsafe_member("member")
    good = F.col("is_file") & ~unsafe & F.col("error").isNull()
    won = (members.filter(good).groupBy("member").agg(F.max(F.struct("batch_no", "archive_path")).alias("_won"))
           .select("member", F.col("_won.batch_no").alias("batch_no"), F.col("_won.archive_path").alias("archive_path")))
    content = members.filter(good).select("member", "batch_no", "archive_path", "content", "mtime")
    write_tree(content.join(won, ["member", "batch_no", "archive_path"], "left_semi").select("member", "content", "mtime"),
               out_dir)
    written = won.groupBy("archive_path").agg(F.count(F.lit(1)).alias("n_written"))
    per = members.drop("content").groupBy("archive_path", "batch_no").agg(
        F.count_if(F.col("is_dir") & ~unsafe).alias("n_dirs"), F.count_if(unsafe).alias("n_quarantined"),
        F.count_if(F.col("error").isNotNull()).alias("n_errors"))
    return per.join(written, "archive_path", "left").select(
        "archive_path", "batch_no", F.coalesce("n_written", F.lit(0)).alias("n_written"), "n_dirs", "n_quarantined",
        "n_errors")
