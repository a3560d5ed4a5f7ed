"""Progress-log reader: each text line classified into its shape and parsed with built-in
regular-expression functions (JVM-side). Lines of unknown shape are kept as kind 'other'.

Some records have several lines: an archived batch (with its archive, companies and note) and the blocks at
the head and the end of a log. A line of such a record belongs to the nearest head line before it in its
run's log, whatever other lines, of workers for instance, were written in between. The order is that of the
run's files, of the splits of a file and of the lines of a split. A head may be the last line of a split and
its details the first of the next one, or of the next file: each split passes its last head on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir

TS = r"(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)"
# Fixed line shapes of the reference's progress log: (kind, pattern).
SHAPES = [
    ("worker", r"^\[" + TS + r"\] \[Worker (\d+)\] (.*)$"),
    ("completed", r"^\[" + TS + r"\] Completed (\d+)/(\d+): (\S+) (\S+) - (.*)$"),
    ("exception", r"^\[" + TS + r"\] Exception (\d+)/(\d+): (\S+) (\S+) - (.*)$"),
    ("archived", r"^\[" + TS + r"\] ARCHIVED: Batch (\d+) with (\d+) companies \(([0-9.]+)MB\)$"),
    ("final_batch", r"^\[" + TS + r"\] FINAL BATCH \(REMAINDER\): Batch (\d+) with (\d+) companies \(([0-9.]+)MB\)$"),
    ("archive_error", r"^\[" + TS + r"\] ARCHIVE ERROR: (.*)$"),
    ("final_batch_error", r"^\[" + TS + r"\] FINAL BATCH ERROR: (.*)$"),
    ("header", r"^Download Progress Log - " + TS + r"$"),
    ("summary", r"^Download Summary - " + TS + r"$"),
    ("detail", r"^  (Archive|Companies|Note): (.*)$"),
    ("field", r"^(Total companies|Workers|Successful|Failed|Batches created|Archive directory|Failed companies): (.*)$"),
    ("rule", r"^(=+|)$"),
]


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add kind, ts, ticker, mark, batch_no, n_done, n_total, size_mb, message to each line."""
    v = F.col(value)
    kind = None
    for k, p in SHAPES:
        kind = F.when(v.rlike(p), F.lit(k)) if kind is None else kind.when(v.rlike(p), F.lit(k))
    kind = kind.otherwise(F.lit("other"))
    pat = dict(SHAPES)
    df = lines.withColumn("kind", kind)

    def grab(k, i):
        return F.when(F.col("kind") == k, F.regexp_extract(v, pat[k], i))

    ts_text = F.coalesce(*[grab(k, 1) for k in ("worker", "completed", "exception", "archived", "final_batch",
                                               "archive_error", "final_batch_error", "header", "summary")])
    return df.select(
        "*",
        F.to_timestamp_ntz(ts_text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.coalesce(grab("completed", 5), grab("exception", 5)).alias("ticker"),
        F.coalesce(grab("completed", 4), grab("exception", 4)).alias("mark"),
        F.coalesce(grab("archived", 2), grab("final_batch", 2)).cast("bigint").alias("batch_no"),
        F.coalesce(grab("archived", 3), grab("final_batch", 3)).cast("bigint").alias("n_companies"),
        F.coalesce(grab("completed", 2), grab("exception", 2)).cast("bigint").alias("n_done"),
        F.coalesce(grab("completed", 3), grab("exception", 3)).cast("bigint").alias("n_total"),
        F.coalesce(grab("archived", 4), grab("final_batch", 4)).cast("double").alias("size_mb"),
        F.coalesce(grab("completed", 6), grab("exception", 6), grab("worker", 3), grab("archive_error", 2),
                   grab("final_batch_error", 2), grab("detail", 2), grab("field", 2)).alias("message"),
    )


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """Read run logs written under ``root/run_id=<run>/`` (run_id comes from the folder), every line with its
    place: the file, where the split of the file starts, and a number that grows within the split."""
    lines = spark.read.text(root).select(
        "*", F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"))
    return parse_lines(lines)


HEADS = ("header", "summary", "archived", "final_batch")
LABEL = r"^ *([A-Z][A-Za-z ]*?): "


def records(parsed: DataFrame) -> DataFrame:
    """The records of several lines: run_id, the columns of the head line, and ``fields``, a map from label to text of
    the lines below it. Failed companies may take many lines: they are under ``Failed companies`` as a count of
    names, the lines themselves are ``failed_companies(parsed)``.

    Only head and detail lines are kept, once (their places must not be computed twice); the window is over one
    split of one file, and over the splits of a run.
    """
    spark = parsed.sparkSession
    at = scratch_dir(spark, "log-records")
    parsed.filter(F.col("kind").isin(*HEADS, "detail", "field")).write.parquet(at)
    rows = spark.read.parquet(at)
    is_head = F.col("kind").isin(*HEADS)
    split = ["run_id", "part", "block"]
    upto = Window.partitionBy(*split).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("run_id").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct("part", "block", "line")
    splits = rows.groupBy(*split).agg(F.max(F.when(is_head, place)).alias("_last"))
    splits = splits.select(*split, F.last("_last", ignorenulls=True).over(before).alias("_passed"))
    own = F.last(F.when(is_head, place), ignorenulls=True).over(upto)
    rows = rows.select("*", own.alias("_own")).join(splits, split).withColumn("head", F.coalesce("_own", "_passed"))
    heads = rows.filter(is_head).select("run_id", "head", "kind", "ts", "batch_no", "n_companies", "size_mb")
    below = rows.filter(~is_head & F.col("head").isNotNull()).select("run_id", "head", F.regexp_extract("value", LABEL, 1).alias("label"),
                                                                     "message")
    # a label that repeats is a list of names in lines: bounded to its count here
    one = below.groupBy("run_id", "head", "label").agg(
        F.max("message").alias("text"), F.sum(F.size(F.split("message", ", "))).alias("names"), F.count(F.lit(1)).alias("n"))
    text = F.when(F.col("label") == "Failed companies", F.col("names").cast("string")).otherwise(F.col("text"))
    fields = one.groupBy("run_id", "head").agg(F.map_from_entries(F.collect_list(F.struct("label", text.alias("text")))).alias("fields"))
    return heads.join(fields, ["run_id", "head"], "left").drop("head")


def failed_companies(parsed: DataFrame) -> DataFrame:
    """run_id and ticker of the names on the logs' lists of failed companies."""
    lines = parsed.filter((F.col("kind") == "field") & F.startswith("value", F.lit("Failed companies: ")))
    return lines.select("run_id", F.explode(F.split("message", ", ")).alias("ticker"))


def log_batches(records_: DataFrame) -> DataFrame:
    """Archived batches: run_id, batch_no, ts, remainder, n_companies, size_mb, archive, companies and note."""
    rows = records_.filter(F.col("kind").isin("archived", "final_batch"))
    return rows.select(
        "run_id", "batch_no", "ts", (F.col("kind") == "final_batch").alias("remainder"), "n_companies", "size_mb",
        F.col("fields")["Archive"].alias("archive"), F.split(F.col("fields")["Companies"], ", ").alias("companies"),
        F.col("fields")["Note"].alias("note"))


def log_summaries(records_: DataFrame) -> DataFrame:
    """One row a run: what its log says at its head and at its end (null where it has not ended)."""
    def number(label: str) -> Column:
        return F.col("fields")[label].try_cast("bigint")

    head = records_.filter(F.col("kind") == "header").select(
        "run_id", F.col("ts").alias("started_at"), number("Total companies").alias("n_listed"), number("Workers").alias("workers"))
    end = records_.filter(F.col("kind") == "summary").select(
        "run_id", F.col("ts").alias("ended_at"), number("Total companies").alias("n_total"), number("Successful").alias("n_success"),
        number("Failed").alias("n_failed"), number("Batches created").alias("n_batches"),
        F.col("fields")["Archive directory"].alias("archive_dir"), F.coalesce(number("Failed companies"), F.lit(0)).cast("bigint").alias("n_failed_listed"))
    return head.join(end, "run_id", "left")


def log_errors(parsed: DataFrame) -> DataFrame:
    """Exceptions of companies and failed archives: run_id, ts, kind, ticker (null for archives) and message."""
    return parsed.filter(F.col("kind").isin("exception", "archive_error", "final_batch_error")).select(
        "run_id", "ts", "kind", "ticker", "message")
