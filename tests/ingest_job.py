"""Run as a script: a stream of yearly landings into a large store, and from the event log how many rows each
micro-batch read. It must be bounded by what the touched buckets hold, not by the store."""

import glob
import json
import os
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerline.sources.landing import land_in_order  # noqa: E402
from ledgerline.streaming import ingest  # noqa: E402

PER_YEAR, YEARS, BUCKETS = 2000, 10, ingest.KeyBuckets(n=4)


def rows_read_by_epoch(folder):
    """Input records of the tasks of each micro-batch's jobs."""
    epoch_of, read = {}, Counter()
    for path in glob.glob(f"{folder}/**/*", recursive=True):
        if os.path.isfile(path) and not os.path.basename(path).startswith(("appstatus", ".")):
            for line in open(path):
                event = json.loads(line)
                if event["Event"] == "SparkListenerJobStart":
                    epoch = event["Properties"].get("streaming.sql.batchId")
                    epoch_of.update({s: epoch for s in event["Stage IDs"]})
                elif event["Event"] == "SparkListenerTaskEnd":
                    metrics = event.get("Task Metrics") or {}
                    read[epoch_of.get(event["Stage ID"])] += metrics.get("Input Metrics", {}).get("Records Read", 0)
    return {int(k): v for k, v in read.items() if k is not None}


def main(out):
    log = os.path.join(out, "log")
    os.makedirs(log)
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file:" + log)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("FATAL")
    every = spark.range(PER_YEAR * YEARS).select(F.col("id").cast("string").alias("accession"),
                                                 (F.col("id") % YEARS + 2000).alias("filing_year"))
    held = ingest.write_held(every.filter("CAST(accession AS BIGINT) % 3 = 0"), os.path.join(out, "held"), BUCKETS)
    src, sink = os.path.join(out, "src"), os.path.join(out, "sink")
    late = every.filter("filing_year = 2000 AND CAST(accession AS BIGINT) < 500")
    for year in range(2000, 2000 + YEARS):
        rows = every.filter(F.col("filing_year") == year)
        rows = rows.filter("CAST(accession AS BIGINT) >= 500") if year == 2000 else rows
        land_in_order(rows, src, ["accession"], min_chunks=1)
    land_in_order(late.unionByName(every.filter("filing_year = 2009")), src, ["accession"], min_chunks=1)
    schema = every.schema
    ingest.ingest_new(spark, src, schema, held, sink, os.path.join(out, "ckpt"), BUCKETS)
    got = ingest.read_ingested(spark, sink, schema)
    want = every.filter("CAST(accession AS BIGINT) % 3 <> 0")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0, "late or repeated rows were lost or stored twice"
    spark.stop()
    read = rows_read_by_epoch(log)
    assert sorted(read) == list(range(YEARS + 1)), read
    # a micro-batch reads itself (twice at most), the held third of its year and what its year already stored
    for epoch in range(YEARS):
        assert 0 < read[epoch] <= 3 * PER_YEAR, (epoch, read)
    assert read[YEARS] <= 2 * (PER_YEAR + 50) + 2 * 2 * PER_YEAR, read  # two years: late rows and repeated ones
    assert read[YEARS - 1] <= read[1] * 1.2, "the cost of an epoch grows with the store"
    print("BUCKETS-OK", read)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="ingest-"))
