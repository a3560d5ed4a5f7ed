"""Run as a script: pack archives while the first attempt of one task dies mid-write; the retry
must produce byte-identical archives and nothing of the dead attempt may remain."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerline.sinks import manifest  # noqa: E402
from ledgerline.sinks.archives import FORMAT, register, write_archives  # noqa: E402


def rows(spark):
    data = [(f"run/sp500_filings_data_{b}.tar", f"sp500_filings_data/T{b}/2001/10-K/{k}.html", f"<p>{b}-{k}</p>" * 50, 7)
            for b in range(1, 9) for k in range(30)]
    return spark.createDataFrame(data, "archive string, member string, content string, mtime long")


def flaky(marker):
    def run(it):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        seen = 0
        for pdf in it:
            seen += len(pdf)
            if ctx.attemptNumber() == 0 and ctx.partitionId() == 0 and seen > 20:
                open(marker, "w").close()
                raise RuntimeError("injected task failure")
            yield pdf

    return run


def main(out):
    spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "2").config("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
             .getOrCreate())
    spark.sparkContext.setLogLevel("FATAL")
    register(spark)
    clean, retried = os.path.join(out, "clean"), os.path.join(out, "retried")
    write_archives(rows(spark), clean, num_partitions=2)
    df = rows(spark).repartition(2, "archive").sortWithinPartitions("archive", "member")
    marker = os.path.join(out, "attempt0-failed")
    df.mapInPandas(flaky(marker), df.schema).write.format(FORMAT).mode("append").option("job", "flaky").save(retried)
    manifest.publish(spark, retried, "flaky")
    assert os.path.exists(marker), "the first attempt did not fail"
    want, got = ({r.archive: r.path for r in manifest.read_manifest(spark, root).collect()} for root in (clean, retried))
    assert sorted(want) == sorted(got) and len(want) == 8, "archive sets differ"
    for n in want:
        with open(want[n], "rb") as a, open(got[n], "rb") as b:
            assert a.read() == b.read(), f"{n} differs after retry"
    there = {os.path.join(d, f) for d, _, fs in os.walk(retried) for f in fs if f.endswith(".tar")}
    assert there == set(got.values()), f"files of a failed attempt are left: {there - set(got.values())}"
    names = sorted(want)
    print("RETRY-OK", len(names))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="retry-"))
