"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one
JSON line with per-query seconds (each query fully executed with a noop write)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans import queries  # noqa: E402
from ledgerline.session import local_session, scratch_dir  # noqa: E402
from ledgerline.sinks.archives import write_archives  # noqa: E402

HEADLINE = [
    "qa_company_coverage",
    "join_skip_existing",
    "join_work_index",
    "join_empty_cells",
    "set_distinct_accession",
    "qa_failed_bodies",
    "win_batch_assign",
    "win_progress",
    "agg_run_summary",
    "win_last_writer",
    "snk_batch_archive",
    "src_archive_unpack",
    "agg_archive_inspect",
    "src_progress_log",
    "stm_ingest_new",
    "stm_batch_flush",
    "join_outcome",
    "agg_status_by_run",
    "top_recent",
    "snk_filing_store",
    "src_html_table",
    "src_company_json",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="ledgerline-bench")
    qs = queries()
    only = [k for k in sys.argv[1:] if k in qs]
    keys = only or [k for k in HEADLINE if k in qs]
    # warm-up: JVM, parquet footers and Python workers (not timed)
    qs["qa_company_coverage"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, 64, 1, int(cpus) if cpus.isdigit() else 8).mapInPandas(
        lambda it: (pdf for pdf in it), "id long").write.format("noop").mode("overwrite").save()
    tiny = spark.createDataFrame([("warm/w_1.tar", "root/a/b.html", "x", 0)],
                                 "archive string, member string, content string, mtime long")
    write_archives(tiny, scratch_dir(spark, "bench-warmup"), num_partitions=1)
    times = {}
    for k in keys:
        t0 = time.perf_counter()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
