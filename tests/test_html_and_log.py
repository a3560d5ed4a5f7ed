from ledgerline.sources import html_tables
from ledgerline.sources.runlog import parse_lines

PAGE = """<html><body><table><thead><tr><th>Symbol</th><th>Security</th><th>Other</th><th>CIK</th></tr></thead>
<tbody><tr><td>MMM</td><td>3M &amp; Co</td><td><table><tr><td>nested</td></tr></table></td><td>66740</td></tr>
<tr><td></td><td>No  ticker<br>Inc</td><td>x</td><td>12345678901</td></tr></tbody></table>
<table><tr><th>Date</th></tr><tr><td>skip</td></tr></table></body></html>"""


def test_first_table_columns_entities_and_empty_cells(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    cells = html_tables.table_cells(pages)
    t = html_tables.first_table(cells, {"Symbol": "ticker", "Security": "company_name", "CIK": "cik"})
    rows = sorted(t.collect(), key=lambda r: r.row_no)
    assert [(r.ticker, r.company_name, r.cik) for r in rows] == [
        ("MMM", "3M & Co", "66740"), (None, "No ticker Inc", "12345678901")]


def _grid(spark, html):
    rows = html_tables.table_cells(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
    return [(r.table_no, r.is_header, list(r.cells)) for r in sorted(rows, key=lambda r: (r.table_no, r.row_no))]


def test_omitted_end_tags_and_open_table(spark):
    assert _grid(spark, "<table><tr><th>A<th>B<tr><td>1<td>2<tr><td>3<td>4") == [
        (0, True, ["A", "B"]), (0, False, ["1", "2"]), (0, False, ["3", "4"])]


def test_header_of_td_cells(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>A</td><td>B</td></tr><tr><td>1</td><td>2</td></tr></table>")],
                                  "page_id long, html string")
    t = html_tables.first_table(html_tables.table_cells(pages), {"B": "b", "A": "a"})
    assert [(r.a, r.b) for r in t.collect()] == [("1", "2")]


def test_spanning_cells_are_repeated(spark):
    assert _grid(spark, "<table><thead><tr><th colspan=2>X<th>Y</thead><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e</table>") == [
        (0, True, ["X", "X", "Y"]), (0, False, ["a", "b", "c"]), (0, False, ["a", "d", "e"])]


def test_log_shapes(spark):
    lines = [
        "[2024-01-01 00:00:07] Completed 3/10: ✓ AAPL - Downloaded 4 filings",
        "[2024-01-01 00:00:08] Exception 4/10: ✗ MSFT - boom",
        "[2024-01-01 00:00:09] [Worker 2] Starting download for AAPL - Apple",
        "[2024-01-01 00:00:10] ARCHIVED: Batch 2 with 12 companies (1.5MB)",
        "[2024-01-01 00:00:11] FINAL BATCH (REMAINDER): Batch 3 with 5 companies (0.2MB)",
        "[2024-01-01 00:00:12] ARCHIVE ERROR: disk full",
        "[2024-01-01 00:00:13] FINAL BATCH ERROR: disk full",
        "  Companies: A, B",
        "Successful: 9",
        "=" * 80,
        "something else entirely",
    ]
    df = parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [(r.kind, r.ticker, r.n_done, r.batch_no, r.size_mb) for r in df.collect()]
    assert got[0] == ("completed", "AAPL", 3, None, None)
    assert got[1][:3] == ("exception", "MSFT", 4)
    assert got[3] == ("archived", None, None, 2, 1.5)
    assert got[4][0] == "final_batch" and got[4][3] == 3
    assert [g[0] for g in got[5:]] == ["archive_error", "final_batch_error", "detail", "field", "rule", "other"]


LOG = """Download Progress Log - 2024-01-01 00:00:00
Total companies: 30
Workers: 2
{rule}

[2024-01-01 00:00:07] [Worker 1] Completed A: Downloaded 4 filings
[2024-01-01 00:00:08] ARCHIVED: Batch 1 with 2 companies (1.5MB)
  Archive: runs/r/sp500_filings_data_1.tar
[2024-01-01 00:00:08] [Worker 2] Completed B: Downloaded 1 filings
  Companies: A, B
[2024-01-01 00:00:09] ARCHIVE ERROR: disk full
[2024-01-01 00:00:10] FINAL BATCH (REMAINDER): Batch 3 with 1 companies (0.2MB)
  Archive: runs/r/sp500_filings_data_3.tar
  Companies: E
  Note: This is the remainder batch (5 % 2 = 1 companies)

{rule}
Download Summary - 2024-01-01 00:00:11
Total companies: 30
Successful: 5
Failed: 3
Batches created: 3
Archive directory: runs/r
Failed companies: X, Y
Failed companies: Z
""".format(rule="=" * 80)


def test_records_are_joined_over_splits_and_files(spark, tmp):
    """Lines of a record in other splits, in another file, and with a worker's lines between them."""
    import os

    from ledgerline.sources import runlog

    lines = LOG.splitlines(keepends=True)
    for run, cuts in (("r1", []), ("r2", [8, 13, 20]), ("r3", range(1, len(lines)))):
        os.makedirs(os.path.join(tmp, f"run_id={run}"))
        bounds = [0, *cuts, len(lines)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            with open(os.path.join(tmp, f"run_id={run}", f"part-{k:05}.txt"), "w") as f:
                f.write("".join(lines[a:b]))
    os.makedirs(os.path.join(tmp, "run_id=open"))  # a run that has not ended
    with open(os.path.join(tmp, "run_id=open", "part-00000.txt"), "w") as f:
        f.write("".join(lines[:9]))
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
        parsed = runlog.read_log(spark, tmp)
        assert parsed.rdd.getNumPartitions() > 20
        found = runlog.records(parsed)
        batches = runlog.log_batches(found).collect()
        summaries = {r.run_id: r for r in runlog.log_summaries(found).collect()}
        failed = runlog.failed_companies(parsed).collect()
        errors = runlog.log_errors(parsed).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    for run in ("r1", "r2", "r3"):
        got = {r.batch_no: (r.archive, r.companies, r.remainder, r.note) for r in batches if r.run_id == run}
        assert got == {1: ("runs/r/sp500_filings_data_1.tar", ["A", "B"], False, None),
                       3: ("runs/r/sp500_filings_data_3.tar", ["E"], True, "This is the remainder batch (5 % 2 = 1 companies)")}
        s = summaries[run]
        assert (s.n_listed, s.workers, s.n_total, s.n_success, s.n_failed, s.n_batches, s.archive_dir, s.n_failed_listed) == (
            30, 2, 30, 5, 3, 3, "runs/r", 3)
        assert sorted(r.ticker for r in failed if r.run_id == run) == ["X", "Y", "Z"]
    assert summaries["open"].n_total is None and summaries["open"].n_listed == 30
    half = [r for r in batches if r.run_id == "open"]
    assert [(r.batch_no, r.archive, r.companies) for r in half] == [(1, "runs/r/sp500_filings_data_1.tar", None)]
    assert {r.message for r in errors} == {"disk full"}


def test_exceptions_and_lost_batches_are_written(spark):
    import datetime as dt

    from ledgerline.sinks import runlog

    t = dt.datetime(2024, 1, 1)
    done = [("r", i, f"T{i}", t + dt.timedelta(minutes=i), i not in (2, 3), "boom" if i == 3 else None) for i in range(7)]
    df = spark.createDataFrame(done, "run_id string, item long, ticker string, ts timestamp_ntz, ok boolean, raised string")
    lost = spark.createDataFrame([("r", 1, "disk full"), ("r", 3, "disk full")], "run_id string, batch_no long, error string")
    text = [r.value for r in runlog.render(df, batch_size=2, raised="raised", lost=lost, workers=3).orderBy("ts", "seq", "ord").collect()]
    assert "[2024-01-01 00:03:00] Exception 4/7: ✗ T3 - boom" in text
    assert "[2024-01-01 00:02:00] [Worker 3] Error processing T2: failed" in text
    assert not any("[Worker" in line and "T3" in line for line in text)
    assert "[2024-01-01 00:01:00] ARCHIVE ERROR: disk full" in text and "[2024-01-01 00:06:00] FINAL BATCH ERROR: disk full" in text
    kept = [line for line in text if "ARCHIVED" in line]
    assert kept == ["[2024-01-01 00:05:00] ARCHIVED: Batch 2 with 2 companies (0.0MB)"]
    assert sum(line.startswith("  Companies: ") for line in text) == 1
