import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import coverage, incremental, worklist

IDX = "k long, ticker string, accession string, form string, filing_date date, filing_year long"


def idx(spark, rows):
    return spark.createDataFrame(rows, IDX)


def test_year_guard_drops_filing_dated_outside_requested_year(spark):
    df = idx(spark, [(1, "A", "1", "10-K", dt.date(1999, 12, 31), 1999), (2, "A", "2", "10-K", dt.date(2000, 1, 1), 2000)])
    got = {(r.accession, r.work_year) for r in worklist.year_guard(df, (2000, 2000)).collect()}
    assert got == {("2", 2000)}


def test_same_accession_twice_collapses_deterministically(spark):
    df = idx(spark, [(1, "A", "9", "10-K", dt.date(2000, 3, 1), 2000), (1, "A", "9", "10-K", dt.date(2000, 2, 1), 2000)])
    out = incremental.distinct_by_key(df, ["ticker", "filing_year", "form", "accession"], "filing_date").collect()
    assert len(out) == 1 and out[0].filing_date == dt.date(2000, 2, 1)


def test_amendments_only_when_asked(spark):
    df = idx(spark, [(1, "A", "1", "10-K", None, 2000), (2, "A", "2", "10-K/A", None, 2000), (3, "A", "3", "8-K", None, 2000)])
    assert {r.form for r in worklist.filter_forms(df, ["10-K"]).collect()} == {"10-K"}
    assert {r.form for r in worklist.filter_forms(df, ["10-K"], include_amendments=True).collect()} == {"10-K", "10-K/A"}


def test_missing_ticker_counts_as_failed(spark):
    c = spark.createDataFrame([(None, "X"), ("", "Y"), ("A", None)], "ticker string, company_name string")
    m = worklist.missing_ticker(c).collect()
    assert {r.company_name for r in m} == {"X", "Y"} and not any(r.success for r in m)
    assert [r.ticker for r in worklist.usable_companies(c).collect()] == ["A"]


def test_coverage_bodies_missing_null_empty_and_company_without_filings(spark):
    company = spark.createDataFrame([("A",), ("B",), (None,)], "ticker string")
    wanted = idx(spark, [(1, "A", "1", "10-K", None, 2000), (2, "A", "2", "10-K", None, 2000),
                         (3, "A", "3", "10-Q", None, 2001), (4, "A", "4", "10-Q", None, 2001)])
    held = spark.createDataFrame([(4,)], "k long")
    # 1: body missing (no row); 2: null length; 3: empty; 4: held
    body = spark.createDataFrame([(2, None), (3, 0), (4, 10)], "k long, body_chars long")
    out = {r.ticker: r for r in coverage.company_coverage(company, wanted, held, body, 6).collect()}
    a, b = out["A"], out["B"]
    assert (a.n_expected, a.n_held, a.n_new, a.n_failed, a.n_empty_cells, a.complete) == (4, 1, 0, 3, 4, False)
    assert (b.n_expected, b.n_held, b.n_new, b.n_failed, b.n_empty_cells, b.complete) == (0, 0, 0, 0, 6, True)
    assert set(out) == {"A", "B"}


def test_worklist_and_empty_cells(spark):
    company = spark.createDataFrame([("A",), ("B",)], "ticker string")
    work = worklist.plan_work(company, (2000, 2001), ["10-K", "10-Q"])
    assert work.count() == 8
    index = idx(spark, [(1, "A", "1", "10-K", dt.date(2000, 5, 1), 2000)])
    assert worklist.match_work_index(work, index).count() == 1
    assert worklist.empty_cells(work, index).count() == 7


def test_month_range_end_optional(spark):
    df = idx(spark, [(i, "A", str(i), "10-K", dt.date(2000, m, 15), 2000) for i, m in enumerate(range(1, 13))])
    assert worklist.filter_month_range(df, (2000, 4), (2000, 6)).count() == 3
    assert worklist.filter_month_range(df, (2000, 11)).count() == 2


def test_store_is_incremental_and_pruned(spark, tmp):
    from ledgerline.sinks.filing_store import read_store, store_filings

    rows = spark.createDataFrame(
        [("A", 2000, "10-K", "1", "<p>1</p>"), ("A", 2001, "10-K/A", "2", "<p>2</p>"), ("B", 2001, "10-Q", "3", "x")],
        "ticker string, filing_year long, form string, accession string, html string")
    store_filings(rows, tmp)
    store_filings(rows, tmp)                      # a second run adds nothing
    st = read_store(spark, tmp)
    assert st.count() == 3
    assert {r.rel_path for r in st.collect()} >= {"A/2001/10-K%2FA/2.html"}
    q = worklist.filter_year_window(st, (2001, 2001)).select("accession")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "filing_year" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert {r.accession for r in q.collect()} == {"2", "3"}


def test_store_keeps_one_of_a_load_and_takes_further_loads(spark, tmp):
    from ledgerline.sinks import filing_store as fs

    schema = "ticker string, filing_year long, form string, accession string, html string"
    first = spark.createDataFrame([("A", 2000, "10-K", "1", "x"), ("A", 2000, "10-K", "1", "x"), ("A", 2000, "10-Q", "1", "y")], schema)
    fs.store_filings(first, tmp, num_buckets=3)
    more = spark.createDataFrame([("A", 2000, "10-K", "1", "again"), ("B", 2000, "10-K", "1", "z"), ("A", 2002, "10-K", "1", "w")], schema)
    fs.store_filings(more, tmp)
    spark.sql(f"DROP TABLE {fs._table(spark, tmp)}")  # as another session would find the folder
    fs.store_filings(more, tmp)
    fs.store_filings(more.limit(0), tmp)
    got = sorted((r.ticker, r.filing_year, r.form, r.accession, r.html) for r in fs.read_store(spark, tmp).collect())
    assert got == [("A", 2000, "10-K", "1", "x"), ("A", 2000, "10-Q", "1", "y"), ("A", 2002, "10-K", "1", "w"), ("B", 2000, "10-K", "1", "z")]
    assert fs.stored_keys(spark, tmp).count() == 4 and fs._layout(tmp)["buckets"] == 3


def test_the_store_is_not_moved_and_bodies_move_once(spark, tmp):
    from ledgerline.sinks import filing_store as fs

    rows = spark.range(400).select(F.concat(F.lit("T"), (F.col("id") % 9).cast("string")).alias("ticker"), (F.col("id") % 2 + 2000).alias("filing_year"),
                                   F.lit("10-K").alias("form"), F.col("id").cast("string").alias("accession"), F.lit("body").alias("html"))
    fs.store_filings(rows, tmp, num_buckets=6)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        new = fs.new_filings(rows.withColumn("accession", F.concat(F.lit("x"), "accession")), tmp)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 6 out of 6" in plan, plan
        assert "LeftAnti" in plan and "html" not in plan.split("FileScan")[1]
        assert new.count() == 400 and fs.new_filings(rows, tmp).count() == 0
        held = rows.select("ticker", "filing_year", "form", "accession")
        plan = fs.not_stored(held, tmp)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_coverage_scans_the_index_twice(spark):
    from conftest import SF_SMALL

    from ledgerline.plans import queries

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = queries()["qa_company_coverage"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert plan.count("orders.parquet") == 2 and plan.count("Exchange hashpartitioning") <= 9, plan


def test_anti_join_side_carries_no_bodies(spark):
    from ledgerline.plans import queries

    from conftest import SF_SMALL

    q = queries()["join_skip_existing"](spark, SF_SMALL)
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    anti = [ln for ln in plan.split("\n") if "LeftAnti" in ln]
    assert anti and "html" not in q.columns
    # the only html reference is the page length lookup, never carried through a join
    assert all("html" not in ln for ln in anti)


def test_held_with_and_without_archived(spark):
    staged = spark.createDataFrame([(1,), (2,)], "k long")
    archived = spark.createDataFrame([(2,), (3,)], "k long")
    assert sorted(r.k for r in incremental.held_union(staged, archived, ["k"]).collect()) == [1, 2, 3]
    assert sorted(r.k for r in incremental.held_union(staged, archived, ["k"], include_archived=False).collect()) == [1, 2]


def test_log_retention_whole_days(spark):
    from ledgerline.operators.runlog import retention

    as_of = dt.datetime(2024, 1, 31, 12, 0, 0)
    logs = spark.createDataFrame(
        [("a", as_of - dt.timedelta(days=7, hours=23)),    # 7 whole days: kept
         ("b", as_of - dt.timedelta(days=8)),              # 8 whole days: selected
         ("c", as_of - dt.timedelta(days=30))],
        "run_id string, mtime timestamp_ntz")
    out = {r.run_id: r.age_days for r in retention(logs, F.lit(as_of).cast("timestamp_ntz"), 7).collect()}
    assert out == {"b": 8, "c": 30}


def test_snapshot_pointer_switches_versions(spark, tmp):
    from ledgerline.sinks.snapshots import publish_snapshot, read_current

    v1 = spark.createDataFrame([(1,), (2,)], "k long")
    publish_snapshot(v1, tmp)
    cur = read_current(spark, tmp)
    publish_snapshot(cur.filter("k > 1"), tmp)        # derived from the version being read
    assert [r.k for r in read_current(spark, tmp).collect()] == [2]
    assert sorted(r.k for r in cur.collect()) == [1, 2]  # the old version is untouched


def test_coverage_with_a_hot_company(spark):
    # one company holds a third of all filings: results stay exact and the per-cell counts are
    # pre-aggregated map-side (partial aggregation) before any shuffle on the company key
    rows = [(i, "HOT" if i % 3 == 0 else f"C{i % 50}", str(i), "10-K" if i % 2 else "10-Q", None, 2000 + i % 3)
            for i in range(3000)]
    wanted = idx(spark, rows)
    company = spark.createDataFrame([("HOT",)] + [(f"C{j}",) for j in range(50)], "ticker string")
    held = spark.createDataFrame([(i,) for i in range(0, 3000, 4)], "k long")
    body = spark.createDataFrame([(i, 10 if i % 5 else 0) for i in range(3000)], "k long, body_chars long")
    cov = coverage.company_coverage(company, wanted, held, body, 6)
    out = {r.ticker: r for r in cov.collect()}
    hot = [r for r in rows if r[1] == "HOT"]
    assert out["HOT"].n_expected == len(hot) == 1000
    assert out["HOT"].n_held == sum(1 for r in hot if r[0] % 4 == 0)
    assert out["HOT"].n_new == sum(1 for r in hot if r[0] % 4 and r[0] % 5)
    assert sum(r.n_expected for r in out.values()) == 3000
    plan = cov._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan or "partial_sum" in plan


def test_outcome_statuses_use_the_latest_completion(spark):
    from ledgerline.operators import runs

    company = spark.createDataFrame([(1, "A"), (2, None), (3, "C"), (4, "D")], "list_pos long, ticker string")
    t = dt.datetime(2024, 1, 1)
    done = spark.createDataFrame(
        [("run_1", 1, "A", t, False), ("run_2", 2, "A", t + dt.timedelta(days=1), True),   # later success wins
         ("run_1", 3, "C", t, True), ("run_1", 4, "C", t + dt.timedelta(hours=1), False)],  # later failure wins
        "run_id string, item long, ticker string, ts timestamp_ntz, ok boolean")
    out = {r.list_pos: (r.status, r.run_id) for r in runs.outcome(company, runs.latest_outcome(done)).collect()}
    assert out == {1: ("success", "run_2"), 2: ("missing_ticker", None), 3: ("failed", "run_1"), 4: ("not_run", None)}


def test_failed_list_is_cut_into_bounded_lines(spark):
    from ledgerline.operators import runs

    t = dt.datetime(2024, 1, 1)
    done = spark.createDataFrame([("r", i, f"F{i}", t + dt.timedelta(seconds=i), False) for i in range(250)],
                                 "run_id string, item long, ticker string, ts timestamp_ntz, ok boolean")
    lines = sorted(runs.failed_lines(done, per_line=100).collect(), key=lambda r: r.line_no)
    assert [r.n_tickers for r in lines] == [100, 100, 50]
    assert lines[0].tickers.split(", ")[:3] == ["F0", "F1", "F2"] and lines[2].tickers.endswith("F249")


def test_generated_worklist_is_not_broadcast(spark):
    """Its estimated size leaves out what explode multiplies, so it must not be the side that every task holds."""
    from ledgerline.operators import worklist

    company = spark.range(50).selectExpr("concat('T', id) AS ticker")
    index = spark.range(200).selectExpr("concat('T', id % 40) AS ticker", "IF(id % 2 = 0, '10-K', '10-Q') AS form",
                                        "make_date(1998 + CAST(id % 5 AS INT), 3, 1) AS filing_date", "id AS accession")
    got = worklist.match_work_index(worklist.plan_work(company, (1999, 2001)), index)
    assert "SortMergeJoin" in got._jdf.queryExecution().sparkPlan().toString()
    assert got.count() == index.filter("year(filing_date) BETWEEN 1999 AND 2001").count() == 120
