"""Corpus queries (worklist, filters, incremental joins, coverage) over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import coverage, incremental, worklist
from ledgerline.plans.registry import query
from ledgerline.sources import fixtures as X
from ledgerline.sources.tables import table

YEARS = X.year_range()
N_CELLS = (YEARS[1] - YEARS[0] + 1) * len(X.FORMS)


@query("qa_company_coverage", """
SELECT c.ticker,
       CAST(count(w.k) AS BIGINT) AS n_expected,
       CAST(count(h.k) AS BIGINT) AS n_held,
       CAST(count(w.k) FILTER (WHERE h.k IS NULL AND coalesce(b.body_chars, 0) > 0) AS BIGINT) AS n_new,
       CAST(count(w.k) FILTER (WHERE h.k IS NULL AND coalesce(b.body_chars, 0) = 0) AS BIGINT) AS n_failed,
       CAST(6 - count(DISTINCT CASE WHEN w.k IS NOT NULL THEN CAST(w.filing_year AS VARCHAR) || '|' || w.form END) AS BIGINT) AS n_empty_cells,
       count(w.k) FILTER (WHERE h.k IS NULL AND coalesce(b.body_chars, 0) = 0) = 0 AS complete
FROM listed c
LEFT JOIN wanted w ON w.ticker = c.ticker
LEFT JOIN held h ON h.k = w.k
LEFT JOIN body_state b ON b.k = w.k
GROUP BY c.ticker
""")
def qa_company_coverage(spark, d):
    """Flagship: per company, filings expected over the window and forms, already held, newly
    landed, failed, and empty (year, form) cells. n_expected = n_held + n_new + n_failed."""
    idx = X.filing_index(spark, d)
    comp = X.company(spark, d)
    # what arrived and what is held come from one scan, joined once
    rows = X.wanted(spark, d, idx, comp).select("k", "ticker", "filing_year", "form").join(X.holdings(spark, d, idx), "k", "left")
    return coverage.coverage_of(comp, rows, N_CELLS)


@query("src_filing_index", """
SELECT ticker, accession, form, filing_date, filing_year FROM filing_index
WHERE form IN ('10-K', '10-Q') AND filing_year BETWEEN 1999 AND 2001
""")
def src_filing_index(spark, d):
    idx = X.filing_index(spark, d)
    out = worklist.filter_year_window(worklist.filter_forms(idx, X.FORMS), YEARS)
    return out.select("ticker", "accession", "form", "filing_date", "filing_year")


@query("src_filing_body", """
SELECT i.accession, b.body_chars, b.body_md5,
       coalesce(b.body_chars, 0) > 0 AS body_landed
FROM filing_index i LEFT JOIN body_state b ON b.k = i.k
""")
def src_filing_body(spark, d):
    idx = X.filing_index(spark, d)
    body = X.body_state(spark, d, idx)
    j = idx.select("k", "accession").join(body, "k", "left")
    return j.select("accession", "body_chars", "body_md5",
                    (F.coalesce("body_chars", F.lit(0)) > 0).alias("body_landed"))


@query("prj_cik_pad", """
SELECT list_pos,
       CASE WHEN length(cik) >= 10 THEN cik ELSE lpad(cik, 10, '0') END AS cik_padded,
       CASE WHEN length(cik || cik || cik || cik) >= 10 THEN cik || cik || cik || cik
            ELSE lpad(cik || cik || cik || cik, 10, '0') END AS cik4_padded
FROM company
""")
def prj_cik_pad(spark, d):
    """CIK zero-filled to 10 and never truncated (the 4× repeated key exceeds 10 digits)."""
    c = X.company(spark, d)
    rep = F.concat("cik", "cik", "cik", "cik")
    return c.select("list_pos", S.cik_pad("cik").alias("cik_padded"), S.cik_pad(rep).alias("cik4_padded"))


@query("prj_company_cols", """
SELECT ticker, company_name, CASE WHEN length(cik) >= 10 THEN cik ELSE lpad(cik, 10, '0') END AS cik
FROM (SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 'T' || CAST(c_custkey AS VARCHAR) END AS ticker,
             CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE c_name END AS company_name,
             CAST(c_custkey AS VARCHAR) AS cik FROM customer)
""")
def prj_company_cols(spark, d):
    """Keep Symbol / Security / CIK of a wide company table and rename them."""
    from ledgerline.operators.companies import company_columns

    return company_columns(_web_table(spark, d))


def _web_table(spark, d):
    """The company list as a wide web-style table (Symbol, Security, sector, nation, CIK...)."""
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal")
    key = F.col("c_custkey")
    return c.select(
        F.when(key % X.NO_TICKER_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(X.TICKER_PREFIX), key.cast("string"))).alias("Symbol"),
        F.when(key % X.NO_NAME_EVERY == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("Security"),
        F.col("c_mktsegment").alias("GICS Sector"),
        F.col("c_nationkey").alias("Headquarters"),
        F.col("c_acctbal").alias("Founded"),
        key.alias("CIK"),
    )


@query("flt_forms", "SELECT accession, form FROM filing_index WHERE form IN ('10-K', '10-Q')")
def flt_forms(spark, d):
    return worklist.filter_forms(X.filing_index(spark, d), X.FORMS).select("accession", "form")


@query("flt_year_window", "SELECT accession, filing_year FROM filing_index WHERE filing_year BETWEEN 1999 AND 2001")
def flt_year_window(spark, d):
    return worklist.filter_year_window(X.filing_index(spark, d), YEARS).select("accession", "filing_year")


@query("flt_year_guard", """
SELECT accession, CAST(year(filing_date) AS BIGINT) AS work_year, filing_date
FROM filing_index WHERE year(filing_date) BETWEEN 1999 AND 2001
""")
def flt_year_guard(spark, d):
    """Candidates fetched by a widened year range; only rows of the requested year survive."""
    g = worklist.year_guard(X.filing_index(spark, d), YEARS)
    return g.select("accession", "work_year", "filing_date")


@query("flt_missing_ticker", """
SELECT list_pos, company_name, false AS success, 'Missing ticker information' AS message
FROM company WHERE ticker IS NULL OR length(ticker) = 0
""")
def flt_missing_ticker(spark, d):
    m = worklist.missing_ticker(X.company(spark, d))
    return m.select("list_pos", "company_name", "success", "message")


@query("prj_name_default", "SELECT list_pos, ticker, coalesce(company_name, 'Unknown') AS company_name FROM company")
def prj_name_default(spark, d):
    return X.company(spark, d).select("list_pos", "ticker", S.name_or_unknown("company_name").alias("company_name"))


@query("prj_rel_path", "SELECT accession, rel_path FROM files")
def prj_rel_path(spark, d):
    st = X.staged(spark, d)
    return st.select("accession", S.rel_path("ticker", "filing_year", "form", "accession").alias("rel_path"))


@query("prj_path_parse", """
SELECT accession, 'sp500_filings_data/' || rel_path AS member, ticker AS company FROM files
""")
def prj_path_parse(spark, d):
    f = X.files(spark, d)
    m = S.member_name("rel_path")
    return f.select("accession", m.alias("member"), S.path_company(m).alias("company"))


@query("prj_batch_no_parse", """
SELECT name, CASE WHEN regexp_full_match(trim(string_split(replace(name, '.tar', ''), '_')[-1]), '[+-]?[0-9]+')
                  THEN CAST(trim(string_split(replace(name, '.tar', ''), '_')[-1]) AS BIGINT) END AS batch_no
FROM (SELECT CASE c_custkey % 3 WHEN 0 THEN 'sp500_filings_data_' || CAST(c_custkey AS VARCHAR) || '.tar'
                               WHEN 1 THEN 'sp500_filings_data_x' || CAST(c_custkey AS VARCHAR) || '.tar'
                               ELSE 'sp500_filings_data_x_' || CAST(c_custkey AS VARCHAR) || '.tar' END AS name
      FROM customer)
""")
def prj_batch_no_parse(spark, d):
    """Archive names in three shapes (valid, '_x<n>', '_x_<n>'): the first and last parse, the
    middle is rejected (null)."""
    c = table(spark, d, "customer", "c_custkey")
    key = F.col("c_custkey").cast("string")
    r = F.col("c_custkey") % 3
    name = (F.when(r == 0, F.concat(F.lit(S.ARCHIVE_PREFIX), key, F.lit(".tar")))
            .when(r == 1, F.concat(F.lit(S.ARCHIVE_PREFIX + "x"), key, F.lit(".tar")))
            .otherwise(F.concat(F.lit(S.ARCHIVE_PREFIX + "x_"), key, F.lit(".tar"))))
    return c.select(name.alias("name")).select("name", S.batch_no_from_name("name").alias("batch_no"))


@query("prj_size_mb", "SELECT accession, size, size / (1024.0 * 1024.0) AS size_mb FROM files")
def prj_size_mb(spark, d):
    return X.files(spark, d).select("accession", "size", S.size_mb("size").alias("size_mb"))


@query("join_worklist", """
SELECT c.ticker, CAST(y.work_year AS BIGINT) AS work_year, f.form
FROM listed c, (SELECT unnest(range(1999, 2002)) AS work_year) y, (SELECT unnest(['10-K', '10-Q']) AS form) f
""")
def join_worklist(spark, d):
    return worklist.plan_work(X.company(spark, d), YEARS, X.FORMS)


@query("join_work_index", """
SELECT c.ticker, CAST(y.work_year AS BIGINT) AS work_year, f.form, i.accession, i.filing_date
FROM listed c, (SELECT unnest(range(1999, 2002)) AS work_year) y, (SELECT unnest(['10-K', '10-Q']) AS form) f,
     filing_index i
WHERE i.ticker = c.ticker AND i.form = f.form AND year(i.filing_date) = y.work_year
""")
def join_work_index(spark, d):
    work = worklist.plan_work(X.company(spark, d), YEARS, X.FORMS)
    idx = worklist.filter_forms(X.filing_index(spark, d), X.FORMS)
    return worklist.match_work_index(work, idx).select("ticker", "work_year", "form", "accession", "filing_date")


@query("join_empty_cells", """
SELECT c.ticker, CAST(y.work_year AS BIGINT) AS work_year, f.form
FROM listed c, (SELECT unnest(range(1999, 2002)) AS work_year) y, (SELECT unnest(['10-K', '10-Q']) AS form) f
WHERE NOT EXISTS (SELECT 1 FROM filing_index i WHERE i.ticker = c.ticker AND i.form = f.form
                  AND year(i.filing_date) = y.work_year)
""")
def join_empty_cells(spark, d):
    work = worklist.plan_work(X.company(spark, d), YEARS, X.FORMS)
    idx = worklist.filter_forms(X.filing_index(spark, d), X.FORMS)
    return worklist.empty_cells(work, idx)


@query("join_skip_existing", """
SELECT ticker, filing_year, form, accession FROM wanted w
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.k = w.k)
""")
def join_skip_existing(spark, d):
    idx = X.filing_index(spark, d)
    new = incremental.skip_existing(X.wanted(spark, d, idx), X.held(spark, d, idx), ["k"])
    return new.select("ticker", "filing_year", "form", "accession")


@query("join_already_held", """
SELECT ticker, filing_year, form, accession FROM wanted w WHERE k IN (SELECT k FROM held)
""")
def join_already_held(spark, d):
    idx = X.filing_index(spark, d)
    old = incremental.already_held(X.wanted(spark, d, idx), X.held(spark, d, idx), ["k"])
    return old.select("ticker", "filing_year", "form", "accession")


@query("join_ticker_lookup", """
SELECT ticker, company_name, cik FROM company
WHERE ticker IN (SELECT ticker FROM filing_index WHERE form = '10-K' AND filing_year = 2001)
""")
def join_ticker_lookup(spark, d):
    """Company rows for a list of tickers (here: those filing a 10-K in 2001)."""
    from ledgerline.operators.companies import lookup_tickers

    idx = X.filing_index(spark, d)
    wanted = idx.filter((F.col("form") == "10-K") & (F.col("filing_year") == 2001)).select("ticker")
    return lookup_tickers(X.company(spark, d), wanted).select("ticker", "company_name", "cik")


@query("agg_filings_per_year", """
SELECT ticker, filing_year, CAST(count(*) AS BIGINT) AS n_filings FROM wanted GROUP BY ticker, filing_year
""")
def agg_filings_per_year(spark, d):
    return X.wanted(spark, d).groupBy("ticker", "filing_year").agg(F.count(F.lit(1)).alias("n_filings"))


@query("agg_new_per_company", """
SELECT c.ticker,
       CAST(count(w.k) FILTER (WHERE h.k IS NULL AND coalesce(b.body_chars, 0) > 0) AS BIGINT) AS n_new
FROM listed c LEFT JOIN wanted w ON w.ticker = c.ticker
LEFT JOIN held h ON h.k = w.k LEFT JOIN body_state b ON b.k = w.k
GROUP BY c.ticker
""")
def agg_new_per_company(spark, d):
    """Newly stored filings per company ('Downloaded N filings'); skips and failures not counted."""
    cov = qa_company_coverage(spark, d)
    return cov.select("ticker", "n_new")


@query("lim_first_n", "SELECT list_pos, ticker, company_name, cik FROM company ORDER BY list_pos LIMIT 10")
def lim_first_n(spark, d):
    """Test mode: the first 10 companies in list order (TakeOrderedAndProject, no global sort)."""
    return X.company(spark, d).orderBy("list_pos").limit(10).select("list_pos", "ticker", "company_name", "cik")


@query("set_union_years", """
SELECT ticker, filing_year, form, accession FROM wanted
""")
def set_union_years(spark, d):
    """Per-year results accumulate into one store: one scan with the year set as a filter
    (a union of per-year scans would read the index once per year)."""
    idx = X.filing_index(spark, d)
    years = list(range(YEARS[0], YEARS[1] + 1))
    per_year = idx.filter(F.col("filing_year").isin(years))
    out = worklist.filter_forms(per_year, X.FORMS).join(
        worklist.usable_companies(X.company(spark, d)).select("ticker"), "ticker", "left_semi")
    return out.select("ticker", "filing_year", "form", "accession")


@query("set_distinct_accession", """
SELECT ticker, filing_year, form, accession, min(filing_date) AS filing_date
FROM (SELECT ticker, filing_year, form, accession, filing_date FROM filing_index
      UNION ALL SELECT ticker, filing_year, form, accession, filing_date FROM staged)
GROUP BY ticker, filing_year, form, accession
""")
def set_distinct_accession(spark, d):
    """Index rows repeated (the index plus the staged copies) collapse to one per path."""
    idx = X.filing_index(spark, d)
    cols = ["ticker", "filing_year", "form", "accession", "filing_date"]
    both = idx.select(*cols).unionByName(X.staged(spark, d, idx).select(*cols))
    return incremental.distinct_by_key(both, ["ticker", "filing_year", "form", "accession"], "filing_date")


@query("fn_scalars", """
SELECT accession, lower(form) AS form_lower, string_split(form, '/')[1] AS form_root,
       ends_with(form, '/A') AS is_amendment, starts_with(ticker, 'T') AS has_prefix,
       TRY_CAST(substr(ticker, 2) AS BIGINT) AS ticker_no,
       strftime(filing_date, '%Y-%m-%d') AS date_text, strftime(filing_date, '%Y_%m') AS year_month,
       CAST(k // 12 AS BIGINT) AS k_div, CAST(k % 12 AS BIGINT) AS k_mod,
       CASE WHEN k % 5000 < 60 THEN printf('%.1fs', CAST(k % 5000 AS DOUBLE))
            WHEN k % 5000 < 3600 THEN printf('%dm %ds', (k % 5000) // 60, (k % 5000) % 60)
            ELSE printf('%dh %dm', (k % 5000) // 3600, ((k % 5000) % 3600) // 60) END AS duration_text,
       array_to_string([ticker, form, accession], ', ') AS joined,
       strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(k * 1000), '%Y-%m-%d %H:%M:%S') AS epoch_text,
       format('{:,}', k * 1000) AS number_text,
       string_split(replace(form, '/', '%2F') || '/' || accession || '.html', '/')[-1] AS base_name
FROM filing_index
""")
def fn_scalars(spark, d):
    """The scalar functions the reference uses, applied to every index row."""
    i = X.filing_index(spark, d)
    secs = F.col("k") % 5000
    path = F.concat(S.form_segment("form"), F.lit("/"), F.col("accession"), F.lit(".html"))
    return i.select(
        "accession",
        F.lower("form").alias("form_lower"),
        F.element_at(F.split("form", "/"), 1).alias("form_root"),
        F.col("form").endswith("/A").alias("is_amendment"),
        F.col("ticker").startswith("T").alias("has_prefix"),
        F.expr("substring(ticker, 2)").try_cast("bigint").alias("ticker_no"),
        F.date_format("filing_date", "yyyy-MM-dd").alias("date_text"),
        S.year_month("filing_date").alias("year_month"),
        F.expr("k div 12").alias("k_div"),
        (F.col("k") % 12).cast("bigint").alias("k_mod"),
        S.duration_text(secs).alias("duration_text"),
        F.array_join(F.array("ticker", "form", "accession"), ", ").alias("joined"),
        S.epoch_text(F.col("k") * 1000).alias("epoch_text"),
        F.format_number(F.col("k") * 1000, 0).alias("number_text"),
        F.element_at(F.split(path, "/"), -1).alias("base_name"),
    )


@query("qa_failed_bodies", """
SELECT i.accession, i.ticker, i.form, i.filing_year FROM filing_index i
WHERE NOT EXISTS (SELECT 1 FROM body_state b WHERE b.k = i.k AND b.body_chars > 0)
""")
def qa_failed_bodies(spark, d):
    idx = X.filing_index(spark, d)
    bad = incremental.failed_bodies(idx, X.body_state(spark, d, idx))
    return bad.select("accession", "ticker", "form", "filing_year")


@query("snk_filing_store", """
SELECT w.ticker, w.filing_year, w.form, w.accession,
       w.ticker || '/' || CAST(w.filing_year AS VARCHAR) || '/' || replace(w.form, '/', '%2F') || '/' || w.accession || '.html' AS rel_path,
       b.body_md5
FROM wanted w JOIN body_state b ON b.k = w.k
WHERE b.body_chars > 0 AND NOT EXISTS (SELECT 1 FROM held h WHERE h.k = w.k)
""")
def snk_filing_store(spark, d):
    """Store each new filing once: landed bodies of wanted filings not yet held are appended to a store in
    folders by (filing_year, form) and buckets by path; the same load is run twice (the second adds
    nothing) and the store is read back with a partition filter on the window."""
    from ledgerline.session import scratch_dir
    from ledgerline.sinks.filing_store import read_store, store_filings

    idx = X.filing_index(spark, d)
    new = incremental.skip_existing(X.wanted(spark, d, idx), X.held(spark, d, idx), ["k"])
    new = new.select("k", "ticker", "filing_year", "form", "accession")
    # the text is attached to the new keys alone, after all key work
    landed = X.attach_body(new, spark, d).filter(F.col("body_chars") > 0)
    rows = X.attach_html(landed.select("k", "ticker", "filing_year", "form", "accession", "body_bytes"), spark, d).drop("k")
    path = scratch_dir(spark, "filing-store")
    store_filings(rows, path)
    store_filings(rows, path)
    st = worklist.filter_year_window(read_store(spark, path), YEARS)
    return st.select("ticker", "filing_year", "form", "accession", "rel_path", F.md5("html").alias("body_md5"))
