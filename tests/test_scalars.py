from pyspark.sql import functions as F

from ledgerline.functions import scalars as S


def one(spark, col, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(col(F.col("v")).alias("r")).first()["r"]


def test_cik_pad_never_truncates(spark):
    assert one(spark, S.cik_pad, "320193") == "0000320193"
    assert one(spark, S.cik_pad, "0000320193") == "0000320193"
    assert one(spark, S.cik_pad, "12345678901") == "12345678901"
    assert one(spark, S.cik_pad, None) is None


def test_batch_number_from_archive_name(spark):
    assert one(spark, S.batch_no_from_name, "runs/run_1/sp500_filings_data_3.tar") == 3
    assert one(spark, S.batch_no_from_name, "sp500_filings_data_x.tar") is None
    assert one(spark, S.batch_no_from_name, "sp500_filings_data_x_3.tar") == 3
    assert one(spark, S.batch_no_from_name, "sp500_filings_data_10.tar") == 10
    assert one(spark, S.batch_no_from_name, "other_3.tar") is None
    assert one(spark, S.batch_no_from_name, "sp500_filings_data_3.zip") is None


def test_path_company_and_unsafe_members(spark):
    assert one(spark, S.path_company, "sp500_filings_data/MSFT/2024/10-Q/x.html") == "MSFT"
    assert one(spark, S.path_company, "sp500_filings_data") is None
    assert one(spark, S.path_company, "elsewhere/MSFT") is None
    assert one(spark, S.is_unsafe_member, "/abs/a") is True
    assert one(spark, S.is_unsafe_member, "a/../../b") is True
    assert one(spark, S.is_unsafe_member, "a/b..c/d") is False


def test_rel_path_encodes_amendment_form(spark):
    df = spark.createDataFrame([("T1", 2000, "10-K/A", "42")], "t string, y long, f string, a string")
    assert df.select(S.rel_path("t", "y", "f", "a")).first()[0] == "T1/2000/10-K%2FA/42.html"


def test_duration_text(spark):
    assert one(spark, S.duration_text, 12.34, "double") == "12.3s"
    assert one(spark, S.duration_text, 184.0, "double") == "3m 4s"
    assert one(spark, S.duration_text, 3720.0, "double") == "1h 2m"


def test_batch_of(spark):
    df = spark.range(1, 26).select(S.batch_of(F.col("id"), 12).alias("b"))
    assert [r.b for r in df.collect()] == [1] * 12 + [2] * 12 + [3]


def test_year_month_html_and_stems(spark):
    import datetime as dt

    assert one(spark, S.year_month, dt.date(2024, 3, 9), "date") == "2024_03"
    assert one(spark, S.is_html_path, "a/B.HTM") is True
    assert one(spark, S.is_html_path, "a/b.html.bak") is False
    assert one(spark, S.file_stem, "runs/r/sp500_filings_data_12.tar") == "sp500_filings_data_12"
    assert one(spark, S.batch_no_from_name, "runs/r/sp500_filings_data_12.3.tar") is None


def test_epoch_text_ignores_session_time_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, S.epoch_text, 86400 + 3661, "long") == "1970-01-02 01:01:01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_batch_number_parse_matches_the_integer_rule(spark):
    """Property: the parser accepts exactly the names whose stem
    starts with the prefix and whose last '_' part is an integer (Python's int() on ASCII)."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    tails = st.text(alphabet="0123456789+- x", min_size=0, max_size=6)

    def expected(name):
        if not name.endswith(".tar"):
            return None
        stem = name[:-4]
        if not stem.startswith(S.ARCHIVE_PREFIX):
            return None
        try:
            return int(stem.split("_")[-1])
        except ValueError:
            return None

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.sampled_from([S.ARCHIVE_PREFIX, S.ARCHIVE_PREFIX + "x_", "other_"]), tails,
                              st.sampled_from([".tar", ".zip"])), min_size=40, max_size=80))
    def check(parts):
        names = [p + t + e for p, t, e in parts]
        df = spark.createDataFrame([(n,) for n in names], "n string")
        got = [r.b for r in df.select(S.batch_no_from_name(F.col("n")).alias("b")).collect()]
        assert got == [expected(n) for n in names]

    check()
