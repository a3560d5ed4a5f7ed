"""Scalar column functions. All are built-in Spark expressions: no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
CIK_WIDTH = 10
STAGING_ROOT = "sp500_filings_data"
ARCHIVE_PREFIX = "sp500_filings_data_"
RUN_PREFIX = "run_"
DEFAULT_FORMS = ("10-K", "10-Q")
DEFAULT_YEARS = 10
DEFAULT_BATCH_SIZE = 12
UNKNOWN_NAME = "Unknown"
MB = 1024 * 1024


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cik_pad(c) -> Column:
    """Zero-fill a CIK to 10 characters, never truncating a longer value (plain lpad truncates)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) >= CIK_WIDTH, s).otherwise(F.lpad(s, CIK_WIDTH, "0"))


def name_or_unknown(c) -> Column:
    return F.coalesce(_c(c), F.lit(UNKNOWN_NAME))


def has_ticker(c) -> Column:
    """A usable ticker: present and not empty."""
    t = _c(c)
    return t.isNotNull() & (F.length(t) > 0)


def form_segment(c) -> Column:
    """A form name as one path segment: '/' (as in amendment forms) is percent-encoded."""
    return F.replace(_c(c), F.lit("/"), F.lit("%2F"))


def rel_path(ticker, year, form, accession) -> Column:
    """ticker/year/form/accession.html — the staged-tree layout."""
    return F.concat_ws(
        "/", _c(ticker), _c(year).cast("string"), form_segment(form), F.concat(_c(accession), F.lit(".html"))
    )


def member_name(path, root: str = STAGING_ROOT) -> Column:
    """Archive member name of a staged file: root/ticker/year/form/accession.html."""
    return F.concat(F.lit(root + "/"), _c(path))


def path_company(member, root: str = STAGING_ROOT) -> Column:
    """Company of an archive member: second path segment when the first is the staging root."""
    parts = F.split(_c(member), "/")
    return F.when((F.size(parts) >= 2) & (F.element_at(parts, 1) == F.lit(root)), F.element_at(parts, 2))


def file_stem(path) -> Column:
    """Base name without its last extension."""
    base = F.element_at(F.split(_c(path), "/"), -1)
    return F.regexp_replace(base, r"\.[^.]*$", "")


def batch_no_from_name(path, prefix: str = ARCHIVE_PREFIX) -> Column:
    """Batch number = integer after the last '_' of the stem; null (rejected) when it is not an
    integer, when the stem lacks the archive prefix or the name does not end in '.tar'."""
    stem = file_stem(path)
    last = F.trim(F.element_at(F.split(stem, "_"), -1))
    ok = stem.startswith(prefix) & _c(path).endswith(".tar") & last.rlike(r"^[+-]?[0-9]+$")
    return F.when(ok, last.try_cast("bigint"))


def epoch_text(seconds) -> Column:
    """Epoch seconds as 'yyyy-MM-dd HH:mm:ss' (UTC wall clock), computed on a timestamp without
    time zone so the session time zone cannot shift it."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("SECOND", _c(seconds), epoch), "yyyy-MM-dd HH:mm:ss")


def size_mb(c) -> Column:
    return _c(c).cast("double") / F.lit(float(MB))


def year_month(c) -> Column:
    return F.date_format(_c(c), "yyyy_MM")


def is_html_path(c) -> Column:
    return F.lower(_c(c)).rlike(r"\.html?$")


def is_unsafe_member(c) -> Column:
    """Absolute member names or names with a '..' segment would escape the target folder."""
    m = _c(c)
    return m.startswith("/") | F.array_contains(F.split(m, "/"), "..")


def duration_text(seconds) -> Column:
    """Human duration: '12.3s' under a minute, '3m 4s' under an hour, else '1h 2m'."""
    s = _c(seconds).cast("double")
    whole = F.floor(s).cast("bigint")
    return (
        F.when(s < 60, F.format_string("%.1fs", s))
        .when(s < 3600, F.format_string("%dm %ds", F.floor(s / 60).cast("bigint"), whole % 60))
        .otherwise(F.format_string("%dh %dm", F.floor(s / 3600).cast("bigint"), F.floor((s % 3600) / 60).cast("bigint")))
    )


def batch_of(rank, batch_size: int) -> Column:
    """1-based batch number of a 1-based rank: rows 1..B -> 1, B+1..2B -> 2, ..."""
    zero_based = _c(rank).cast("bigint") - F.lit(1)
    return F.call_function("div", zero_based, F.lit(int(batch_size))) + F.lit(1)
