"""Company list readers with the reference's error classes: a missing file and malformed JSON
fail (FAILFAST), missing keys become nulls; validation reports on files of any content without failing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import COMPANY_JSON
from ledgerline.sinks.company_json import KEY_CIK, KEY_NAME, KEY_TICKER


def read_company_list(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Read JSON-array files (``multiline``) or JSON Lines into (ticker, company_name, cik)."""
    df = (spark.read.schema(COMPANY_JSON).option("multiLine", multiline).option("mode", "FAILFAST").json(path))
    return df.select(F.col(KEY_TICKER).alias("ticker"), F.col(KEY_NAME).alias("company_name"),
                     F.col(KEY_CIK).alias("cik"))


OUTCOMES = ("valid", "malformed", "empty", "single_object", "not_a_list")
REPORT = ("file_path string, outcome string, n_records bigint, n_missing_ticker bigint, n_corrupt bigint, "
          "error string, error_line bigint, error_column bigint, error_offset bigint")


def _check(text: str) -> tuple:
    """Outcome, records, records without a ticker, entries that are no records, and the error with its place."""
    import json

    try:
        data = json.loads(text)
    except json.JSONDecodeError as e:
        return "malformed", 0, 0, 1, e.msg, e.lineno, e.colno, e.pos
    if isinstance(data, dict):
        return "single_object", 1, int(data.get(KEY_TICKER) is None), 0, None, None, None, None
    if not isinstance(data, list):
        return "not_a_list", 0, 0, 1, None, None, None, None
    records = [r for r in data if isinstance(r, dict)]
    missing = sum(r.get(KEY_TICKER) is None for r in records)
    return "valid" if data else "empty", len(records), missing, len(data) - len(records), None, None, None, None


def _check_files(batches):
    import pandas as pd

    from ledgerline.sinks.archives import filesystem

    names = [c.split()[0] for c in REPORT.split(", ")]
    for pdf in batches:
        for file_path in pdf["archive_path"]:
            fs, path = filesystem(file_path)
            with fs.open_input_stream(path, compression=None) as f:
                raw = f.read()
            try:
                row = _check(raw.decode("utf-8"))
            except UnicodeDecodeError as e:
                head = raw[:e.start].decode("utf-8")
                row = ("malformed", 0, 0, 1, "invalid UTF-8", head.count("\n") + 1, len(head) - (head.rfind("\n") + 1) + 1, len(head))
            out = pd.DataFrame([(file_path, *row)], columns=names)
            yield out.astype({c: "Int64" for c in names if c.startswith(("error_", "n_"))})


def validate_company_list(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``*.json`` file in a folder (or for one file), whatever is in it: the outcome (``OUTCOMES``; a file
    without a byte is malformed), records, records without a ticker, entries that are no records, and for a
    malformed file the parser's message and where it stopped (line and column from 1, offset in code points
    from 0). ``valid``: an array of records that is not empty.

    Each file is read once, whole, by one task: a list file is one JSON value and cannot be split."""
    from ledgerline.session import ship_package
    from ledgerline.sources.archives import list_files, spread

    ship_package(spark)
    if path.endswith(".json"):
        files = spark.createDataFrame([(path,)], "archive_path string")
    else:
        files = list_files(spark, path, "*.json").select("archive_path")
    report = spread(files).mapInPandas(_check_files, REPORT)
    return report.withColumn("valid", (F.col("outcome") == "valid") & (F.col("n_corrupt") == 0))
