import json
import os

import pytest

from ledgerline.sources.company_json import read_company_list, validate_company_list


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_missing_keys_become_null(spark, tmp):
    p = write(os.path.join(tmp, "a.json"), json.dumps([
        {"Ticker": "AAPL", "Company Name": "Apple", "CIK": "0000320193"},
        {"Company Name": "No Ticker", "CIK": "1"},
        {"Ticker": None, "CIK": "2"},
        {"Ticker": "", "CIK": "3"},
    ], indent=4))
    rows = read_company_list(spark, p).collect()
    assert [r.ticker for r in rows] == ["AAPL", None, None, ""]
    assert rows[2].company_name is None


def test_malformed_json_fails_fast(spark, tmp):
    p = write(os.path.join(tmp, "bad.json"), '[{"Ticker": "A",')
    with pytest.raises(Exception):
        read_company_list(spark, p).collect()


def test_missing_file_is_an_error(spark, tmp):
    with pytest.raises(Exception):
        read_company_list(spark, os.path.join(tmp, "nope.json")).collect()


def test_validation_reports_empty_and_corrupt(spark, tmp):
    d = os.path.join(tmp, "lists")
    os.makedirs(d)
    write(os.path.join(d, "empty.json"), "[]")
    write(os.path.join(d, "bad.json"), "[{oops")
    write(os.path.join(d, "ok.json"), json.dumps([{"Ticker": "A"}, {"CIK": "9"}]))
    res = {os.path.basename(r.file_path): r for r in validate_company_list(spark, d).collect()}
    assert res["ok.json"].n_records == 2 and res["ok.json"].n_missing_ticker == 1 and res["ok.json"].valid
    assert res["bad.json"].n_corrupt == 1 and not res["bad.json"].valid
    assert res["empty.json"].n_records == 0 and not res["empty.json"].valid


def test_single_object_is_one_record(spark, tmp):
    p = write(os.path.join(tmp, "obj.json"), json.dumps({"Ticker": "A", "CIK": "1"}))
    assert read_company_list(spark, p).count() == 1


def test_every_kind_of_file_has_an_outcome_and_errors_a_place(spark, tmp):
    d = os.path.join(tmp, "kinds")
    os.makedirs(d)
    texts = {"ok.json": '[{"Ticker": "A"}, {"CIK": "1"}]', "cut.json": '[\n{"Ticker": "é"},\n{"Ticker":', "zero.json": "", "empty.json": "[ ]",
             "object.json": '{"Ticker": "A"}', "text.json": '"A"', "mixed.json": '[{"Ticker": "A"}, 7]', "deep.json": '[{"Ticker": "A"}}]'}
    for name, text in texts.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    open(os.path.join(d, "bytes.json"), "wb").write(b'[\n"\xc3\xa9\xff"]')
    got = {os.path.basename(r.file_path): r for r in validate_company_list(spark, d).collect()}
    assert {n: (r.outcome, r.n_records, r.n_missing_ticker, r.n_corrupt, r.valid) for n, r in got.items()} == {
        "ok.json": ("valid", 2, 1, 0, True), "cut.json": ("malformed", 0, 0, 1, False), "zero.json": ("malformed", 0, 0, 1, False),
        "empty.json": ("empty", 0, 0, 0, False), "object.json": ("single_object", 1, 0, 0, False),
        "text.json": ("not_a_list", 0, 0, 1, False), "mixed.json": ("valid", 1, 0, 1, False),
        "deep.json": ("malformed", 0, 0, 1, False), "bytes.json": ("malformed", 0, 0, 1, False)}
    for name, text in texts.items():
        if got[name].outcome == "malformed":
            with pytest.raises(json.JSONDecodeError) as e:
                json.loads(text)
            assert (got[name].error, got[name].error_line, got[name].error_column, got[name].error_offset) == (
                e.value.msg, e.value.lineno, e.value.colno, e.value.pos)
    assert (got["bytes.json"].error_line, got["bytes.json"].error_column, got["bytes.json"].error_offset) == (2, 3, 4)
    assert validate_company_list(spark, os.path.join(d, "object.json")).first().outcome == "single_object"
