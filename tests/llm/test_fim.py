"""Fill-in-middle against a plain version: cuts, forms, outputs, and texts rebuilt from the outputs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import fim

ROWS = [(1, None), (2, ""), (3, "one line"), (4, "a\nb\nc\n"), (5, "\n\n\n"), (6, "é\n中文\n😀 last"), (7, "has <S> inside\nx"),
        (8, "<P"), (9, "<\n<P\n>M>\nS><\n"), (10, "\n".join(f"line {i} ü" for i in range(3000))), (11, "x" * 300_000 + "\ny"),
        (None, "null\nid\n"), (4, "a\nb\nc\n"), (4, "same id\nother text\n"), (12, "\r\n\r\n"), (13, "nul \x00 byte\n\x00")]
ROWS += [(100 + i, "".join(random.Random(i).choice(["ab\n", "c", "é\n", "\n", "dd "]) for _ in range(i))) for i in range(60)]


def plain_version(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t, "kept", "clash") for i, t in ROWS],
                                 "doc_id long, text string, _text string, FORM string").repartition(3)


@pytest.mark.parametrize("template", [fim.Template(), fim.Template(seed=1, rate=60, spm=100), fim.Template(seed=2, spm=0)])
def test_output_and_restored_text(rows, template):
    out = fim.restore(fim.transform(rows, template))
    assert out.columns == ["doc_id", "_text", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    got = out.collect()
    want = [plain_version(i, t, template.seed, template.rate, template.spm) for i, t in ROWS]
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter(want)
    assert Counter((r.doc_id, r.restored) for r in got) == Counter((i, t or "") for i, t in ROWS)
    assert {r._text for r in got} == {"kept"}


def test_rotation_exchanges_blocks():
    rnd = random.Random(3)
    for size in (0, 1, 2, 5, 64, 1000, 3 * fim.SWAP_BYTES + 17):
        for _ in range(6):
            a, b, c = sorted(rnd.randint(0, size) for _ in range(3))
            data = bytes(rnd.randrange(256) for _ in range(size))
            buf = bytearray(data)
            fim.rotate(np.frombuffer(buf, dtype=np.uint8), a, b, c)
            assert buf == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_all_cuts_come_back():
    text = "a\nbé\n\nc<".encode()
    for form in (fim.PSM, fim.SPM):
        for first in range(len(text) + 1):
            for second in range(first, len(text) + 1):
                out = bytes(fim.arrange(text, first, second, form))
                p, m, s = text[:first], text[first:second], text[second:]
                assert out == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == fim.PSM else b"<S>" + s + b"<P>" + p + b"<M>" + m)
                assert fim.rearrange(out, form) == text


def test_output_without_a_sentinel_is_an_error():
    with pytest.raises(ValueError):
        fim.rearrange(b"<P>ab<S>c", fim.PSM)


def test_text_is_kept_on_request_and_tables_may_be_empty(spark, rows):
    assert fim.transform(rows, keep_text=True).filter(F.coalesce("text", F.lit("")) != F.col("output")).count() > 0
    assert fim.restore(fim.transform(rows.limit(0))).count() == 0
    one = fim.transform(spark.createDataFrame([(1, "a\nb")], "doc_id int, text string"))
    assert one.schema["doc_id"].dataType.simpleString() == "int" and one.count() == 1
