"""The rows of the queries without SQL, and of the pipeline, against plain versions over the whole table."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from test_llm_operators import (SF, WORD, components_by_force, counts_by_force, lines_by_force, pii_by_force, secrets_by_force,
                                tokenizer)  # noqa: F401 - a fixture
from tokenizers import Tokenizer

from ledgerline.llm import quality, queries, secrets


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def of(spark, name):
    return queries.queries()[name](spark, SF).collect()


def test_op2_digests(spark, rows, tokenizer):  # noqa: F811
    want = Counter()
    for d, t in rows:
        ids = tokenizer.encode_ordinary(t or "")
        want[d, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(t or "")] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in of(spark, "op2_bpe")) == want


def test_op5_counts_and_verdicts(spark, rows):
    got = of(spark, "op5_quality")
    want = Counter()
    for d, t in rows:
        n, chars, symbols, dup, repeat = counts_by_force(t or "")
        want[d, n, chars, symbols, dup, repeat, n < 10 or 100 * repeat > 20 * n] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(r.kept == (not r.base_failed and r.probability >= quality.THRESHOLD) for r in got)


def test_op5_kept_follows_the_labels(spark):
    sf = "/root/testdata/sf0.01"  # the smallest tables have too few labels of low quality for a model
    got = queries.queries()["op5_quality"](spark, sf).filter("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n, right = got.selectExpr("count(*)", "count_if(kept = (quality = 1))").first()
    assert n > 300 and right >= 0.97 * n


def test_op6_counts_and_digests(spark, rows):
    gone = lines_by_force(rows)
    want = Counter()
    for i, (d, t) in enumerate(rows):
        own = (t or "").split("\n")
        kept = "\n".join(x for k, x in enumerate(own) if k not in gone[i])
        want[d, sum(bool(WORD.search(x)) for x in own), len(gone[i]), sha(kept)] += 1
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in of(spark, "op6_line_dedup")) == want


@pytest.mark.parametrize("name, by_force, kinds", [("op7_secrets", secrets_by_force, ("assign", "access", "hex")),
                                                   ("op9_pii", pii_by_force, ("email", "ip", "card", "phone"))])
def test_span_counts_digests_and_lists(spark, rows, name, by_force, kinds):
    want = Counter()
    for d, t in rows:
        spans = by_force(t or "")
        want[(d, *(sum(k == kind for k, _, _ in spans) for kind in kinds), sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))] += 1
    got = of(spark, name)
    assert Counter((r.doc_id, *(r[f"n_{k}"] for k in kinds), r.base_sha256) for r in got) == want
    texts = dict(rows)
    for r in got:
        listed = [s.split(":") for s in r.spans.split(",")] if r.spans else []
        assert sha(",".join(":".join(s) for s in listed if s[0] in kinds)) == r.base_sha256
        assert all(0 <= int(a) < int(b) <= len(texts[r.doc_id] or "") for _, a, b in listed)


def check_packing(got, rows, end_id, capacity):
    encoder = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = Counter()
    for d, t in rows:
        own = encoder.encode(t or "", add_special_tokens=False).ids + [end_id]
        ids[d, struct.pack(f"<{len(own)}I", *own)] += 1
    assert {d for d, _ in ids} == {r.doc_id for r in got} and len(ids) == len(rows)
    whole = dict(ids.keys())
    covered, places = defaultdict(int), defaultdict(list)
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert r.start == covered[r.doc_id] and r.doc_tokens == len(whole[r.doc_id]) // 4
        assert r.ids_crc32 == zlib.crc32(whole[r.doc_id][4 * r.start:4 * (r.start + r.length)])
        covered[r.doc_id] += r.length
        places[r.sequence_id].append((r.offset, r.length))
    assert all(covered[d] == len(whole[d]) // 4 for d in whole)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity


def test_op10_pieces_and_places(spark, rows):
    check_packing(of(spark, "op10_pack"), rows, 1, 2048)


def test_pipeline_rows(spark, rows, tmp):
    """Every stage by hand on what the stage before left; the models' verdicts are the operators' own."""
    import corpus_pipeline

    planted = [(1000 + d, " ".join(reversed((t or "").split())) + f"\nnote {d}\npassword = Zx{d}qW8rT{d}vB") for d, t in rows[:12]]
    rows = rows + planted
    table = spark.read.parquet(f"{SF}/documents.parquet")
    table = table.unionByName(spark.createDataFrame(planted, "doc_id long, text string"), allowMissingColumns=True)
    table.write.parquet(f"{tmp}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp}/labels.parquet")
    table = spark.read.parquet(f"{tmp}/documents.parquet")
    model = quality.fit(table, spark.read.parquet(f"{tmp}/labels.parquet"))
    kept = {r.doc_id for r in quality.score(table, model).collect() if r.kept}
    left = [(d, t) for d, t in rows if d in kept]
    gone = lines_by_force(left)
    after = []
    for i, (d, t) in enumerate(left):
        text = t if not gone[i] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
        if not gone[i] or WORD.search(text):
            after.append((d, text))
    smallest = {d: c for d, _, c in components_by_force(after, 5, 80, 100)}
    after = [(d, t) for d, t in after if smallest[d] == d]
    df = spark.createDataFrame(after, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.scan(df, secrets.fit(df)).collect()}
    final = []
    for d, t in after:
        out, at = "", 0
        for s in spans[d]:
            if s.start >= at:
                out += t[at:s.start] + "[SECRET]"
            at = max(at, s.end)
        final.append((d, out + t[at:]))
    assert len(final) < len(rows) and any("[SECRET]" in t for _, t in final)
    check_packing(corpus_pipeline.run(spark, tmp).collect(), final, 1, 2048)
