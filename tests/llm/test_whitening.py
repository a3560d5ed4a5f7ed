"""Whitening against whole-number arithmetic in plain Python."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def by_hand(rows, width, components=8):
    """n, {row number: deviation}, whitened rows, explained shares and the model, from Python integers."""
    fit = [(k, [math.floor(1024 * float(c)) + 100_000 for c in v]) for k, (_, v) in enumerate(rows)
           if v is not None and len(v) == width and all(c is not None and math.isfinite(c) and abs(c) < 2 ** 52 for c in v)]
    n = len(fit)
    sums = [sum(x[j] for _, x in fit) for j in range(width)]
    off = {k: [n * x[j] - sums[j] for j in range(width)] for k, x in fit}
    deviation = {k: sum(d * d for d in ds) for k, ds in off.items()}
    cov = np.array([[float(Fraction(sum(ds[i] * ds[j] for ds in off.values()), n ** 3)) for j in range(width)] for i in range(width)])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > np.trace(cov) * width * 2.0 ** -50]
    white = {k: (np.array([d / n for d in ds]) @ vectors[:, order]) / np.sqrt(values[order]) for k, ds in off.items()}
    return n, deviation, white, values[order] / np.trace(cov)


def compare(got, rows, width, components=8, tolerance=1e-7):
    n, deviation, white, explained = by_hand(rows, width, components)
    of = {rows[k][0]: k for k in deviation}
    assert len(of) == n and len(got) == n * len(explained)
    table = np.full((len(rows), len(explained)), np.nan)
    for r in got:
        k = of[r.vec_id]
        assert r.n == n and r.deviation == (deviation[k] if deviation[k] < 10 ** 38 else None)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-6)
        assert 0 <= r.identity_error <= 1e-4
        table[k, r.component - 1] = r.whitened
    for c in range(len(explained)):
        want = np.array([white[k][c] for k in sorted(white)])
        have = table[sorted(white), c]
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < tolerance * max(1, np.abs(want).max())
    have = table[sorted(white)]
    centred = have - have.mean(axis=0)
    assert np.abs(centred.T @ centred / n - np.eye(len(explained))).max() < 1e-4


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, deviation string, _v int").repartition(3)


def vectors(seed, n, width, spread=1.0):
    rnd = np.random.default_rng(seed)
    mixing = rnd.normal(size=(width, width)) * np.linspace(3, 0.2, width)
    return [(i, (spread * (rnd.normal(size=width) @ mixing)).tolist()) for i in range(n)]


AWKWARD = [(1000, None), (1001, []), (1002, [1.0, None, 2.0, 0.0, 0.0]), (1003, [float("nan")] * 5), (1004, [float("inf")] + [0.0] * 4),
           (1005, [1.0, 2.0]), (1006, [2.0 ** 60] + [0.0] * 4), (1007, [0.0] * 5), (1008, [-0.5] * 5)]


def test_awkward_rows_against_whole_numbers(spark):
    rows = vectors(1, 150, 5) + AWKWARD
    rows += [(2000 + i, rows[7][1]) for i in range(200)]  # a vector that more than half of all rows share
    got = whitening.whiten(frame(spark, rows, "double")).collect()
    compare(got, rows, 5)


def test_fewer_components_and_other_block_sizes(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 6 * 64)
    rows = vectors(2, 500, 6)
    compare(whitening.whiten(frame(spark, rows, "double"), components=3).collect(), rows, 6, 3)


def test_numbers_beyond_64_bits(spark):
    rows = vectors(3, 70, 4, spread=2.0 ** 46)
    got = whitening.whiten(frame(spark, rows, "double")).collect()
    assert max(r.deviation or 0 for r in got) > 2 ** 63
    compare(got, rows, 4)


@pytest.mark.parametrize("high", [1, 300, 2 ** 13, 2 ** 40, 2 ** 62])
def test_weighted_popcounts(high):
    rnd = random.Random(high)
    x = np.array([[rnd.randint(-high, high), 7, rnd.randint(0, 3)] for _ in range(131)], dtype=np.int64)
    low = x.min(axis=0)
    y = [[int(v) - int(lo) for v, lo in zip(r, low)] for r in x]
    bits = np.array([max(r[j] for r in y).bit_length() for j in range(3)])
    sums, products = whitening.weighted_popcounts(whitening.bit_planes(x, low, bits), bits)
    assert [int(s) for s in sums] == [sum(r[j] for r in y) for j in range(3)]
    for i in range(3):
        for j in range(i, 3):
            assert int(products[i, j]) == sum(r[i] * r[j] for r in y)


def test_no_direction_and_no_rows(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, None), (2, [float("nan")])]):
        out = whitening.whiten(frame(spark, rows))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]  # one direction only
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 20
    compare(got, line, 3)


def test_repeated_and_null_ids(spark):
    rows = [(None, v) if i % 5 == 0 else (i // 2, v) for i, v in vectors(5, 60, 3)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 180 and sum(r.vec_id is None for r in got) == 36


def test_query_on_the_whole_table(spark):
    got = queries.queries()["op11_whitening"](spark, SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(got.collect(), rows, len(rows[0][1]))
