"""Best-fit packing: pieces against the tokenizers library, places checked one by one, plans against bounds."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import best_fit, packing, queries

SF = "/root/testdata/sf0.001"
FILE = P.path("byte_bpe_50k.json")
TEXTS = [None, "", "one", "a b c " * 40, "x" * 3000, "été 中文 😀 " * 60, "<|endoftext|> in a text", "word " * 63, "word " * 64,
         "word " * 127, "line\n" * 200] + [f"text number {i} " * (i % 17) for i in range(80)]


def expected_pieces(rows, end_id, capacity):
    encoder = Tokenizer.from_file(FILE)
    out = Counter()
    for doc_id, text in rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [end_id]
        rest = len(ids) % capacity
        cuts = ([0] if rest else []) + list(range(rest, len(ids) + 1, capacity))
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[doc_id, piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    return out


def check_places(got, capacity):
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def least(histogram, capacity):
    """No packing has fewer: tokens over capacity, or the pieces that share no sequence."""
    return max(-(-sum(k * n for k, n in histogram.items()) // capacity), sum(n for k, n in histogram.items() if 2 * k > capacity))


def best_fit_decreasing(histogram, capacity):
    rooms = []
    for length in sorted(Counter(histogram).elements(), reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.fixture(scope="module")
def docs(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (3, "other text"), (None, "null id"), (None, None)]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, piece int, sequence_id string")
    return rows, table.repartition(3)


def test_pieces_and_places(spark, docs):
    rows, table = docs
    placed = best_fit.pack_documents(table, FILE, end_id=2, capacity=64, keep_ids=True)
    got = placed.collect()
    want = expected_pieces(rows, 2, 64)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    histogram = Counter()
    for key, n in want.items():
        histogram[key[3]] += n
    made = check_places(got, 64)
    assert made <= best_fit_decreasing(histogram, 64)
    joined = best_fit.sequences(placed).collect()
    assert len(joined) == made and sum(len(r.ids) for r in joined) == 4 * sum(k * n for k, n in histogram.items())
    own = {(r.sequence_id, r.offset): r for r in got}
    for r in joined:
        assert len(r.ids) == 4 * r.n_tokens
        for (sequence, offset), piece in own.items():
            if sequence == r.sequence_id:
                assert r.ids[4 * offset:4 * (offset + piece.length)] == piece.ids


def test_query_on_the_whole_table(spark):
    got = queries.queries()["op12_best_fit"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = expected_pieces(rows, 2, 1024)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    histogram = Counter(r.length for r in got)
    assert check_places(got, 1024) <= 1.01 * least(histogram, 1024) + 1


def test_first_piece_takes_the_rest():
    assert best_fit.piece_bounds(1, 4) == [(0, 1)] and best_fit.piece_bounds(4, 4) == [(0, 4)]
    assert best_fit.piece_bounds(9, 4) == [(0, 1), (1, 5), (5, 9)]


@pytest.mark.parametrize("seed", range(40))
def test_plan_uses_every_piece_and_is_no_worse_than_best_fit(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([8, 31, 64, 100])
    histogram = {rnd.randint(1, capacity): rnd.randint(1, 40) for _ in range(rnd.randint(1, 60))}
    patterns = best_fit.plan(histogram, capacity)
    used = Counter()
    for count, pattern in patterns:
        assert count > 0 and sum(length * times for length, times in pattern) <= capacity
        for length, times in pattern:
            used[length] += count * times
    assert used == Counter(histogram)
    made = sum(count for count, _ in patterns)
    assert least(histogram, capacity) <= made <= best_fit_decreasing(histogram, capacity)


def test_gaps_are_filled_exactly():
    for parts in ((40,), (30, 10), (20, 15, 5), (20, 10, 10)):
        index = best_fit.ComplementIndex(Counter(parts), 100)
        assert list(index.filling(40))[0] == parts
        assert index.take(parts) == 1 and list(index.filling(40)) == []
    patterns = best_fit.plan({60: 1000, 20: 1000, 15: 1000, 5: 1000}, 100)
    assert sum(count for count, _ in patterns) == 1000
    assert all(sum(length * times for length, times in pattern) == 100 for _, pattern in patterns)


def test_hot_length_and_large_counts():
    patterns = best_fit.plan({600: 10**12, 424: 10**12 // 2, 100: 7}, 1024)
    assert sum(count for count, _ in patterns) == 10**12 and len(patterns) < 10
    assert len(packing.pattern_slots(patterns)) < 20


def test_lengths_out_of_range_and_empty_tables(spark, docs):
    with pytest.raises(ValueError):
        best_fit.plan({0: 1}, 10)
    with pytest.raises(ValueError):
        best_fit.plan({11: 1}, 10)
    empty = spark.createDataFrame([], "doc_id long, text string")
    placed = best_fit.pack_documents(empty, FILE, 2, keep_ids=True)
    assert placed.count() == 0 and best_fit.sequences(placed).count() == 0
