"""Sequence packing: shortest-pack-first over the histogram of piece lengths.

Documents are tokenised, closed with an end id and cut into pieces of at most the capacity. The
histogram of piece lengths has at most ``capacity`` entries, so it is planned on the driver:
lengths are placed longest first, each into the pack that is shortest so far, for whole counts of
identical packs at a time. The resulting packing patterns are joined back to the pieces by their
exact rank among pieces of equal length.

A null or empty text is a document of the end id alone. Repeated rows are packed once each. An
empty table gives an empty result. Of the input only the id and text columns are read.
"""

from __future__ import annotations

import functools
import heapq
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import bpe
from ledgerline.llm import textkit as tk
from ledgerline.operators.ranking import ordered_rank
from ledgerline.session import scratch_dir, ship_package

class JsonCodec:
    """Ids of a byte-level BPE tokenizer file: the vectorised codec for ordinary texts, and the
    tokenizers library itself for texts that hold the string of an added token."""

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        to_byte = {c: b for b, c in byte_letters().items()}
        model, self.definition = parsed["model"], definition
        self.added = [t["content"] for t in parsed.get("added_tokens", [])]
        vocab = {bytes(to_byte[c] for c in token): i for token, i in model["vocab"].items() if token not in self.added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in merges]
        if made != sorted(made):
            raise ValueError("merge order and id order differ; ids are no ranks here")
        self.codec = bpe.Codec(vocab)

    def encode_slice(self, t: tk.Texts) -> tuple[np.ndarray, np.ndarray]:
        ids, offs = self.codec.encode_slice(t)
        raw = t.data.tobytes()
        odd = [i for i in range(t.rows) if any(raw.find(a.encode(), t.offs[i], t.offs[i + 1]) >= 0 for a in self.added)
               ] if any(a.encode() in raw for a in self.added) else []
        if not odd:
            return ids, offs
        parts = [ids[offs[i]:offs[i + 1]] for i in range(t.rows)]
        for i in odd:
            text = raw[t.offs[i]:t.offs[i + 1]].decode()
            parts[i] = np.array(self._library().encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def _library(self):
        if "_tokenizer" not in self.__dict__:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_str(self.definition)
        return self._tokenizer

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tokenizer"}


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


@functools.cache
def json_codec(path: str) -> JsonCodec:
    with open(path, encoding="utf-8") as f:
        return JsonCodec(f.read())


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Cut every document's ids (with ``end_id`` last) into pieces of at most ``capacity``.

    Returns doc_id, start, length, ids_crc32, doc_tokens and, if kept, the packed ids.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(json_codec(tokenizer_path))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)]
                          + [T.StructField(c, T.LongType()) for c in names[1:5]]
                          + [T.StructField("ids", T.BinaryType())] * keep_ids)

    def run(batches):
        last = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for t in tk.text_slices(texts):
                ids, offs = shared.value.encode_slice(t)
                flat, ends = ids.tobytes(), offs * 4
                owner, starts, lengths, crcs, totals, packed = [], [], [], [], [], []
                for i in range(t.rows):
                    own = flat[ends[i]:ends[i + 1]] + last
                    for at in range(0, len(own), 4 * capacity):
                        part = own[at:at + 4 * capacity]
                        owner.append(t.first + i)
                        starts.append(at // 4)
                        lengths.append(len(part) // 4)
                        crcs.append(zlib.crc32(part))
                        totals.append(len(own) // 4)
                        if keep_ids:
                            packed.append(part)
                columns = [keys.take(pa.array(owner, pa.int64())),
                           *(pa.array(c, pa.int64()) for c in (starts, lengths, crcs, totals))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(packed, pa.binary())] * keep_ids, names=names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def plan_packs(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns as (how many packs, [(length, times), ...]) by shortest-pack-first.

    Every length adds at most two patterns (a split one and a new one), so there are at most
    2 * capacity; a pattern's distinct lengths sum to at most the capacity, so it has at most
    sqrt(2 * capacity) entries.
    """
    open_packs: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # filled, tie, count, pattern
    done, ties = [], 0

    def put(filled, count, pattern):
        nonlocal ties
        if filled == capacity:
            done.append((count, pattern))
        else:
            ties += 1
            heapq.heappush(open_packs, (filled, ties, count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit {capacity}")
        while left > 0:
            if not open_packs or open_packs[0][0] + length > capacity:
                put(length, left, [(length, 1)])
                break
            filled, _, count, pattern = heapq.heappop(open_packs)
            # how often the length fits all these packs before another pack is the shortest
            following = open_packs[0][0] if open_packs else capacity
            times = max(1, min(left // count, (capacity - filled) // length, (following - filled) // length))
            used = count if left >= count else left
            if used < count:
                put(filled, count - used, pattern)
            last = pattern[-1]
            grown = (pattern[:-1] + [(length, last[1] + times)]) if last[0] == length else pattern + [(length, times)]
            put(filled + times * length, used, grown)
            left -= used * times
    return done + [(count, pattern) for _, _, count, pattern in open_packs]


def pattern_slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """One row per (pattern, length): length, first rank, ranks, packs, first sequence, offset.

    Rank r of a length (from 0) lies in the row with first <= r < first + ranks; with d = r - first
    it goes to sequence ``first sequence + d % packs`` at ``offset + (d // packs) * length``.
    """
    rows, taken, sequence = [], {}, 0
    for count, pattern in patterns:
        offset = 0
        for length, times in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, count * times, count, sequence, offset))
            taken[length] = first + count * times
            offset += times * length
        sequence += count
    out = np.array(rows, dtype=np.int64).reshape(-1, 6)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    ``pieces`` is read three times (histogram, range bounds, ranking): pass a written table.
    ``order`` ranks pieces of equal length; ties fall in any order, each to its own place.
    """
    spark = pieces.sparkSession
    ship_package(spark)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most 2 * capacity * sqrt(2 * capacity) rows of 48 bytes: 13 MB at 2048
    slots = spark.sparkContext.broadcast(pattern_slots(plan_packs(histogram, capacity)))
    ranked = ordered_rank(pieces, order, groups=("length",), rank_col="_rank", max_groups=capacity)
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = T.StructType([pieces.schema[c] for c in kept]
                          + [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")])

    def place(batches):
        table = slots.value
        big = int(table[:, 1:3].sum(axis=1).max()) + 1 if len(table) else 1
        keys = table[:, 0] * big + table[:, 1]
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(names.index("_rank")).to_numpy(zero_copy_only=False) - 1
            row = table[np.searchsorted(keys, length * big + rank, side="right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index(c)) for c in kept]
                + [pa.array(row[:, 4] + nth % row[:, 3]), pa.array(row[:, 5] + nth // row[:, 3] * length)],
                names=[*kept, "sequence_id", "offset"])

    return ranked.select(*kept, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id",
                   text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack whole documents; the pieces are written once to the shared folder."""
    spark = docs.sparkSession
    at = scratch_dir(spark, "pieces")
    token_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, keep_ids).write.parquet(at)
    return pack(spark.read.parquet(at), capacity)
