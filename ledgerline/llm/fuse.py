"""Static 3-wise binary-fuse filters: built once over a set of 64-bit keys, then only read."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ledgerline.llm import textkit as tk

_U = np.uint64


@dataclass(frozen=True)
class Layout:
    segment: int
    segments: int

    @property
    def size(self) -> int:
        return self.segment * (self.segments + 2)


def layout(n: int) -> Layout:
    """Segment length and count for n keys (the sizes published for 3-wise binary fuse)."""
    segment = 4 if n < 2 else min(1 << 18, 1 << int(np.floor(np.log(n) / np.log(3.33) + 2.25)))
    factor = 0 if n < 2 else max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    return Layout(segment, max(1, -(-int(n * factor) // segment) - 2))


def _places(keys: np.ndarray, seed: int, lay: Layout) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key (in consecutive segments), and its 8-bit fingerprint."""
    h = tk.mix(keys + _U(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    first = ((h >> _U(32)) * _U(lay.segments) >> _U(32)).astype(np.int64)
    g = tk.mix(h)
    inside = lay.segment - 1
    slots = np.stack([(first + k) * lay.segment + ((g >> _U(20 * k)).astype(np.int64) & inside) for k in range(3)])
    return slots, (h ^ (g >> _U(7))).astype(np.uint8)


def build(keys: np.ndarray, first_seed: int = 1) -> tuple[int, np.ndarray]:
    """Seed (from ``first_seed`` on) and fingerprint table for distinct keys.

    Slots that hold a single key are peeled round by round; fingerprints are then assigned in the
    opposite order, so every key's three slots xor to its fingerprint.
    """
    lay = layout(len(keys))
    for seed in range(first_seed, first_seed + 200):
        slots, marks = _places(keys, seed, lay)
        left = np.arange(len(keys))
        rounds = []
        while len(left):
            used = slots[:, left]
            degree = np.bincount(used.ravel(), minlength=lay.size)
            single = degree[used] == 1
            free = single.any(axis=0)
            if not free.any():
                break
            own = single[:, free].argmax(axis=0)
            rounds.append((left[free], own))
            left = left[~free]
        if len(left):
            continue
        table = np.zeros(lay.size, dtype=np.uint8)
        for which, own in reversed(rounds):
            at = slots[:, which]
            value = marks[which]
            for k in range(3):
                value = value ^ np.where(own == k, np.uint8(0), table[at[k]])
            table[at[own, np.arange(len(which))]] = value
        return seed, table
    raise ValueError("no seed peels these keys; are they distinct?")


def contains(keys: np.ndarray, n: int, seed: int, table: np.ndarray) -> np.ndarray:
    """True for every key the filter was built with, and for about one other key in 256."""
    slots, marks = _places(keys, seed, layout(n))
    return (table[slots[0]] ^ table[slots[1]] ^ table[slots[2]]) == marks


def shared_filter(spark, keys, buckets: int, limit_bytes: int = 16 << 20, first_seed: int = 1):
    """A broadcast filter over a ``key`` column of longs, or None where it would exceed the limit.

    The filter is built per bucket (the key modulo ``buckets``) by Spark; about 1.2 bytes a key.
    """
    import pyarrow as pa
    from pyspark.sql import functions as F

    keys = keys.select("key").distinct()
    n = keys.count()
    if n * 1.3 > limit_bytes:
        return None

    def make(table: pa.Table) -> pa.Table:
        own = np.unique(table.column("key").to_numpy().astype(np.int64)).view(_U)
        seed, marks = build(own, first_seed)
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "n": [len(own)], "seed": [seed],
                         "marks": pa.array([marks.tobytes()], pa.binary())})

    rows = (keys.withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)).cast("int")).groupBy("bucket")
            .applyInArrow(make, "bucket int, n long, seed long, marks binary")).collect() if n else []
    return spark.sparkContext.broadcast((buckets, {
        r["bucket"]: (r["n"], r["seed"], np.frombuffer(r["marks"], np.uint8)) for r in rows}))


def probe(shared, keys: np.ndarray) -> np.ndarray:
    """Which signed 64-bit keys the broadcast filter may hold."""
    buckets, tables = shared
    place = np.mod(keys, buckets)
    out = np.zeros(len(keys), dtype=bool)
    for b in np.unique(place).tolist():
        if b in tables:
            here = place == b
            out[here] = contains(keys[here].view(_U), *tables[b])
    return out


def exact_filter(spark, keys, buckets: int, limit_bytes: int = 16 << 20):
    """A cascade of filters that tells ``member`` keys from all the other rows' keys without error.

    ``keys``: a written table of distinct longs ``key`` with a boolean ``member``. The first filter
    holds the members, the second the other keys that the first lets by, the third the members that
    the second lets by, and so on; every level is about 1/256 of the one before the last. None where
    the members' filter would exceed the limit.
    """
    import pyarrow as pa

    levels, inside = [], True
    left = keys
    while True:
        own = left.filter(f"member = {str(inside).lower()}")
        if levels and own.isEmpty():
            return levels
        # seeds of its own for every level: what one level lets by is no more likely to pass the next
        level = shared_filter(spark, own, buckets, limit_bytes, 1 + 1000 * len(levels))
        if level is None:
            return None
        levels.append(level)

        # one function for all levels: a chain of them would take a Python worker each
        def sift(batches, levels=tuple(levels)):
            for batch in batches:
                for level in levels:
                    # the level's own side stays for the level after the next; of the other side, what it lets by
                    batch = batch.filter(pa.array(probe(level.value, batch.column(0).to_numpy())))
                yield batch

        left = keys.select("key", "member").mapInArrow(sift, "key long, member boolean")
        inside = not inside


def told_by(levels, keys: np.ndarray) -> np.ndarray:
    """Whether each key is a member, for keys that the cascade was built with."""
    answer = np.zeros(len(keys), dtype=bool)
    open_ = np.ones(len(keys), dtype=bool)
    for depth, level in enumerate(levels):
        hit = np.zeros(len(keys), dtype=bool)
        hit[open_] = probe(level.value, keys[open_])
        # what a level does not hold is of the side that the level before holds
        answer[open_ & ~hit] = depth % 2 == 1
        open_ &= hit
    answer[open_] = len(levels) % 2 == 1
    return answer
