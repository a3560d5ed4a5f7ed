"""N-gram Jaccard self-join with rare-first prefix, length, positional and suffix filters.

Texts are sets of distinct word shingles (A-Z lower-cased). Two texts link when
``den * intersection >= num * union``. The steps:

1. Profile: one pass gives every text its set size, a 64-bit hash of its set, a small count
   profile of the set, and adds to a table of ``CELLS`` hashed document frequencies over all texts.
   Texts of equal sets are one class from here on, whatever their number.
2. Postings: with that table, every set is ordered rare first, and its prefix is emitted once per
   class and task. The order only has to be the same everywhere; it is exact for links. Most keys belong to one
   class: a first pass sends the keys alone, packed, and a filter over those that come twice keeps the
   others' postings in their task.
3. Keys of very frequent shingles are salted; each slice of a key is read as one sorted run, so no
   list is ever held. A run's first text (in an order drawn per key) is its anchor; the others
   become candidates with their anchor, the anchors of a salted key with the first of them.
4. Candidates that pass the length and positional filters are taken once per pair and screened by the count
   profiles (a lower bound of the sets' difference that needs no set). The pairs that are left get their whole
   sets, pass the suffix filter (the ordered sets are halved ``DEPTH`` times at the pivots of one of them; parts of
   unequal size differ at least by that), and are verified once. A text meets the ``ANCHORS`` anchors first with which it shares most keys. The
   links give provisional components. ``ROUNDS`` more rounds compare, in keys whose texts lie in
   several components, the texts outside the key's largest component with a drawn member of it.
5. What is left is exhausted: in every key with several components, each text outside the largest
   one meets all texts of other components, in pairs of blocks of at most ``BLOCK`` texts, under the same
   filters. The pairs that pass are not listed, only as many of them as connect the block's texts; so texts that
   may link come to one heap. Every two texts of a heap meet exactly once, in a pair of blocks of bounded bytes,
   where their whole sets are compared, and the links that connect components are returned. So every pair that
   could still connect two components is looked at, and what is written grows with the texts, not their pairs.
6. Numbers of links, if asked for: links lie inside components, so every two classes of a component
   meet exactly once, in the same way. The links are counted there, weighted by the classes' rows, and never listed.

Sets are of 64-bit shingle hashes. Null and empty texts have no shingle and link with nothing.
Repeated rows are one class; ties go to the smaller id. Only the id and text columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import fuse
from ledgerline.llm import textkit as tk
from ledgerline.llm.graph import components
from ledgerline.session import remove_scratch, scratch_dir, ship_package, short_lived_shuffles

CELLS = 1 << 20          # hashed document frequencies: 4 MB, whatever the input
CHUNK = 1 << 16
PROFILE = 256            # one-byte counts per text that screen pairs
PACKED = PROFILE // 2    # the same in half bytes (at most 15 each), where texts of a block are compared
DEPTH = 4                # halvings of the suffix filter
KEYS_PER_BUCKET = 1 << 20
FILTER_BYTES = 64 << 20  # the broadcast screen of shared keys; beyond it all postings are dealt
HOT = 2048               # postings of one key beyond which it is salted
MERGE = 64               # partial tables that one task adds up
ANCHORS = 2              # anchors that a text meets first; step 5 covers the others
ROUNDS = 2
BLOCK = 4096             # texts of one key on either side of a block of step 5
BUCKET_ROWS = 8_000      # rows of step 5 in one group
SHARE_ROWS = 1 << 20     # rows of step 5 that are dealt by one job, and their shuffle files on disk at a time
SHARE_SHINGLES = 1 << 27 # shingles (1 GB) of steps 5 and 6 that meet in one job
SIDE_SHINGLES = 1 << 20  # shingles (8 MB) and texts of a heap in one block of steps 5 and 6
SIDE_TEXTS = 2048
COLUMNS = 4096           # shingles of one matrix product of a pair of blocks
LISTED = 1 << 20         # pairs of one listing of a pair of blocks

_U = np.uint64


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - 20)).astype(np.int64)


def _class_ids(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> np.ndarray:
    """A 64-bit sum over each row's distinct hashes: the same for equal sets."""
    total = np.zeros(len(hashes) + 1, dtype=_U)
    np.cumsum(tk.mix(hashes ^ _U(0x1234567 * 0x9E3779B97F4A7C15 % (1 << 64))), out=total[1:])
    ends = np.searchsorted(rows, np.arange(n_rows + 1))
    return (total[ends[1:]] - total[ends[:-1]]).view(np.int64)


def _profiles(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> np.ndarray:
    at = rows * PROFILE + (hashes & _U(PROFILE - 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=n_rows * PROFILE), 255).astype(np.uint8)


def profile(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, row, n, cid, counts of every text; and rows with a part of the frequency table."""
    def run(batches):
        df = np.zeros(CELLS, dtype=np.uint32)
        for batch in batches:
            for t in tk.text_slices(batch.column(2)):
                rows, hashes = tk.shingle_sets(t, width)
                df += np.bincount(_cell(hashes), minlength=CELLS).astype(np.uint32)
                cid = _class_ids(rows, hashes, t.rows)
                counts = _profiles(rows, hashes, t.rows)
                n = np.bincount(rows, minlength=t.rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, t.rows), batch.column(1).slice(t.first, t.rows),
                     pa.array(n.astype(np.int32)), pa.array(cid),
                     tk.binary_array(counts, np.arange(t.rows + 1) * PROFILE),
                     pa.nulls(t.rows, pa.int32()), pa.nulls(t.rows, pa.binary())], names=names)
        filled = np.flatnonzero(df.reshape(-1, CHUNK).any(axis=1))
        m = len(filled)
        parts = [zlib.compress(df[k * CHUNK:(k + 1) * CHUNK].astype("<u8").tobytes(), 1) for k in filled.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(m, id_type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array(filled.astype(np.int32)), pa.array(parts, pa.binary())], names=names)

    names = ["doc_id", "row", "n", "cid", "counts", "chunk", "part"]
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(kind)
    return docs.select("doc_id", "row", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, row long, n int, cid long, counts binary, "
                                "chunk int, part binary")


def frequencies(parts: DataFrame) -> np.ndarray:
    """Sum of the partial tables: by chunk, ``MERGE`` parts a task, level by level; then 4 MB."""
    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, dtype="<u8")
        for part in table.column("part").to_pylist():
            total += np.frombuffer(zlib.decompress(part), "<u8")
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "slot": table.column("slot").slice(0, 1),
                         "part": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    left = max([r["n"] for r in parts.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).collect()], default=0)
    df = parts.select("chunk", F.pmod(F.xxhash64("part"), F.lit(1 << 30)).cast("int").alias("slot"), "part")
    while left:
        left = 0 if left <= MERGE else -(-left // MERGE)
        grouped = df.withColumn("slot", F.col("slot") % F.lit(max(left, 1)))
        df = grouped.groupBy("chunk", "slot").applyInArrow(add, "chunk int, slot int, part binary")
    out = np.zeros(CELLS, dtype=np.uint64)
    for r in df.collect():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["part"]), "<u8")
    return out


def _prefixes(batches, width: int, num: int, den: int, level: np.ndarray):
    """Prefix rows of every class that the task has not met: row, hash, position, and cid and n of all rows."""
    seen: set[int] = set()
    for batch in batches:
        for t in tk.text_slices(batch.column(0)):
            rows, hashes = tk.shingle_sets(t, width)
            cid = _class_ids(rows, hashes, t.rows)
            n = np.bincount(rows, minlength=t.rows)
            fresh = np.zeros(t.rows, dtype=bool)
            for i, c in enumerate(cid.tolist()):
                if n[i] and c not in seen:
                    seen.add(c)
                    fresh[i] = True
            take = fresh[rows]
            rows, hashes = rows[take], hashes[take]
            order = np.argsort(level[_cell(hashes)], kind="stable")
            order = order[np.argsort(rows[order].astype(np.uint16), kind="stable")]
            rows, hashes = rows[order], hashes[order]
            first = np.searchsorted(rows, np.arange(t.rows))
            pos = np.arange(len(rows)) - first[rows]
            prefix = pos < (n + (num * n // -den) + 1)[rows]
            yield rows[prefix], hashes[prefix], pos[prefix], cid, n


def _levels(df_table: np.ndarray) -> np.ndarray:
    return np.floor(1024 * np.log2(df_table.astype(np.float64) + 1)).astype(np.uint16)


def shared_keys(docs: DataFrame, df_table: np.ndarray, width: int, num: int, den: int, bits: int) -> DataFrame:
    """``key``: the first ``32 + bits`` bits of the prefix keys that more than one class has (and of a few that
    several tasks have of one class).

    Keys travel as 32-bit remainders in blocks, one for each slice and bucket: a seventh of their postings.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_levels(df_table))

    def count(batches):
        for rows, hashes, _, _, _ in _prefixes(batches, width, num, den, shared.value):
            if not len(hashes):
                continue
            keys, many = np.unique(hashes, return_counts=True)  # classes of a task come once, so rows are classes
            bucket = (keys >> _U(64 - bits)).astype(np.int64)
            rest = ((keys >> _U(32 - bits)) & _U(0xFFFFFFFF)).astype("<u4")
            ends = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            filled = np.flatnonzero(np.diff(ends)).tolist()
            parts = [(rest[ends[b]:ends[b + 1]], many[ends[b]:ends[b + 1]] > 1) for b in filled]
            yield pa.RecordBatch.from_arrays(
                [pa.array(filled, pa.int32()), pa.array([k[~m].tobytes() for k, m in parts], pa.binary()),
                 pa.array([k[m].tobytes() for k, m in parts], pa.binary())], names=["bucket", "one", "several"])

    def gather(table: pa.Table) -> pa.Table:
        one, several = (np.frombuffer(b"".join(table.column(c).to_pylist()), "<u4") for c in ("one", "several"))
        every = np.sort(np.concatenate((one, np.unique(several), np.unique(several))))
        twice = np.unique(every[1:][every[1:] == every[:-1]]).astype(np.int64)
        return pa.table({"key": (int(table.column("bucket")[0].as_py()) << 32) | twice})

    counted = docs.select("text").mapInArrow(count, "bucket int, one binary, several binary")
    return counted.groupBy("bucket").applyInArrow(gather, "key long")


def postings(docs: DataFrame, df_table: np.ndarray, width: int, num: int, den: int, screen=None, bits: int = 0) -> DataFrame:
    """key, salt, cid, n, pos of every class's prefix (once per task that has a copy); with a ``screen`` (see
    ``shared_keys``) only of keys that it holds, as a key of one class links nothing."""
    usual = float(np.median(df_table)) if len(df_table) else 0.0
    above = np.maximum(df_table.astype(np.float64) - 2 * usual, 0)
    salts = np.maximum(1, np.ceil(above / HOT)).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((_levels(df_table), salts))

    def run(batches):
        level, salts = shared.value
        for rows, hashes, pos, cid, n in _prefixes(batches, width, num, den, level):
            if screen is not None:
                keep = fuse.probe(screen.value, (hashes >> _U(32 - bits)).astype(np.int64))
                rows, hashes, pos = rows[keep], hashes[keep], pos[keep]
            salt = np.mod(cid[rows], salts[_cell(hashes)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(cid[rows]),
                 pa.array(n[rows].astype(np.int32)), pa.array(pos.astype(np.int32)),
                 pa.array(salts[_cell(hashes)] > 1)], names=["key", "salt", "cid", "n", "pos", "salted"])

    return docs.select("text").mapInArrow(run, "key long, salt int, cid long, n int, pos int, salted boolean")


def anchored(posts: DataFrame) -> DataFrame:
    """Every posting that is not alone in its run, with the run's first text; runs are streamed.

    A run of a salted key also gives its anchor itself, so that the anchors of the key can meet.
    """
    runs = posts.repartition("key", "salt").sortWithinPartitions("key", "salt", F.xxhash64("cid", "key"), "cid")

    def scan(batches):
        anchor = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, salt, cid, n, pos = (batch.column(i).to_numpy() for i in range(5))
            salted = batch.column(5).to_numpy(zero_copy_only=False)
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
            again = np.zeros(len(key), dtype=bool)
            again[1:] = ~new[1:] & (cid[1:] == cid[:-1])
            if last is not None and (key[0], salt[0]) == last[:2]:
                new[0] = False
                again[0] = cid[0] == last[2]
            at = np.where(new, np.arange(len(key)), -1)
            at = np.maximum.accumulate(at)
            def of(column, carried):
                return np.where(at >= 0, column[np.maximum(at, 0)], carried)
            held = anchor or (0, 0, 0)
            acid, an, apos = of(cid, held[0]), of(n, held[1]), of(pos, held[2])
            anchor = (int(acid[-1]), int(an[-1]), int(apos[-1]))
            last = (key[-1], salt[-1], cid[-1])
            rows = np.flatnonzero((~new & ~again & (cid != acid)) | (new & salted))
            take = [key[rows], cid[rows], n[rows], pos[rows], acid[rows], an[rows].astype(np.int32),
                    apos[rows].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in take],
                                             names=["key", "cid", "n", "pos", "acid", "an", "apos"])

    return runs.mapInArrow(scan, "key long, cid long, n int, pos int, acid long, an int, apos int")


def _may_link(n: Column, pos: Column, an: Column, apos: Column, num: int, den: int) -> Column:
    """Length filter, and the positional bound at a shared key: the overlap that is still possible."""
    short, long = F.least(n, an).cast("long"), F.greatest(n, an).cast("long")
    possible = 1 + F.least(n - pos, an - apos) - 1
    return (short * den >= long * num) & (possible.cast("long") * (num + den) >= (n.cast("long") + an) * num)


def _profile_filter(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose count profiles do not already differ too much."""
    a = classes.select(F.col("cid").alias("a"), F.col("n").alias("a_n"), F.col("counts").alias("a_counts"))
    b = classes.select(F.col("cid").alias("b"), F.col("n").alias("b_n"), F.col("counts").alias("b_counts"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "a_n", "b_n", "a_counts", "b_counts")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, PROFILE)
                    for i in (4, 5))
            n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            apart = np.abs(x.astype(np.int16) - y).sum(axis=1, dtype=np.int64)
            overlap = (n + m - apart) // 2
            keep = overlap * (num + den) >= (n + m) * num
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)),
                                              batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def suffix_filter(x: np.ndarray, y: np.ndarray, need: int) -> bool:
    """Whether two ordered sets may have ``need`` elements in common.

    The pivots of ``y`` (its middle, the middles of its halves, and so on) cut both sets into parts of the same
    ranges of values; what two parts have in common is at most the smaller of them, and a pivot is common only
    if ``x`` has it.
    """
    parts = min(1 << DEPTH, len(y) + 1)
    at = np.arange(1, parts) * len(y) // parts
    pivots = y[at]
    low = np.searchsorted(x, pivots)
    has = (x[np.minimum(low, max(len(x) - 1, 0))] == pivots) if len(x) else np.zeros(len(at), dtype=bool)
    ends_x, starts_x = np.append(low, len(x)), np.append(0, low + has)
    ends_y, starts_y = np.append(at, len(y)), np.append(0, at + 1)
    return int(np.minimum(ends_x - starts_x, ends_y - starts_y).sum() + has.sum()) >= need


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose whole sets reach the threshold; the pair's set sizes come from the sets."""
    a = sets.select(F.col("cid").alias("a"), F.col("hashes").alias("x"))
    b = sets.select(F.col("cid").alias("b"), F.col("hashes").alias("y"))

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            xs, ys = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(xs[i].as_buffer(), "<u8"), np.frombuffer(ys[i].as_buffer(), "<u8")
                if len(x) > len(y):
                    x, y = y, x
                if not suffix_filter(x, y, -(-num * (len(x) + len(y)) // (num + den))):
                    continue
                at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
                common = int((y[at] == x).sum()) if len(y) else 0
                keep[i] = den * common >= num * (len(x) + len(y) - common)
            keep = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)],
                                             names=["a", "b"])

    return (pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")).mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """cid, hashes (sorted) of the wanted rows' texts (and of a few that the filter lets by)."""
    spark = docs.sparkSession
    screen = fuse.shared_filter(spark, wanted.select(F.col("row").alias("key")), 16)
    if screen is None:
        docs = docs.join(wanted.select("row").distinct(), "row", "left_semi")

    def run(batches):
        for batch in batches:
            if screen is not None:
                batch = batch.filter(pa.array(fuse.probe(screen.value, batch.column(1).to_numpy())))
            for t in tk.text_slices(batch.column(0)):
                rows, hashes = tk.shingle_sets(t, width)
                cid = _class_ids(rows, hashes, t.rows)
                ends = np.searchsorted(rows, np.arange(t.rows + 1))
                yield pa.RecordBatch.from_arrays([pa.array(cid), tk.binary_array(hashes, ends * 8)],
                                                 names=["cid", "hashes"])

    return docs.select("text", "row").mapInArrow(run, "cid long, hashes binary")


def _few_anchors(near: DataFrame) -> DataFrame:
    """Pairs (a, b) of every text with the anchors that it shares most keys with."""
    counted = near.groupBy("cid", "acid").agg(F.count(F.lit(1)).alias("keys"))
    # a text has at most as many anchors as its own prefix has keys
    best = counted.groupBy("cid").agg(F.slice(F.sort_array(
        F.collect_list(F.struct("keys", F.xxhash64("acid", "cid").alias("draw"), "acid")), asc=False), 1, ANCHORS).alias("best"))
    one = best.select("cid", F.explode("best").alias("x")).select("cid", F.col("x.acid").alias("acid"))
    return one.select(F.least("cid", "acid").alias("a"), F.greatest("cid", "acid").alias("b")).distinct()


def _mixed(placed: DataFrame) -> DataFrame:
    """key, its texts, its largest component, and the texts outside that, of keys with several components."""
    inside = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    return inside.groupBy("key").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("comps"),
        F.max(F.struct("n", "comp")).alias("m")).filter("comps > 1").select(
            "key", "total", F.col("m.comp").alias("top"), (F.col("total") - F.col("m.n")).alias("others"))


def _against_top(placed: DataFrame, mixed: DataFrame, turn: int) -> DataFrame:
    """Texts outside a key's largest component with a drawn member of it."""
    both = placed.join(mixed, "key")
    drawn = both.filter("comp = top").groupBy("key").agg(F.min(
        F.struct(F.xxhash64("cid", "key", F.lit(turn)).alias("draw"), "cid", "n", "pos")).alias("x"))
    drawn = drawn.select("key", F.col("x.cid").alias("acid"), F.col("x.n").alias("an"), F.col("x.pos").alias("apos"))
    return both.filter("comp != top").join(drawn, "key")


def _rest(placed: DataFrame, mixed: DataFrame, classes: DataFrame, groups: int, num: int, den: int) -> DataFrame:
    """Pairs that connect the texts which may link: texts of one key and different components that pass the length,
    positional and profile filters. Of all such pairs of a block, as many are listed as connect its texts: fewer
    than it has texts.

    Both sides are cut into blocks, so that no task holds more than two blocks of a key at once. A text comes once to a
    pair of blocks, whether it is looked at there (``met``), looks (``probe``), or both."""
    rows = placed.join(mixed, "key").join(classes.select("cid", "packed"), "cid")
    blocks, sides = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("total", "others"))
    columns = ["key", "cid", "n", "pos", "comp", "packed"]
    rows = rows.select(*columns, (F.col("comp") != F.col("top")).alias("outside"), blocks.alias("blocks"), sides.alias("sides"),
                       *(F.pmod(F.xxhash64("cid"), k).cast("int").alias(c) for k, c in ((blocks, "own_block"), (sides, "own_side"))))
    met = rows.withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).select(
        *columns, F.col("own_block").alias("block"), "side", F.lit(True).alias("met"),
        (F.col("outside") & (F.col("side") == F.col("own_side"))).alias("probe"))
    probes = rows.filter("outside AND blocks > 1").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    probes = probes.filter("block != own_block").select(
        *columns, "block", F.col("own_side").alias("side"), F.lit(False).alias("met"), F.lit(True).alias("probe"))
    dealt = met.unionByName(probes).withColumn("group", F.pmod(F.xxhash64("key", "block", "side"), F.lit(groups)).cast("int"))

    def work(table: pa.Table) -> pa.Table:
        key, cid, n, pos, comp, block, side = (table.column(c).to_numpy() for c in ("key", "cid", "n", "pos", "comp", "block", "side"))
        looked_at, probe = (table.column(c).to_numpy() for c in ("met", "probe"))
        halves = np.frombuffer(b"".join(table.column("packed").to_pylist()), np.uint8).reshape(-1, PACKED)
        counts = np.concatenate((halves & 15, halves >> 4), axis=1).astype(np.int8)
        n, pos = n.astype(np.int64), pos.astype(np.int64)
        order = np.lexsort((side, block, key))
        edge = np.ones(len(order) + 1, dtype=bool)
        edge[1:-1] = False
        for column in (key, block, side):
            edge[1:-1] |= column[order][1:] != column[order][:-1]
        bounds = np.flatnonzero(edge)
        found: set[tuple[int, int]] = set()
        at = np.zeros(len(cid), dtype=np.int64)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            here = order[lo:hi]
            texts, at[here] = np.unique(cid[here], return_inverse=True)
            label = np.arange(len(texts))
            there = here[looked_at[here]]
            for i in here[probe[here]].tolist():
                some = there[comp[there] != comp[i]]
                some = some[cid[some] != cid[i]]
                total = n[some] + n[i]
                some = some[(np.minimum(n[some], n[i]) * den >= np.maximum(n[some], n[i]) * num)
                            & (np.minimum(n[some] - pos[some], n[i] - pos[i]) * (num + den) >= total * num)]
                some = some[label[at[some]] != label[at[i]]]
                if not len(some):
                    continue
                apart = np.abs(counts[some] - counts[i]).sum(axis=1, dtype=np.int64)
                total = n[some] + n[i]
                some = some[(total - apart) // 2 * (num + den) >= total * num]
                own = int(cid[i])
                found.update((min(own, c), max(own, c)) for c in texts[_joined(label, at[i], at[some])].tolist())
        pairs = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy("group").applyInArrow(work, "a long, b long").distinct()


def _joined(label: np.ndarray, i: int, some: np.ndarray) -> np.ndarray:
    """Of ``some``, which all belong to ``i``, one for every label but its own; from here on they have its label."""
    labels, first = np.unique(label[some], return_index=True)
    new = labels != label[i]
    if new.any():
        label[np.isin(label, labels[new])] = label[i]
    return some[first[new]]


def _overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``xs`` with every set of ``ys``.

    Shingles of many texts go through matrix products, the pairs of the others are listed in parts.
    """
    a, b = len(xs), len(ys)
    out = np.zeros(a * b, dtype=np.int64)
    x_row, y_row = np.repeat(np.arange(a), [len(x) for x in xs]), np.repeat(np.arange(b), [len(y) for y in ys])
    found = np.unique(np.concatenate(xs + ys), return_inverse=True)[1].reshape(-1)
    x, y = found[:len(x_row)], found[len(x_row):]
    kinds = int(found.max()) + 1 if len(found) else 0
    dx, dy = np.bincount(x, minlength=kinds), np.bincount(y, minlength=kinds)
    dense = dx * dy > a * b // 64
    columns = np.flatnonzero(dense)
    column = np.cumsum(dense) - 1
    by_x, by_y = (np.flatnonzero(dense[z]) for z in (x, y))
    by_x, by_y = by_x[np.argsort(column[x[by_x]], kind="stable")], by_y[np.argsort(column[y[by_y]], kind="stable")]
    x_col, y_col = column[x[by_x]], column[y[by_y]]
    for lo in range(0, len(columns), COLUMNS):
        wide = min(COLUMNS, len(columns) - lo)
        sides = []
        for rows, at, cols, height in ((x_row, by_x, x_col, a), (y_row, by_y, y_col, b)):
            first, stop = np.searchsorted(cols, (lo, lo + wide))
            side = np.zeros((height, wide), dtype=np.float32)
            side[rows[at[first:stop]], cols[first:stop] - lo] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64).reshape(-1)

    thin = ~dense & (dx > 0) & (dy > 0)
    rest_x, rest_y = np.flatnonzero(thin[x]), np.flatnonzero(thin[y])
    rest_y = rest_y[np.argsort(y[rest_y], kind="stable")]
    start = np.searchsorted(y[rest_y], np.arange(kinds))
    total = np.concatenate(([0], np.cumsum(dy[x[rest_x]])))
    lo = 0
    while lo < len(rest_x):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + LISTED, side="right")) - 1)
        some = rest_x[lo:hi]
        met = y_row[tk.gather_spans(rest_y, start[x[some]], dy[x[some]])]
        np.add.at(out, np.repeat(x_row[some], dy[x[some]]) * b + met, 1)
        lo = hi
    return out.reshape(a, b)


def _in_blocks(docs: DataFrame, inside: DataFrame, kept: str, width: int, written, name: str) -> list[DataFrame]:
    """The sets of ``inside`` (cid, heap, n, row and the column ``kept``), dealt so that every two texts of a heap meet
    exactly once, in a pair of blocks of bounded bytes; in shares, as a set goes to every block that its own one meets."""
    blocks = F.ceil(F.greatest(F.sum(F.col("n").cast("long")) / SIDE_SHINGLES, F.count(F.lit(1)) / SIDE_TEXTS)).cast("int")
    cut = written(inside.groupBy("heap").agg(blocks.alias("blocks"), F.sum(F.col("n").cast("long")).alias("total")), f"{name}-cut")
    met = cut.agg(F.sum(F.col("total") * F.col("blocks"))).first()[0] or 0
    groups = max(1, -(-met // SIDE_SHINGLES))
    shares = max(1, -(-met // SHARE_SHINGLES))
    placed = inside.join(cut, "heap").select("cid", "heap", kept, "blocks",
                                             F.pmod(F.xxhash64("cid"), "blocks").cast("int").alias("own"))
    sets = written(_sets(docs, inside.select("cid", "row"), width), f"{name}-sets")
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cid", "heap", kept, "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    dealt = dealt.withColumn("group", F.pmod(F.xxhash64("heap", "lo", "hi"), F.lit(groups)).cast("int"))
    return [sets.join(dealt.filter(F.col("group") % shares == i), "cid") for i in range(shares)]


def _meetings(table: pa.Table, num: int, den: int):
    """For every pair of blocks: the rows of both, which of them link, and whether the two blocks are one."""
    cid, heap, own, lo, hi = (table.column(c).to_numpy() for c in ("cid", "heap", "own", "lo", "hi"))
    hashes = table.column("hashes").combine_chunks()
    order = np.lexsort((cid, own, hi, lo, heap))
    # a text that is there twice (repeated rows) counts once
    again = np.zeros(len(order), dtype=bool)
    edge = np.ones(len(order), dtype=bool)
    if len(order):
        same = np.ones(len(order) - 1, dtype=bool)
        for column in (heap, lo, hi):
            same &= column[order][1:] == column[order][:-1]
        edge[1:] = ~same
        again[1:] = same & (cid[order][1:] == cid[order][:-1])
    order, unit = order[~again], np.cumsum(edge)[~again]
    bounds = np.flatnonzero(np.diff(unit, prepend=0, append=unit[-1] + 1 if len(unit) else 0))
    for first, stop in zip(bounds[:-1], bounds[1:]):
        here = order[first:stop]
        one, two = here[own[here] == lo[here]], here[own[here] == hi[here]]
        if not len(one) or not len(two):
            continue
        xs, ys = ([np.frombuffer(hashes[i].as_buffer(), "<u8") for i in side.tolist()] for side in (one, two))
        common = _overlaps(xs, ys)
        union = np.array([len(x) for x in xs])[:, None] + np.array([len(y) for y in ys])[None, :] - common
        yield one, two, (den * common >= num * union) & (cid[one][:, None] != cid[two][None, :]), lo[one[0]] == hi[one[0]]


def _connecting(docs: DataFrame, inside: DataFrame, width: int, num: int, den: int, written) -> DataFrame:
    """Links (a, b) that connect the components (``comp``) of the texts of every heap: of all links of a pair of blocks,
    fewer than it has components."""
    def work(table: pa.Table) -> pa.Table:
        cid, comp = (table.column(c).to_numpy() for c in ("cid", "comp"))
        ends = []
        for one, two, linked, _ in _meetings(table, num, den):
            rows = np.concatenate((one, two))
            label = np.unique(comp[rows], return_inverse=True)[1].reshape(-1)
            for i in np.flatnonzero(linked.any(axis=1)).tolist():
                some = rows[_joined(label, i, len(one) + np.flatnonzero(linked[i]))]
                ends.append(np.stack((np.full(len(some), cid[one[i]]), cid[some]), axis=1))
        ends = np.concatenate([np.empty((0, 2), dtype=np.int64), *ends])
        return pa.table({"a": ends.min(axis=1), "b": ends.max(axis=1)})

    dealt = _in_blocks(docs, inside, "comp", width, written, "rest")
    return written([share.groupBy("group").applyInArrow(work, "a long, b long") for share in dealt], "rest-links")


def _links_between(docs: DataFrame, rows: DataFrame, comp: DataFrame, width: int, num: int, den: int, written) -> DataFrame:
    """cid, links: the rows of other classes that link to a class, for every class of a component of several."""
    inside = written(rows.join(comp.select(F.col("node").alias("cid"), F.col("component").alias("heap")), "cid")
                     .groupBy("cid").agg(F.first("heap").alias("heap"), F.first("n").alias("n"), F.min("row").alias("row"),
                                         F.count(F.lit(1)).alias("copies")), "inside")

    def work(table: pa.Table) -> pa.Table:
        cid, copies = (table.column(c).to_numpy() for c in ("cid", "copies"))
        links = np.zeros(len(cid), dtype=np.int64)
        for one, two, linked, same in _meetings(table, num, den):
            links[one] += linked @ copies[two]
            if not same:
                links[two] += linked.T @ copies[one]
        return pa.table({"cid": cid, "links": links}).filter(pa.array(links > 0))

    dealt = _in_blocks(docs, inside, "copies", width, written, "inside")
    counted = written([share.groupBy("group").applyInArrow(work, "cid long, links long") for share in dealt], "inside-links")
    return written(counted.groupBy("cid").agg(F.sum("links").alias("links")), "links-between")


def link(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id",
         text_col: str = "text", n_links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) of every document.

    With ``n_links`` also the number of other rows that link to it, equal sets included.
    """
    ship_package(docs.sparkSession)
    with short_lived_shuffles(docs.sparkSession):
        return _linked(docs, width, num, den, id_col, text_col, n_links)


def _linked(docs: DataFrame, width: int, num: int, den: int, id_col: str, text_col: str, n_links: bool) -> DataFrame:
    """See ``link``. Tables are written to the shared folder step by step; large ones go with the step that reads them."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"))
    at = scratch_dir(spark, "ngram-join")

    def written(df: DataFrame | list[DataFrame], name: str) -> DataFrame:
        """The table, read again; a list of shares is written one by one, so that one's shuffle files are there at a time."""
        for share in df if isinstance(df, list) else [df]:
            share.write.mode("append").parquet(f"{at}/{name}")
        return spark.read.parquet(f"{at}/{name}")

    def gone(*names: str) -> None:
        for name in names:
            remove_scratch(f"{at}/{name}")

    profiled = written(profile(docs, width), "profile")
    table = frequencies(profiled.filter("chunk IS NOT NULL").select("chunk", "part"))
    rows = profiled.filter("chunk IS NULL").select("doc_id", "row", "n", "cid", "counts")

    total = rows.agg(F.sum("n")).first()[0] or 0
    bits = min(16, max(6, int(np.ceil(np.log2(max(total / KEYS_PER_BUCKET, 1))))))
    met = written(shared_keys(docs, table, width, num, den, bits), "shared-keys")
    screen = fuse.shared_filter(spark, met, 64, FILTER_BYTES)
    gone("shared-keys")
    shared = written(anchored(postings(docs, table, width, num, den, screen, bits)), "shared")
    anchors = shared.select("key", F.col("acid").alias("cid"), F.col("an").alias("n"), F.col("apos").alias("pos"))
    members = written(shared.select("key", "cid", "n", "pos").unionByName(anchors).distinct(), "members")
    classes = written(_classes(rows, members), "classes")
    rows = written(rows.drop("counts"), "texts")
    gone("profile")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Links among the pairs; only the texts of pairs that are still open are read again."""
        ends = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        wanted = written(classes.select("cid", "row").join(ends, "cid", "left_semi"), f"{name}-wanted")
        sets = written(_sets(docs, wanted, width), f"{name}-sets")
        links = written(_verified(pairs, sets, num, den).distinct(), f"{name}-links")
        gone(f"{name}-sets", f"{name}-wanted")
        return links

    # candidates with their anchors; the anchors of a salted key with the first of them
    own = shared.select("key", "cid", "n", "pos", "acid", "an", "apos")
    heads = shared.filter("cid = acid").select("key", "cid", "n", "pos").distinct()
    first = heads.groupBy("key").agg(F.min(F.struct("n", "cid", "pos")).alias("f"))
    across = heads.join(first, "key").select("key", "cid", "n", "pos", F.col("f.cid").alias("acid"),
                                             F.col("f.n").alias("an"), F.col("f.pos").alias("apos"))
    near, links, tried, comp, placed = own.unionByName(across).filter("cid != acid"), None, None, None, None
    latest: list[str] = []
    for turn in range(ROUNDS + 1):
        near = near.filter(_may_link(F.col("n"), F.col("pos"), F.col("an"), F.col("apos"), num, den))
        pairs = _few_anchors(near)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, f"pairs-{turn}")
        if turn == 0:
            gone("shared")
        open_pairs = written(_profile_filter(pairs, classes, num, den), f"open-{turn}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        more = verified(open_pairs, f"round-{turn}")
        links = more if links is None else links.unionByName(more)
        if turn == 0 or not more.isEmpty():
            old, comp = comp, components(links)
            before, latest = latest, [f"placed-{turn}", f"mixed-{turn}"]
            placed = written(_placed(members, comp) if turn == 0 else _moved(placed, old, comp), latest[0])
            mixed = written(_mixed(placed), latest[1])
            gone(*before)
        near = _against_top(placed, mixed, turn)

    met = mixed.agg(F.sum("total")).first()[0] or 0
    shares = max(1, -(-met // SHARE_ROWS))
    groups = max(1, -(-met // shares // BUCKET_ROWS))
    share = F.pmod(F.xxhash64("key", F.lit("share")), F.lit(shares))
    rest = written([_rest(placed.filter(share == i), mixed.filter(share == i), classes, groups, num, den) for i in range(shares)],
                   "rest")
    gone(*latest)
    if not rest.isEmpty():
        heaps = components(rest).select(F.col("node").alias("cid"), F.col("component").alias("heap"))
        own = comp.select(F.col("node").alias("cid"), F.col("component").alias("comp"))
        inside = classes.select("cid", "row", "n").join(heaps, "cid").join(own, "cid", "left")
        inside = written(inside.withColumn("comp", F.coalesce("comp", "cid")), "rest-inside")
        more = _connecting(docs, inside, width, num, den, written)
        gone("rest-sets")
        if not more.isEmpty():
            comp = components(links.unionByName(more))

    labelled = rows.select("doc_id", "n", "cid").join(
        comp.select(F.col("node").alias("cid"), F.col("component").alias("comp")), "cid", "left")
    # a class is a component unless links say more; a text without shingles is alone
    labelled = written(labelled.select("doc_id", "n", *(["cid"] if n_links else []), F.coalesce("comp", "cid").alias("comp")),
                       "labelled")
    smallest = written(labelled.filter("n > 0").groupBy("comp").agg(F.min("doc_id").alias("smallest")), "smallest")
    found = labelled.join(smallest, "comp", "left")
    if n_links:
        between = _links_between(docs, rows, comp, width, num, den, written)
        gone("inside-sets")
        copies = rows.filter("n > 0").groupBy("cid").agg(F.count(F.lit(1)).alias("copies"))
        linked = copies.join(between, "cid", "left").select(
            "cid", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        found = found.join(written(linked.filter("n_links > 0"), "n-links"), "cid", "left")
    return found.select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        *([F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")] if n_links else []))


def _classes(rows: DataFrame, members: DataFrame) -> DataFrame:
    """cid, row, n, counts, packed of the classes that share a key (and a few others that the filter lets by):
    the others' profiles never leave their task."""
    screen = fuse.shared_filter(rows.sparkSession, members.select(F.col("cid").alias("key")), 16)
    own = rows.select("cid", "row", "n", "counts")
    if screen is None:
        own = own.join(members.select("cid").distinct(), "cid", "left_semi")

    def run(batches):
        for batch in batches:
            if screen is not None:
                batch = batch.filter(pa.array(fuse.probe(screen.value, batch.column(0).to_numpy())))
            if batch.num_rows:
                counts = np.minimum(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8), 15).reshape(-1, 2, PACKED)
                packed = counts[:, 0] | (counts[:, 1] << 4)
                yield batch.append_column("packed", tk.binary_array(packed, np.arange(len(packed) + 1) * PACKED))

    sifted = own.mapInArrow(run, "cid long, row long, n int, counts binary, packed binary")
    return sifted.groupBy("cid").agg(F.min("row").alias("row"), F.first("n").alias("n"),
                                     F.first("counts").alias("counts"), F.first("packed").alias("packed"))


def _placed(members: DataFrame, comp: DataFrame) -> DataFrame:
    return (members.join(comp.select(F.col("node").alias("cid"), "component"), "cid", "left")
            .select("key", "cid", "n", "pos", F.coalesce("component", "cid").alias("comp")))


def _moved(placed: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """The texts of ``placed`` after components grew together: only the labels that changed are sent to them."""
    was = old.select("node", F.col("component").alias("was"))
    moved = new.join(was, "node", "left").select(F.coalesce("was", "node").alias("comp"), F.col("component").alias("now"))
    moved = moved.filter("comp <> now").distinct()
    return placed.join(moved, "comp", "left").select("key", "cid", "n", "pos", F.coalesce("now", "comp").alias("comp"))


def keep_one(docs: DataFrame, linked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents whose id is their component's smallest (null ids stay)."""
    gone = linked.filter("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti")
