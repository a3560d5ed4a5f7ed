"""Line deduplication: lines within one word edit of an earlier line go, over all documents.

A line is its sequence of words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased). Two lines match when
their words are equal, or when both have ``MIN_WORDS`` words or more and one word inserted, deleted
or replaced makes them equal. A line goes when any line that matches it stands earlier, in the order
of doc_id (null first), then a hash of the text, then place; every line is judged on the input.
Lines without words stay, but leave with their document when no line with a word is left in it.

1. Lines are hashed and reduced to distinct ones with their earliest place.
2. Screen: of two lines one edit apart, either the first or the last half of the shorter one is in
   both. Lines that share no half with another line of the same class need no further work.
3. The others emit their deletion neighbourhood: a hashed key for the line itself and for the line
   without each of its words. Keys of one line only fall away. Lines with equal variants meet, and
   the edit distance is verified on a second hash of the variant (of long lines of another kind, see
   ``Lines``) and the place of the deleted word: the same place (one replaced), or one line without a deletion (one inserted). Per variant only
   the earliest place is kept, never a list of pairs, so a variant that a third of all lines share
   is a partial aggregate.
4. Documents with lines to drop are rebuilt; the others never leave their task.
Steps 2 to 4 screen their scans with broadcast filters of bounded size (see ``fuse``); beyond the
bound a join, or no screen, takes their place with the same result.

Null and empty texts have no lines with words. Rows that repeat a document (id and text) count as
the same document: their lines do not remove each other. Extra columns pass through.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import fuse
from ledgerline.llm import textkit as tk
from ledgerline.session import scratch_dir, ship_package

# Documented parameter: shorter lines match only when equal. With the words of all lines dealt anew, so
# that a match is chance, 0.07% of 4-word lines match another one, 3.8% of 3-word and 59% of 2-word lines.
MIN_WORDS = 4

_U = np.uint64
LONG_LINE = 256
SALTS = (0, 0x5851F42D4C957F2D)
_STEP = 0xC2B2AE3D27D4EB4F | 1
_STEP_INV = pow(_STEP, -1, 1 << 64)


class Lines:
    """The lines with words of a slice, and hashes of any of their word ranges (made when they are asked for).

    Hashes of ranges are polynomials over word hashes modulo 2^64; ranges of ``LONG_LINE`` words or more, for
    which strings with equal polynomials can be built, are hashed modulo primes as well.
    """

    def __init__(self, t: tk.Texts):
        self.text = t
        self._sums: dict[int, np.ndarray] = {}
        self.spans = tk.word_spans(t)
        starts, _, rows = self.spans
        edges = np.unique(np.concatenate((t.offs[:-1], np.flatnonzero(t.data == 10) + 1)))
        line = np.searchsorted(edges, starts, side="right")
        new = np.ones(len(starts), dtype=bool)
        new[1:] = line[1:] != line[:-1]
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, len(starts)))
        self.row = rows[self.first]
        # number of the line in its text, counting empty ones
        first_edge = np.searchsorted(edges, t.offs[:-1], side="right")
        self.number = line[self.first] - first_edge[self.row]

    @functools.cached_property
    def words(self) -> np.ndarray:
        return tk.span_hashes(tk.LOWER[self.text.data], *self.spans[:2])

    @functools.cached_property
    def powers(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.words) + 1
        up, down = np.full(n, _STEP, _U), np.full(n, _STEP_INV, _U)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)

    def sums(self, which: int) -> np.ndarray:
        if which not in self._sums:
            total = np.zeros(len(self.words) + 1, dtype=_U)
            np.cumsum(tk.mix(self.words + _U(SALTS[which])) * self.powers[0][:-1], out=total[1:])
            self._sums[which] = total
        return self._sums[which]

    @functools.cached_property
    def primes(self) -> tk.PrimeSums:
        return tk.PrimeSums(tk.mix(self.words + _U(SALTS[1])))

    def ranges(self, start: np.ndarray, stop: np.ndarray, which: int = 0) -> np.ndarray:
        total = self.sums(which)
        return (total[stop] - total[start]) * self.powers[1][start]

    def _long(self, hashes: np.ndarray, size: np.ndarray, ranges) -> np.ndarray:
        """The hashes, mixed with those modulo primes where ranges (end to end) are long."""
        long = np.flatnonzero(size >= LONG_LINE)
        if len(long):
            own = [(a[long], b[long]) for a, b in ranges]
            hashes[long] = tk.mix(hashes[long] ^ self.primes.joined(own))
        return hashes

    def keys(self, which: int = 0) -> np.ndarray:
        """Keys (0) and proofs (1) of the whole lines, as ``deletions`` has them of lines less a word."""
        stop = self.first + self.size
        out = tk.mix(self.ranges(self.first, stop, which) + self.size.astype(_U))
        return self._long(out, self.size, [(self.first, stop)]) if which else out

    def whole(self) -> np.ndarray:
        """What tells lines apart."""
        return self._long(self.keys(), self.size, [(self.first, self.first + self.size)])

    def halves(self, shorter: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the first and last half in the class of lines of ``size - shorter`` words."""
        cls = self.size - shorter
        head = np.maximum(cls // 2, 0)
        tail = np.maximum(cls - cls // 2, 0)
        end = self.first + self.size
        return (tk.mix(self.ranges(self.first, self.first + head) + (2 * cls).astype(_U)),
                tk.mix(self.ranges(end - tail, end) + (2 * cls + 1).astype(_U)))

    def deletions(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, place, key, second hash) of the picked lines without each of their words."""
        size = self.size[pick]
        line = np.repeat(pick, size)
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        first, stop = self.first[line], self.first[line] + self.size[line]
        out = []
        for which in range(len(SALTS)):
            total = self.sums(which)
            value = ((total[first + place] - total[first]) + (total[stop] - total[first + place + 1])
                     * _U(_STEP_INV)) * self.powers[1][first]
            out.append(tk.mix(value + (self.size[line] - 1).astype(_U)))
        proof = self._long(out[1], self.size[line] - 1, [(first, first + place), (first + place + 1, stop)])
        return line, place, out[0], proof


def _rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), key.alias("row"), F.col(text_col).alias("text"))


def line_table(rows: DataFrame) -> DataFrame:
    """doc_id, row, number and hash of every line with words; and half, line of every distinct long line of a
    slice: four halves a line (see ``Lines.halves``). Both come from one scan; lines have no half."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "row", "number", "line", "half"]

    def run(batches):
        for batch in batches:
            for t in tk.text_slices(batch.column(2)):
                lines = Lines(t)
                at = pa.array(lines.row + t.first)
                whole = lines.whole()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(lines.number.astype(np.int32)),
                     pa.array(whole.view(np.int64)), pa.nulls(len(whole), pa.int64())], names=names)
                pick = np.unique(whole, return_index=True)[1]
                halves, owner = [], []
                for shorter in (0, 1):
                    long = pick[lines.size[pick] - shorter >= MIN_WORDS]
                    for keys in lines.halves(shorter):
                        halves.append(keys[long])
                        owner.append(whole[long])
                owner, halves = (pa.array(np.concatenate(x).view(np.int64)) for x in (owner, halves))
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(owner), batch.column(0).type), pa.nulls(len(owner), pa.int64()),
                     pa.nulls(len(owner), pa.int32()), owner, halves], names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, row long, number int, line long, half long")


def variants(rows: DataFrame, shared) -> DataFrame:
    """line, key, proof, place (-1: nothing deleted) of the lines with a shared half, once per slice."""
    def run(batches):
        for batch in batches:
            for t in tk.text_slices(batch.column(0)):
                lines = Lines(t)
                whole = lines.whole()
                ok = lines.size >= MIN_WORDS
                if shared is not None:
                    known = np.zeros(len(whole), dtype=bool)
                    for shorter in (0, 1):
                        long = lines.size - shorter >= MIN_WORDS
                        for keys in lines.halves(shorter):
                            known |= long & fuse.probe(shared.value, keys.view(np.int64))
                    ok &= known
                pick = np.flatnonzero(ok)
                pick = pick[np.unique(whole[pick], return_index=True)[1]]
                line, place, key, proof = lines.deletions(pick)
                out = [np.concatenate((whole[pick], whole[line])), np.concatenate((lines.keys()[pick], key)),
                       np.concatenate((lines.keys(1)[pick], proof))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in out]
                    + [pa.array(np.concatenate((np.full(len(pick), -1), place)).astype(np.int32))],
                    names=["line", "key", "proof", "place"])

    return rows.select("text").mapInArrow(run, "line long, key long, proof long, place int")


def _kept_by(df: DataFrame, screen, column: str) -> DataFrame:
    """Rows whose ``column`` the broadcast filter may hold."""
    at = df.columns.index(column)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(fuse.probe(screen.value, batch.column(at).to_numpy())))

    return df.mapInArrow(run, df.schema)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a hash of id and text) and number of every line that goes."""
    spark = docs.sparkSession
    ship_package(spark)
    at = scratch_dir(spark, "lines")

    def written(df: DataFrame, name: str) -> DataFrame:
        # hashes hardly repeat: a dictionary of them is built in vain
        df.write.option("parquet.enable.dictionary", "false").parquet(f"{at}/{name}")
        return spark.read.parquet(f"{at}/{name}")

    rows = _rows_of(docs, id_col, text_col)
    table = written(line_table(rows), "lines")
    lines = table.filter("half IS NULL").drop("half")
    place = F.struct("doc_id", "row", "number")
    distinct = written(lines.groupBy("line").agg(F.min(place).alias("first")), "distinct")

    halves = table.filter("half IS NOT NULL").groupBy("half").agg(F.min("line").alias("lo"), F.max("line").alias("hi")).filter("lo < hi")
    halves = written(halves.select(F.col("half").alias("key")), "halves")
    spread = written(variants(rows, fuse.shared_filter(spark, halves, 16)), "variants")
    common = written(spread.groupBy("key").agg(F.min("line").alias("lo"), F.max("line").alias("hi"))
                     .filter("lo < hi").select("key"), "common")
    screen = fuse.shared_filter(spark, common, 16)
    met = spread.join(common, "key", "left_semi") if screen is None else _kept_by(spread, screen, "key")
    met = written(met.distinct().join(distinct, "line"), "met")
    group = ["key", "proof"]
    same = written(met.groupBy(*group, "place").agg(F.min("first").alias("earliest")), "same")
    either = written(same.groupBy(*group).agg(
        F.min(F.when(F.col("place") < 0, F.col("earliest"))).alias("uncut"),
        F.min(F.when(F.col("place") >= 0, F.col("earliest"))).alias("cut")), "either")
    # a line with a deletion meets those of the same place and uncut ones; an uncut line meets all cut ones
    judged = met.join(same, [*group, "place"]).join(either, group)
    other = F.when(F.col("place") < 0, F.col("cut")).otherwise(F.least("earliest", "uncut"))
    near = judged.filter(other < F.col("first")).select("line").distinct()
    verdict = written(distinct.join(near.withColumn("near", F.lit(True)), "line", "left"), "verdict")

    judged = lines.join(verdict, "line")
    return judged.filter(F.coalesce("near", F.lit(False)) | ~place.eqNullSafe(F.col("first"))).select("row", "number")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
          drop_emptied: bool = True, counts: tuple[str, str] | None = None) -> DataFrame:
    """The documents without the lines that go.

    Documents that had words and lost all of their lines go too, unless ``drop_emptied`` is false.
    ``length_col``, if given, is set to the new length in code points where lines were dropped.
    ``counts`` names two columns to add: lines with words, and lines dropped; they replace columns
    of the same names.
    """
    spark = docs.sparkSession
    gone = dropped_lines(docs, id_col, text_col)
    at = scratch_dir(spark, "dropped-lines")
    gone.write.parquet(at)
    gone = spark.read.parquet(at)
    key, cut_col = (tk.free_name(n, docs.columns) for n in ("_row", "_gone"))
    kept = [c for c in docs.columns if c not in (counts or ())]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in counts or ()])
    keyed = docs.select(*kept, F.xxhash64(F.col(id_col), F.col(text_col)).alias(key))

    def run(batches, screen=None):
        for batch in batches if screen is None else sifted(batches, *screen):
            names = batch.schema.names
            columns = {c: batch.column(names.index(c)) for c in kept}
            texts = columns[text_col].to_pylist()
            numbers = ([x or [] for x in batch.column(names.index(cut_col)).to_pylist()] if cut_col in names
                       else [[]] * len(texts))
            total = [0] * len(texts)
            if counts or any(numbers):
                for t in tk.text_slices(columns[text_col]):
                    total[t.first:t.first + t.rows] = np.bincount(Lines(t).row, minlength=t.rows).tolist()
            stay = []
            for i, cut in enumerate(numbers):
                if cut:
                    cut = set(cut)
                    texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in cut)
                stay.append(not (drop_emptied and cut and len(cut) == total[i]))
            columns[text_col] = pa.array(texts, columns[text_col].type)
            if length_col is not None:
                old = columns[length_col]
                columns[length_col] = pa.array([len(texts[i]) if numbers[i] else x for i, x in enumerate(old.to_pylist())],
                                               old.type)
            arrays = [columns[c] for c in kept]
            if counts:
                arrays += [pa.array(total, pa.int64()), pa.array([len(set(x)) for x in numbers], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields]).filter(pa.array(stay, pa.bool_()))

    # at most one number per line of a document
    listed = gone.groupBy(F.col("row").alias(key)).agg(F.collect_set("number").alias(cut_col))
    touched = fuse.shared_filter(spark, gone.select(F.col("row").alias("key")), 16)
    if touched is None:
        return keyed.join(listed, key, "left").mapInArrow(run, schema)

    # one function for both steps: a chain of two would take a Python worker each
    whole = keyed.mapInArrow(lambda batches: run(batches, (touched, False)), schema)
    changed = keyed.mapInArrow(lambda batches: sifted(batches, touched, True), keyed.schema)
    return whole.unionByName(changed.join(listed, key, "left").mapInArrow(run, schema))


def sifted(batches, held, inside: bool):
    """Rows whose last column the filter may hold, or those that it does not, in bounded parts."""
    for batch in batches:
        hit = fuse.probe(held.value, batch.column(batch.num_columns - 1).to_numpy())
        part = batch.filter(pa.array(hit == inside))
        for i in range(0, part.num_rows, 1024):
            yield part.slice(i, 1024)
