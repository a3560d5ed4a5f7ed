"""Embedding whitening over an exact, bit-sliced scatter matrix.

Every entry c becomes the whole number x = floor(scale * c) + shift. The sums of products of x, which a
covariance needs, are counted instead of multiplied: each dimension, less its smallest x, is split into bit
planes, and 64 rows of a plane are packed into one word. The number of rows where two planes are both set is
the popcount of the words' AND, and

    sum of x_i * x_j = sum over planes a of i and b of j of 2^(a + b) * popcount(plane_ia & plane_jb)

so tasks add up whole numbers only. The driver gets one sum per pair of dimensions (the width squared,
whatever the number of rows), centres them as whole numbers, n * sum(x_i * x_j) - S_i * S_j, divides once by
n^2 and asks ``eigh`` for the components.

The rows are read three times, each time without a shuffle of rows: for the bounds of each dimension, for the
scatter, and for the projection. What is shuffled are the partial sums of tasks, of which there are no more
than the cluster runs at once or the rows need.

Defined results: a row is left out if its vector is null or empty, holds a null or an entry that is not
finite, has another width than most vectors (of equally common widths the larger counts), or holds an
entry of 2^52 or more, whose x is no long. Repeated rows and ids count as often as they come; a null id is
kept. Components whose eigenvalue is zero to double precision have no direction and are left out, so rows
that are all alike, a single row and an empty table give an empty result. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import textkit as tk
from ledgerline.session import scratch_dir, ship_package

SCALE, SHIFT = 1024, 100_000
ENTRY_BOUND = float(1 << 52)
COMPONENTS = 8
BLOCK_ENTRIES = 1 << 20  # entries whose planes are counted at once
TASK_ROWS = 4_000_000  # rows whose partial sums one task adds up
LIMB = 30  # partial sums travel as high and low parts, so that each fits a decimal sum
WIDE = T.DecimalType(38, 0)


@dataclass
class Whitening:
    """What the fit list gives: its size, sums and bounds, and its components by falling eigenvalue."""

    width: int
    n: int
    sums: list[int]
    bound: int  # no |x| is above it
    covariance: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray  # one unit vector a row

    @property
    def explained(self) -> list[float]:
        total = float(np.trace(self.covariance))
        return [float(e) / total for e in self.eigenvalues]


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, vector as doubles) of the rows that count, and the vectors' width (0: no such row)."""
    df = df.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    fine = F.forall("_v", lambda c: F.coalesce(F.abs(c) < ENTRY_BOUND, F.lit(False)))
    df = df.filter(F.coalesce(fine, F.lit(False)) & (F.size("_v") > 0))
    width = (df.groupBy(F.size("_v").alias("width")).agg(F.count(F.lit(1)).alias("rows"))
             .orderBy(F.desc("rows"), F.desc("width")).first())
    width = width["width"] if width else 0
    return df.filter(F.size("_v") == width), width


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """x of every row of a batch, as rows by width."""
    entries = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)
    return np.floor(entries * SCALE).astype(np.int64) + SHIFT


def _bounds(vectors: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, and the least and largest x of each dimension."""
    def run(batches):
        rows, low, high = 0, None, None
        for batch in batches:
            if batch.num_rows:
                x = whole_numbers(batch.column(0), width)
                least, most = x.min(axis=0), x.max(axis=0)
                low = least if low is None else np.minimum(low, least)
                high = most if high is None else np.maximum(high, most)
                rows += len(x)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(low), pa.array(high),
                                              pa.array(np.full(width, rows))], names=["dim", "low", "high", "rows"])

    found = (vectors.select("_v").mapInArrow(run, "dim int, low bigint, high bigint, rows bigint").groupBy("dim")
             .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows")).collect())
    found.sort(key=lambda r: r["dim"])
    return (found[0]["rows"] if found else 0, np.array([r["low"] for r in found], dtype=np.int64),
            np.array([r["high"] for r in found], dtype=np.int64))


def bit_planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Planes of all dimensions (dimension by dimension, low bits first): one row of 64-bit words each."""
    y = (x - low).astype(np.uint64)
    words = -(-len(y) // 64)
    firsts = np.concatenate(([0], np.cumsum(bits)))
    planes = np.zeros((int(firsts[-1]), words), dtype=np.uint64)
    for b in range(int(bits.max(initial=0))):
        dims = np.flatnonzero(bits > b)
        packed = np.packbits((y[:, dims] >> np.uint64(b)).astype(np.uint8) & 1, axis=0)
        full = np.zeros((len(dims), words * 8), dtype=np.uint8)
        full[:, :len(packed)] = packed.T
        planes[firsts[dims] + b] = full.view(np.uint64)
    return planes


def weighted_popcounts(planes: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of y_i, and of y_i * y_j for i <= j, of the rows whose planes are given.

    Whole numbers throughout: 64-bit ones where no sum can pass 2^62, else Python's.
    """
    width, most = len(bits), int(bits.max(initial=0))
    kind = np.int64 if 2 * most + (64 * planes.shape[1]).bit_length() < 62 else object
    sums, products = np.zeros(width, dtype=kind), np.zeros((width, width), dtype=kind)
    firsts = np.concatenate(([0], np.cumsum(bits)))[:-1]
    active = np.flatnonzero(bits)
    weights = np.array([1 << b for i in active for b in range(bits[i])], dtype=kind)
    for place, i in enumerate(active):
        start = firsts[i]
        heads = firsts[active[place:]] - start
        for a in range(bits[i]):
            plane = planes[start + a]
            both = np.bitwise_count(planes[start:] & plane).sum(axis=1, dtype=np.int64).astype(kind)
            products[i, active[place:]] += np.add.reduceat(both * weights[start:], heads) * (1 << a)
            sums[i] += int(both[a]) << a  # a plane ANDed with itself
    return sums, products


def _scatter(vectors: DataFrame, width: int, n: int, low: np.ndarray, high: np.ndarray) -> tuple[list, list]:
    """Sums of y = x - low, and of its products, over all rows, as Python numbers."""
    spark = vectors.sparkSession
    bits = np.array([int(h - lo).bit_length() for lo, h in zip(low.tolist(), high.tolist())], dtype=np.int64)
    block = max(64, BLOCK_ENTRIES // width // 64 * 64)
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS))

    def blocks(batches) -> Iterator[np.ndarray]:
        held, rows = [], 0
        for batch in batches:
            x = whole_numbers(batch.column(0), width)
            while len(x):
                part, x = x[:block - rows], x[block - rows:]
                held.append(part)
                rows += len(part)
                if rows == block:
                    yield np.concatenate(held)
                    held, rows = [], 0
        if rows:
            yield np.concatenate(held)

    def run(batches):
        mask, parts = (1 << LIMB) - 1, None
        for x in blocks(batches):
            sums, products = weighted_popcounts(bit_planes(x, low, bits), bits)
            flat = np.concatenate((sums, products[np.triu_indices(width)]))
            now = np.stack((flat >> LIMB, flat & mask))
            parts = now if parts is None else parts + now
        if parts is not None:
            limbs = [pa.array([Decimal(int(v)) for v in p], pa.decimal128(38, 0)) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts.shape[1])), *limbs], names=["at", "high", "low"])

    partial = vectors.select("_v").coalesce(tasks).mapInArrow(run, "at bigint, high decimal(38,0), low decimal(38,0)")
    totals = partial.groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    flat = [0] * (width + width * (width + 1) // 2)
    for r in totals:
        flat[r["at"]] = (int(r["high"]) << LIMB) + int(r["low"])
    products = [[0] * width for _ in range(width)]
    for value, i, j in zip(flat[width:], *(k.tolist() for k in np.triu_indices(width))):
        products[i][j] = products[j][i] = value
    return flat[:width], products


def fit(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The components of all usable rows; None if there is none."""
    ship_package(df.sparkSession)
    vectors, width = usable(df, id_col, vector_col)
    if not width:
        return None
    n, low, high = _bounds(vectors, width)
    sums, products = _scatter(vectors, width, n, low, high)
    # centred whole numbers, each divided once and rounded once
    covariance = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(width)] for i in range(width)])
    values, vectors_ = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > np.trace(covariance) * width * 2.0 ** -50]
    axes = vectors_.T[order]
    # either sign will do: the largest entry is positive, so that a repeated run agrees
    axes *= np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
    low, high = low.tolist(), high.tolist()
    return Whitening(width, n, [s + n * lo for s, lo in zip(sums, low)], max(map(abs, low + high)), covariance,
                     values[order], axes)


def project(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, ``deviation`` (sum of (n * x - S)^2, exact; null above 38 digits) and ``whitened`` (one entry a component)
    of the usable rows of the model's width."""
    ship_package(df.sparkSession)
    vectors, _ = usable(df, id_col, vector_col)
    vectors = vectors.filter(F.size("_v") == model.width)
    fitted = df.sparkSession.sparkContext.broadcast(model)  # width x components numbers
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("deviation", WIDE),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches):
        m = fitted.value
        axes = (m.components / np.sqrt(m.eigenvalues)[:, None]).T
        small = m.n * m.bound < 1 << 61
        sums = np.array(m.sums, dtype=np.int64 if small else object)
        for batch in batches:
            x = whole_numbers(batch.column(1), m.width)
            if not small:
                x = x.astype(object)
            off = x * m.n - sums
            far = int(np.abs(off).max(initial=0))
            exact = off if far * far * m.width < 1 << 62 else off.astype(object)
            spread = [Decimal(int(v)) for v in (exact * exact).sum(axis=1)]
            white = (off / m.n).astype(np.float64) @ axes
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * axes.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([v if v < 10 ** 38 else None for v in spread], pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(ends, pa.array(white.ravel()))], names=[id_col, "deviation", "whitened"])

    return vectors.mapInArrow(run, schema)


def identity_error(projected: DataFrame, components: int) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, measured on the rows."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    row = projected.select(*(F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c{i}_{j}")
                             for i, j in pairs)).first()
    return max((abs((row[k] or 0.0) - (i == j)) for k, (i, j) in enumerate(pairs)), default=0.0)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on all usable rows and project them: one row for each row and component.

    Returns id, component (from 1), n, deviation, whitened, explained and identity_error. The projected rows
    are written once to the shared folder, where the error is measured on them.
    """
    spark = df.sparkSession
    model = fit(df, id_col, vector_col, components)
    kept = 0 if model is None else len(model.eigenvalues)
    if not kept:
        schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
                               T.StructField("n", T.LongType()), T.StructField("deviation", WIDE)]
                              + [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")])
        return spark.createDataFrame([], schema)
    at = scratch_dir(spark, "whitened")
    project(df, model, id_col, vector_col).write.parquet(at)
    rows = spark.read.parquet(at)
    error = identity_error(rows, kept)
    place = tk.free_name("_place", [id_col])
    rows = rows.select(id_col, "deviation", F.posexplode("whitened").alias(place, "whitened"))
    return rows.select(id_col, (F.col(place) + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                       "deviation", "whitened", F.get(F.array(*map(F.lit, model.explained)), F.col(place)).alias("explained"),
                       F.lit(error).alias("identity_error"))
