"""Quality rules: counted base rules, and a hashed n-gram logistic regression with calibration.

Base counts come from whole texts: words are ``[^\\x20\\x09-\\x0D]+``. A text fails the base rules
with fewer than ``MIN_WORDS`` words, or when more than a fifth of its words lie in 5-word windows
that occur twice or more. The model sees, per text, the shares of hashed word uni- and bigrams and
of hashed character 4-grams; it is fitted on at most ``SAMPLE_ROWS`` labelled rows, half of either class
(chosen by a hash of the id, so the choice does not follow the order of the table), calibrated by Platt
scaling on the fifth of them that was held out and set right for the classes' shares of all labels, and
applied in Arrow batches. A text is kept when it passes the base rules and its calibrated probability
reaches ``THRESHOLD``.

Null text: no words, so it fails. Labels that are null or have no document are not used; with fewer than
``MIN_LABELS`` of either class among all others there is no model: every text then has probability 1 (the
base rules decide alone). An id that is labelled or held twice counts once for each label. Extra columns
of the documents pass through ``filter_documents`` unchanged; those that share a name with an
output column of ``score`` are not returned by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkit as tk
from ledgerline.session import scratch_dir, ship_package

# Documented parameters.
SAMPLE_ROWS = 1_500
MIN_LABELS = 20
CELLS = 1 << 16
MIN_WORDS = 10
REPEAT_PERCENT = 20
THRESHOLD = 0.5
EPOCHS = 120
STEP = 0.3
DECAY = 1e-5

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

_U = np.uint64
SCORE_SCHEMA = ("doc_id {}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                "base_failed boolean, kept boolean, probability double")


@dataclass(frozen=True)
class Model:
    """Weights over hashed cells (words first, character n-grams second), then the calibration line."""

    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * raw + self.offset, -50, 50)))


def grams(t: tk.Texts, words: np.ndarray, row: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, cells) of the word uni- and bigrams and of the character 4-grams."""
    shift = _U(64 - int(CELLS).bit_length() + 1)
    pairs = tk.window_hashes(words, 2)
    same = row[:len(pairs)] == row[1:] if len(pairs) else np.zeros(0, dtype=bool)
    cells = np.concatenate((words >> shift, pairs[same] >> shift)).astype(np.int64)
    rows = np.concatenate((row, row[:len(pairs)][same]))
    lead, code = tk.code_points(t.data)
    n = max(0, len(code) - 3)
    low, high = code & np.uint32(0xFF), code >> np.uint32(8)
    four = low[:n] | low[1:n + 1] << 8 | low[2:n + 2] << 16 | low[3:n + 3] << 24
    if high.any():
        for k, odd in enumerate((0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1)):
            four ^= high[k:n + k] * np.uint32(odd)
    four *= np.uint32(0x9E3779B1)
    of_char = np.repeat(np.arange(t.rows), np.diff(np.searchsorted(lead, t.offs)))
    inside = of_char[:n] == of_char[3:] if n else np.zeros(0, dtype=bool)
    return [(rows, cells), (of_char[:n][inside],
                            (four[inside] >> np.uint32(33 - int(CELLS).bit_length())).astype(np.int64) + CELLS)]


def raw_scores(parts, weights: np.ndarray, n_rows: int) -> np.ndarray:
    """Bias plus, for each kind of n-gram, the mean weight of the row's cells."""
    raw = np.full(n_rows, weights[2 * CELLS])
    for rows, cells in parts:
        total = np.bincount(rows, weights=weights[cells], minlength=n_rows)
        raw += total / np.maximum(np.bincount(rows, minlength=n_rows), 1)
    return raw


def base_counts(t: tk.Texts) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The contract's counts by row, the word hashes and the words' rows."""
    starts, ends, row = tk.word_spans(t)
    spans = tk.Spans(t.data)
    words = spans(starts, ends)
    n = t.rows
    counts = np.bincount(row, minlength=n)
    chars = np.zeros(len(t.data) + 1, dtype=np.int64)
    np.cumsum(((t.data & 0xC0) != 0x80) & ~tk.WHITE[t.data], out=chars[1:])
    symbols = np.zeros(len(t.data) + 1, dtype=np.int64)
    np.cumsum(SYMBOLS[t.data], out=symbols[1:])

    # lines with a word that equal an earlier line of their row
    breaks = np.flatnonzero(t.data == 10)
    edges = np.unique(np.concatenate((t.offs[:-1][np.diff(t.offs) > 0], breaks + 1)))
    edges = edges[edges < len(t.data)]
    stop = np.append(edges[1:], len(t.data))
    stop = stop - ((stop > edges) & (t.data[np.maximum(stop, 1) - 1] == 10) if len(t.data) else 0)
    line_row = np.searchsorted(t.offs[1:], edges, side="right")
    first_word = np.searchsorted(starts, edges)
    inked = np.append(starts, np.int64(1 << 62))[first_word] < stop
    dup_lines = np.bincount(line_row[inked][_equal_before(t.data, spans, edges[inked], stop[inked], line_row[inked])], minlength=n)

    # words covered by 5-word windows that occur twice or more in their row
    windows = tk.window_hashes(words, 5)
    whole = row[:len(windows)] == row[4:] if len(windows) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(whole)
    often = at[_repeated(windows[at], row[at])]
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, often, 1)
    np.add.at(cover, often + 5, -1)
    repeat = np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=n)
    return {"n_words": counts, "word_chars": np.diff(chars[t.offs]), "n_symbols": np.diff(symbols[t.offs]),
            "n_dup_lines": dup_lines, "n_repeat_words": repeat}, words, row


def _grouped(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that groups equal (row, hash) pairs, earliest first, and where a new pair begins."""
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(rows[order].astype(np.uint16), kind="stable")]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    return order, new


def _equal_before(data: np.ndarray, spans: tk.Spans, start: np.ndarray, stop: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Spans that equal an earlier one of their row. Equal hashes propose; the bytes decide."""
    order, new = _grouped(spans(start, stop), rows)
    leader = order[new][np.cumsum(new) - 1]
    again, first = order[~new], leader[~new]
    alike = (stop - start)[again] == (stop - start)[first]
    alike[alike] = tk.same_bytes(data, start[again[alike]], start[first[alike]], (stop - start)[again[alike]])
    found = again[alike].tolist()
    seen: set[tuple[int, bytes]] = set()
    for k in sorted(again[~alike].tolist()):  # one hash, other bytes than the first: among themselves
        own = int(rows[k]), data[start[k]:stop[k]].tobytes()
        found += [k] * (own in seen)
        seen.add(own)
    return np.array(found, dtype=np.int64)


def _repeated(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    order, new = _grouped(hashes, rows)
    more = ~new
    more[:-1] |= ~new[1:]
    return order[more]


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * counts["n_words"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on a bounded sample of labelled rows: ``sample_rows`` sparse rows meet in one task; only the model
    reaches the driver."""
    ship_package(docs.sparkSession)
    positive = F.col("_label") != 0
    known = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int")
                                                               .alias("_label"))
    # ids alone meet here; texts are joined for the drawn rows only
    known = known.join(docs.select(F.col(id_col).alias("_id")), "_id", "left_semi").distinct()
    at = scratch_dir(docs.sparkSession, "labels")
    known.write.parquet(at)
    known = docs.sparkSession.read.parquet(at)
    up, down = known.agg(F.count_if(positive), F.count_if(~positive)).first()
    if min(up, down) < MIN_LABELS:
        return None
    order = [F.xxhash64("_id"), "_id", "_label"]
    drawn = known.filter(positive).orderBy(*order).limit(sample_rows // 2).unionByName(
        known.filter(~positive).orderBy(*order).limit(sample_rows // 2))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # an id may be held by any number of rows: one text of it is read
    sample = rows.join(F.broadcast(drawn), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))

    def cells(batches):
        for batch in batches:
            for t in tk.text_slices(batch.column(2)):
                words_at = tk.word_spans(t)
                words = tk.span_hashes(t.data, words_at[0], words_at[1])
                packed = [[] for _ in range(t.rows)]
                for rows, found in grams(t, words, words_at[2]):
                    order = np.argsort(rows, kind="stable")
                    rows, found = rows[order], found[order]
                    ends = np.searchsorted(rows, np.arange(t.rows + 1))
                    for i in range(t.rows):
                        own = found[ends[i]:ends[i + 1]]
                        kinds, many = np.unique(own, return_counts=True)
                        share = (many / max(len(own), 1)).astype("<f4")
                        packed[i].append(kinds.astype("<i4").tobytes() + share.tobytes())
                part = batch.slice(t.first, t.rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([p[0] for p in packed], pa.binary()),
                     pa.array([p[1] for p in packed], pa.binary())], names=["id", "label", "words", "bytes"])

    got = sample.mapInArrow(cells, f"id {docs.schema[id_col].dataType.simpleString()}, label int, words binary, bytes binary")

    def train(batches):
        found = [row for batch in batches for row in batch.to_pylist()]
        found.sort(key=lambda r: (str(r["id"]), r["label"], r["words"]))
        y = np.array([1 if r["label"] else 0 for r in found], dtype=np.float64)
        # every fifth row of either class is held out
        held = np.where(y > 0, np.cumsum(y), np.cumsum(1 - y)) % 5 == 0
        model = _train([_sparse(r) for r in found], y, held, up, down)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.slope]),
                                          pa.array([model.offset])], names=["weights", "slope", "offset"])

    model = got.repartition(1).mapInArrow(train, "weights binary, slope double, offset double").first()
    return Model(np.frombuffer(model["weights"]), model["slope"], model["offset"])


def _sparse(row) -> tuple[np.ndarray, np.ndarray]:
    cells, shares = [], []
    for packed in (row["words"], row["bytes"]):
        n = len(packed) // 8
        cells.append(np.frombuffer(packed, "<i4", n))
        shares.append(np.frombuffer(packed, "<f4", n, n * 4))
    return np.concatenate(cells), np.concatenate(shares)


def _train(sparse, y: np.ndarray, held: np.ndarray, up: int, down: int) -> Model:
    """Full-gradient Adam on the log loss (classes weighted equally), then Platt scaling, in which the held-out
    rows of a class stand for all of its labels (``up`` and ``down``)."""
    row = np.repeat(np.arange(len(y)), [len(c) for c, _ in sparse])
    cell = np.concatenate([c for c, _ in sparse]).astype(np.int64)
    share = np.concatenate([s for _, s in sparse]).astype(np.float64)
    n = 2 * CELLS + 1
    train = (~held).astype(np.float64)
    each = train * np.where(y > 0, 0.5 / max((train * y).sum(), 1), 0.5 / max((train * (1 - y)).sum(), 1))
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)

    def raw():
        return w[-1] + np.bincount(row, weights=w[cell] * share, minlength=len(y))

    for step in range(1, EPOCHS + 1):
        off = each * (1 / (1 + np.exp(-np.clip(raw(), -50, 50))) - y)
        grad = np.bincount(cell, weights=off[row] * share, minlength=n) + DECAY * w
        grad[-1] = off.sum()
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w = w - STEP * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    slope, offset = _platt(raw()[held], y[held], up, down)
    return Model(w, slope, offset)


def _platt(raw: np.ndarray, y: np.ndarray, up: int, down: int) -> tuple[float, float]:
    """Newton steps on the two calibration parameters, with smoothed targets; ``up`` and ``down`` rows of the
    classes are meant by those that are given."""
    weight = np.where(y > 0, up / max(y.sum(), 1), down / max((1 - y).sum(), 1))
    weight /= weight.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    scale = max(raw.std(), 1e-9)
    a, b = 1.0 / scale, -raw.mean() / scale
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -50, 50)))
        g = np.array([(weight * (p - target) * raw).sum(), (weight * (p - target)).sum()])
        s = weight * (p * (1 - p) + 1e-9)
        hess = np.array([[(s * raw * raw).sum(), (s * raw).sum()], [(s * raw).sum(), s.sum()]]) + 1e-12 * np.eye(2)
        move = np.linalg.solve(hess, g)
        size = min(1.0, 5.0 / max(abs(move).max(), 1e-9))
        a, b = a - size * move[0], b - size * move[1]
        if abs(g).max() < 1e-12:
            break
    return (float(a), float(b)) if a > 0 else (1.0 / scale, float(-raw.mean() / scale))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Counts, verdict and probability of every document."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for t in tk.text_slices(batch.column(1)):
                yield _scored(t, batch.column(0).slice(t.first, t.rows), shared.value, threshold)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, SCORE_SCHEMA.format(docs.schema[id_col].dataType.simpleString()))


def _scored(t: tk.Texts, ids: pa.Array, model: Model | None, threshold: float) -> pa.RecordBatch:
    counts, words, row = base_counts(t)
    failed = base_failed(counts)
    p = np.ones(t.rows) if model is None else model.probability(raw_scores(grams(t, words, row), model.weights, t.rows))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return pa.RecordBatch.from_arrays(
        [ids] + [pa.array(counts[c].astype(np.int64)) for c in names]
        + [pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)],
        names=["doc_id", *names, "base_failed", "kept", "probability"])


def filter_documents(docs: DataFrame, model: Model | None, text_col: str = "text",
                     threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with their columns as they are: one pass, no shuffle."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            for t in tk.text_slices(texts):
                verdict = _scored(t, pa.nulls(t.rows), shared.value, threshold).column("kept")
                yield batch.slice(t.first, t.rows).filter(verdict)

    return docs.mapInArrow(run, docs.schema)
