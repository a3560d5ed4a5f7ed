"""Secret scans: base patterns, and a linear-chain conditional random field over tokens.

Base spans (kinds assign, access, hex) always stay. The field tags every token of a line as the
begin, the inside or outside of a secret. Its features are the token's shape, its neighbours'
words and shapes, and two features of the whole text (shares of digits and of assignment signs);
its labels in training are the base spans, on at most ``MAX_WINDOWS`` token windows: half of them, chosen by a
hash, of all windows around a base span anywhere, so that clean documents do not thin them out, and half
of a sample of at most about ``SAMPLE_DOCS`` documents chosen by a hash of the id. In half of the training
windows the words are hidden, so shapes have to carry the decision as well. A line is decoded by Viterbi; tokens
whose lead for "outside" is larger than all that two transitions can change are outside in every
best path, so only the runs between such tokens are walked. Tagged spans that touch no base span
are added as kind ``crf``.

Null and empty texts have no spans. Repeated rows give the same spans each. Offsets are code
points, the end exclusive. Where no document has a base span no field is fitted (there is nothing to learn
from) and none is returned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textkit as tk
from ledgerline.session import ship_package

# Documented parameters.
SAMPLE_DOCS = 20_000
MAX_WINDOWS = 6_000
WINDOW = 16
CELLS = 1 << 15
PART = 1 << 13           # tokens that are scored at once when the field is trained
STEPS = 80
RATE = 0.15
DECAY = 3e-5

# The base patterns, with the least length of what they must match.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
# any text with a base span has one of these
HINT = r"(?i)passw|secret|token|api_?key|AKIA|[0-9a-f]{32}"
LEAST = {"assign": 8, "access": 16, "hex": 32}
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

OUT, BEGIN, IN = 0, 1, 2
_U = np.uint64

HEX = np.zeros(256, dtype=bool)
HEX[[*range(48, 58), *range(97, 103)]] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
SMALL = np.zeros(256, dtype=bool)
SMALL[97:123] = True
WORDLIKE = DIGIT | UPPER | SMALL
WORDLIKE[[ord(c) for c in "+/_.-"]] = True
WORDLIKE[128:] = True


def base_spans(t: tk.Texts) -> list[tuple[int, int, int, int]]:
    """(row, byte start, byte end, kind number), bytes counted in the slice."""
    found = []
    raw = t.data.tobytes()
    low = raw.lower()
    for kind, pattern, marks, text in ((0, ASSIGN, KEYWORDS, low), (1, ACCESS, (b"AKIA",), raw)):
        hits = [p for mark in marks for p in _finds(text, mark)]
        for row in np.unique(np.searchsorted(t.offs[1:], hits, side="right")).tolist() if hits else ():
            a, b = int(t.offs[row]), int(t.offs[row + 1])
            for m in pattern.finditer(raw, a, b):
                whole = m.group(2) if kind == 0 else m.group()
                if len(whole) >= LEAST[KINDS[kind]]:
                    found.append((row, m.start(), m.end(), kind))
    starts, ends, rows = _runs(HEX[t.data], t.offs)
    for k in np.flatnonzero(ends - starts >= LEAST["hex"]).tolist():
        found.append((int(rows[k]), int(starts[k]), int(ends[k]), 2))
    return sorted(found, key=lambda s: (s[0], s[1], s[3]))


def _finds(text: bytes, mark: bytes):
    at = text.find(mark)
    while at >= 0:
        yield at
        at = text.find(mark, at + 1)


def _runs(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross rows: starts, ends, rows."""
    edge = np.zeros(len(mask) + 1, dtype=bool)
    edge[offs] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | edge[1:len(mask)]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | edge[1:len(mask)]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offs[1:], starts, side="right")


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    line: np.ndarray       # number of the token's line, counted over the slice
    feats: np.ndarray      # (features, tokens): cells of the weight table


FEATURES = 11
WORD_FEATURES = (1, 2, 3, 4)


def tokens(t: tk.Texts) -> Tokens:
    """Word-like runs and single signs, with their hashed features."""
    data = t.data
    wordy = WORDLIKE[data]
    starts, ends, _ = _runs(wordy, t.offs)
    signs = np.flatnonzero(~wordy & ~tk.WHITE[data])
    all_starts = np.concatenate((starts, signs))
    order = np.argsort(all_starts, kind="stable")
    starts = all_starts[order]
    ends = np.concatenate((ends, signs + 1))[order]
    rows = np.searchsorted(t.offs[1:], starts, side="right")
    edges = np.unique(np.concatenate((t.offs[:-1], np.flatnonzero(data == 10) + 1)))
    line = np.searchsorted(edges, starts, side="right")

    def counts(mask):
        total = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(mask, out=total[1:])
        return total

    def inside(total):
        return total[ends] - total[starts]

    digit, small, upper, hexed = (inside(counts(m[data])) for m in (DIGIT, SMALL, UPPER, HEX))
    size = ends - starts
    change = DIGIT[data].copy()
    change[1:] ^= DIGIT[data][:-1]
    mixing = np.minimum(inside(counts(change)) // 2, 4)  # how often digits and others take turns
    length = np.minimum(np.ceil(np.log2(size)).astype(np.int64), 5)  # 17 bytes and more are alike
    sign = np.where(wordy[starts], 0, data[starts]).astype(np.int64)
    shape = ((((digit > 0) * 2 + (small > 0)) * 2 + (upper > 0)) * 2 + (hexed == size)) * 16 + length
    shape = shape.astype(np.int64) * 256 + sign
    words = tk.span_hashes(tk.LOWER[data], starts, ends)
    words[size > 24] = _U(7)

    def beside(values, step, none):
        out = np.full(len(values), none, dtype=values.dtype)
        if abs(step) < len(values):
            if step > 0:
                out[:-step] = np.where(line[step:] == line[:-step], values[step:], none)
            else:
                out[-step:] = np.where(line[:step] == line[-step:], values[:step], none)
        return out

    per_row = np.maximum(np.diff(t.offs), 1)
    digits_of = np.minimum(16 * np.diff(counts(DIGIT[data])[t.offs]) // per_row, 3)
    signs_of = np.minimum(64 * np.diff(counts((data == 61) | (data == 58))[t.offs]) // per_row, 3)
    columns = [shape.astype(_U), words, beside(words, -1, _U(1)), beside(words, -2, _U(1)), beside(words, 1, _U(1)),
               beside(shape, -1, -1).astype(_U), beside(shape, 1, -1).astype(_U), beside(shape, -2, -1).astype(_U),
               (length * 16 + mixing).astype(_U), (shape * 4 + digits_of[rows]).astype(_U),
               (shape * 4 + signs_of[rows]).astype(_U)]
    feats = np.empty((FEATURES, len(starts)), dtype=np.uint16)
    for k, c in enumerate(columns):
        feats[k] = (tk.mix(c + _U((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> _U(49)).astype(np.uint16)
    return Tokens(starts, ends, rows, line, feats)


def gold(tok: Tokens, spans) -> np.ndarray:
    """Tags from base spans: the first token inside a span begins it, the others continue it."""
    tags = np.zeros(len(tok.starts), dtype=np.int8)
    for _, a, b, kind in spans:
        lo, hi = np.searchsorted(tok.ends, a, side="right"), np.searchsorted(tok.starts, b, side="left")
        if kind == 0:  # of an assignment the secret is the value: its last token
            lo = hi - 1
        tags[lo:hi] = np.where(tags[lo:hi] == OUT, IN, tags[lo:hi])
        if lo < hi:
            tags[lo] = BEGIN
    return tags


@dataclass(frozen=True)
class Field:
    """Emission weights by feature cell and tag, and transition scores (from, to)."""

    emit: np.ndarray
    move: np.ndarray

    def emissions(self, feats: np.ndarray) -> np.ndarray:
        score = np.zeros((feats.shape[1], 3), dtype=np.float32)
        for k in range(FEATURES):
            score += self.emit[feats[k]]
        return score

    def decode(self, tok: Tokens) -> np.ndarray:
        """Best tags of every line."""
        n = len(tok.starts)
        tags = np.zeros(n, dtype=np.int8)
        if not n:
            return tags
        score = self.emissions(tok.feats)
        slack = 2 * float(self.move.max() - self.move.min())
        open_at = np.flatnonzero(score[:, OUT] - score[:, 1:].max(axis=1) <= slack)
        if not len(open_at):
            return tags
        new = np.ones(len(open_at), dtype=bool)
        new[1:] = (np.diff(open_at) != 1) | (tok.line[open_at[1:]] != tok.line[open_at[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(open_at)))
        begin = open_at[first]
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        led = np.zeros(len(begin), dtype=bool)
        led[begin > 0] = tok.line[begin[begin > 0] - 1] == tok.line[begin[begin > 0]]
        stop = begin + size
        followed = np.zeros(len(begin), dtype=bool)
        inner = stop < n
        followed[inner] = tok.line[stop[inner]] == tok.line[begin[inner]]
        # runs side by side, longest first: step k walks the runs that are longer than k
        best = score[begin] + np.where(led[:, None], self.move[OUT][None, :], 0)
        back = []
        for k in range(1, int(size[0])):
            live = int(np.searchsorted(-size, -k, side="left"))
            paths = best[:live, :, None] + self.move[None]
            back.append(paths.argmax(axis=1).astype(np.int8))
            best[:live] = paths.max(axis=1) + score[begin[:live] + k]
        last = (best + np.where(followed[:, None], self.move[:, OUT][None, :], 0)).argmax(axis=1).astype(np.int8)
        for k in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -k, side="left"))
            tags[begin[:live] + k] = last[:live]
            if k:
                last[:live] = back[k - 1][np.arange(live), last[:live]]
        return tags


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Field | None:
    """Train on at most ``MAX_WINDOWS`` windows, in one task; only the weights reach the driver."""
    ship_package(docs.sparkSession)
    total = docs.count()
    share = min(1.0, sample_docs / max(total, 1))
    sample = docs.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def windows(batches, positive: bool):
        for batch in batches:
            for t in tk.text_slices(batch.column(0)):
                spans = base_spans(t)
                if positive and not spans:
                    continue
                tok = tokens(t)
                tags = gold(tok, spans)
                centre = np.flatnonzero(tags == BEGIN) if positive else _spread(len(tags))
                feats, marks = [], []
                for c in centre.tolist():
                    a, b = max(0, c - WINDOW), min(len(tags), c + WINDOW)
                    here = np.arange(a, b)[tok.line[a:b] == tok.line[c]]
                    if positive or not tags[here].any():
                        feats.append(tok.feats[:, here].T.tobytes())
                        marks.append(tags[here].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(feats, pa.binary()), pa.array(marks, pa.binary()),
                                                  pa.array([positive] * len(feats), pa.bool_())], names=["feats", "tags", "hit"])

    def train(batches):
        found = [row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3)))]
        if any(hit for _, _, hit in found):
            field = _train([(np.frombuffer(feats, np.uint16).reshape(-1, FEATURES), np.frombuffer(tags, np.int8))
                            for feats, tags, _ in found])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (field.emit, field.move)],
                                             names=["emit", "move"])

    order = [F.xxhash64("feats", "tags"), "feats", "tags"]
    found = []
    for rows, positive in ((docs.filter(F.col(text_col).rlike(HINT)), True), (sample, False)):
        got = rows.select(F.col(text_col)).mapInArrow(lambda batches, p=positive: windows(batches, p),
                                                      "feats binary, tags binary, hit boolean")
        found.append(got.orderBy(*order).limit(MAX_WINDOWS // 2))
    drawn = found[0].unionByName(found[1]).repartition(1).sortWithinPartitions(F.desc("hit"), *order)
    weights = drawn.mapInArrow(train, "emit binary, move binary").first()
    if weights is None:
        return None
    return Field(*(np.frombuffer(weights[c], np.float32).reshape(-1, 3) for c in ("emit", "move")))


def _spread(n: int, every: int = 600) -> np.ndarray:
    return np.arange(every // 2, n, every)


def _train(windows) -> Field:
    """Maximum likelihood by Adam; forward and backward sums run over all windows side by side."""
    windows = sorted(windows, key=lambda w: -len(w[1]))
    size = np.array([len(w[1]) for w in windows])
    m, width = len(windows), int(size[0])
    tags = np.zeros((m, width), dtype=np.int64)
    here = np.arange(width)[None, :] < size[:, None]
    flat = np.zeros((int(size.sum()), FEATURES), dtype=np.int64)
    at = 0
    for i, (f, g) in enumerate(windows):
        flat[at:at + len(g)], tags[i, :len(g)] = f, g
        if i % 2:  # words hidden in every second window
            flat[at:at + len(g), WORD_FEATURES] = 0
        at += len(g)
    emit, move = np.zeros((CELLS, 3)), np.zeros((3, 3))
    true = np.eye(3)[tags] * here[:, :, None]
    both = here[:, 1:]
    pairs = np.zeros((3, 3))
    np.add.at(pairs, (tags[:, :-1][both], tags[:, 1:][both]), 1)
    state = [np.zeros_like(x) for x in (emit, emit, move, move)]
    for step in range(1, STEPS + 1):
        score = np.zeros((m, width, 3))
        # in parts: all tokens' weights at once would take 264 bytes a token
        score[here] = np.concatenate([emit[flat[a:a + PART]].sum(axis=1) for a in range(0, len(flat), PART)])
        alpha = np.zeros((m, width, 3))
        beta = np.zeros((m, width, 3))
        alpha[:, 0] = score[:, 0]
        for k in range(1, width):
            alpha[:, k] = _logsum(alpha[:, k - 1][:, :, None] + move[None], 1) + score[:, k]
            alpha[:, k][~here[:, k]] = alpha[:, k - 1][~here[:, k]]
        for k in range(width - 2, -1, -1):
            onward = _logsum(move[None] + (score[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
            beta[:, k] = np.where(here[:, k + 1][:, None], onward, 0)
        z = _logsum(alpha[:, -1], 1)
        seen = np.exp(alpha + beta - z[:, None, None]) * here[:, :, None]
        off = (seen - true)[here] / m
        grad = np.stack([np.bincount(flat.ravel(), weights=np.repeat(off[:, c], FEATURES), minlength=CELLS)
                         for c in range(3)], axis=1) + DECAY * emit
        pair = alpha[:, :-1, :, None] + move[None, None]
        pair += (score[:, 1:] + beta[:, 1:])[:, :, None, :]
        pair -= z[:, None, None, None]
        np.exp(pair, out=pair)
        pair *= both[:, :, None, None]
        grad_move = (pair.sum(axis=(0, 1)) - pairs) / m + DECAY * move
        del pair
        for x, g, a, b in ((emit, grad, 0, 1), (move, grad_move, 2, 3)):
            state[a] = 0.9 * state[a] + 0.1 * g
            state[b] = 0.99 * state[b] + 0.01 * g * g
            x -= RATE * (state[a] / (1 - 0.9 ** step)) / (np.sqrt(state[b] / (1 - 0.99 ** step)) + 1e-8)
    return Field(emit.astype(np.float32), move.astype(np.float32))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _all_spans(t: tk.Texts, field: Field | None) -> list[tuple[int, int, int, int]]:
    """Base spans and the field's spans that touch none of them; kind 3 is the field's."""
    spans = base_spans(t)
    if field is None:
        return spans
    tok = tokens(t)
    tags = field.decode(tok)
    tagged = np.flatnonzero(tags != OUT)
    if not len(tagged):
        return spans
    new = np.ones(len(tagged), dtype=bool)
    new[1:] = ((np.diff(tagged) != 1) | (tags[tagged[1:]] == BEGIN)
               | (tok.line[tagged[1:]] != tok.line[tagged[:-1]]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(tagged)) - 1
    base_a = np.array([s[1] for s in spans], dtype=np.int64)
    reach = np.maximum.accumulate(np.array([s[2] for s in spans], dtype=np.int64)) if spans else base_a
    more = []
    for a, b in zip(tagged[first].tolist(), tagged[last].tolist()):
        lo, hi = int(tok.starts[a]), int(tok.ends[b])
        k = int(np.searchsorted(base_a, hi, side="left"))
        if k and reach[k - 1] > lo:
            continue
        more.append((int(tok.rows[a]), lo, hi, 3))
    return sorted(spans + more, key=lambda s: (s[0], s[1], s[3]))


def scan(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end), by start, then kind; kind crf is the field's."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            for t in tk.text_slices(batch.column(1)):
                spans = _all_spans(t, shared.value)
                chars = tk.char_counts(t.data) if spans else None
                out = [[] for _ in range(t.rows)]
                for row, a, b, kind in spans:
                    base = chars[t.offs[row]]
                    out[row].append({"kind": (*KINDS, "crf")[kind], "start": int(chars[a] - base),
                                     "end": int(chars[b] - base)})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, t.rows), pa.array(out, span_type)],
                                                 names=["doc_id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def redact(docs: DataFrame, field: Field | None, mark: str = "[SECRET]", text_col: str = "text",
           length_col: str | None = None) -> DataFrame:
    """The documents with every span replaced by ``mark``; a null text stays null.

    ``length_col``, if given, is set to the new length in code points where the text changed.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            at = names.index(text_col)
            for t in tk.text_slices(batch.column(at)):
                rows = batch.slice(t.first, t.rows)
                by_row: dict[int, list[tuple[int, int]]] = {}
                for row, a, b, _ in _all_spans(t, shared.value):
                    by_row.setdefault(row, []).append((a, b))
                if by_row:
                    texts = rows.column(at).to_pylist()
                    for row, spans in by_row.items():
                        texts[row] = _cut(t, row, spans, mark)
                    rows = rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type))
                    if length_col is not None:
                        k = names.index(length_col)
                        sizes = rows.column(k).to_pylist()
                        for row in by_row:
                            sizes[row] = len(texts[row])
                        rows = rows.set_column(k, rows.schema.field(k), pa.array(sizes, rows.schema.field(k).type))
                yield rows

    return docs.mapInArrow(run, docs.schema)


def _cut(t: tk.Texts, row: int, spans: list[tuple[int, int]], mark: str) -> str:
    out, at, stop = [], int(t.offs[row]), int(t.offs[row + 1])
    raw = t.data
    for a, b in spans:
        if a >= at:
            out.append(raw[at:a].tobytes().decode())
            out.append(mark)
        at = max(at, b)
    out.append(raw[at:stop].tobytes().decode())
    return "".join(out)
