"""Fill-in-middle: a text's lines become prefix, middle and suffix, moved by in-place block rotation.

A text is cut into lines (``[^\\n]*\\n|[^\\n]+``); two cuts drawn from the digest of seed and id make
three segments. The bytes lie in one bytearray; a scan finds the cuts, the sentinels are inserted there

    <P>prefix <M>middle <S>suffix

and one rotation gives either form: the blocks ``<M>middle`` and ``<S>suffix`` change places (psm), or
``<P>prefix<M>middle`` and ``<S>suffix`` do (spm). A rotation is three reversals, each done in the buffer
with bounded scratch. ``restore`` finds the sentinels of an output, rotates the same blocks back and takes
the sentinels out, so the text comes back exactly. Work is per row, without a shuffle: a text is read
whole, whatever its length, and needs its own size and a few fixed blocks of memory.

Defined results: a null text is the empty one; an empty text, or one that holds a sentinel, is ``plain``
(its output is the text itself). Draws depend on the id alone, so repeated rows get equal results; a null
id draws like the empty string. Columns of the input that are called like a result (in any case) are
replaced, all others pass through. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import textkit as tk
from ledgerline.session import ship_package

PLAIN, PSM, SPM = "plain", "psm", "spm"
RESULT = (("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
          ("middle_chars", T.LongType()), ("output", T.StringType()))
SWAP_BYTES = 1 << 16


@dataclass(frozen=True)
class Template:
    """Sentinels and rates: ``rate`` percent of the texts are changed, ``spm`` percent of those to spm."""

    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"
    seed: int = 7
    rate: int = 100
    spm: int = 50

    @property
    def sentinels(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix, self.suffix, self.middle


def reverse(buf: np.ndarray, start: int, end: int) -> None:
    """Reverse ``buf[start:end]`` where it lies, swapping blocks from both ends."""
    while end - start > 1:
        step = min(SWAP_BYTES, (end - start) // 2)
        head = buf[start:start + step].copy()
        buf[start:start + step] = buf[end - step:end][::-1]
        buf[end - step:end] = head[::-1]
        start, end = start + step, end - step


def rotate(buf: np.ndarray, start: int, cut: int, end: int) -> None:
    """Exchange the neighbouring blocks [start, cut) and [cut, end): reverse each, then both as one."""
    reverse(buf, start, cut)
    reverse(buf, cut, end)
    reverse(buf, start, end)


def line_ends(text: bytes | bytearray) -> np.ndarray:
    """Byte offset after each line; a newline byte is never part of a longer code point."""
    ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 0x0A) + 1
    if len(text) and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    return ends


def arrange(text: bytes, first: int, second: int, form: str, t: Template = Template()) -> bytearray:
    """The text cut at two byte offsets, with sentinels, its blocks rotated into ``form``."""
    buf = bytearray(text)
    for at, mark in ((second, t.suffix), (first, t.middle), (0, t.prefix)):
        buf[at:at] = mark
    middle_at = len(t.prefix) + first
    suffix_at = len(t.prefix) + len(t.middle) + second
    rotate(np.frombuffer(buf, dtype=np.uint8), middle_at if form == PSM else 0, suffix_at, len(buf))
    return buf


def rearrange(output: bytes, form: str, t: Template = Template()) -> bytearray:
    """The text of an output: its blocks rotated back, its sentinels taken out."""
    buf = bytearray(output)
    if form == PLAIN:
        return buf
    prefix_at, suffix_at, middle_at = (buf.find(s) for s in t.sentinels)
    if min(prefix_at, suffix_at, middle_at) < 0:
        raise ValueError(f"an output of form {form} lacks a sentinel")
    view = np.frombuffer(buf, dtype=np.uint8)
    if form == PSM:
        rotate(view, suffix_at, middle_at, len(buf))
        marks = (prefix_at, t.prefix), (suffix_at, t.middle), (suffix_at + len(buf) - middle_at, t.suffix)
    else:
        rotate(view, suffix_at, prefix_at, len(buf))
        moved = len(buf) - prefix_at
        marks = (0, t.prefix), (middle_at - prefix_at, t.middle), (moved, t.suffix)
    del view  # a bytearray changes its size only while nothing else looks into it
    for at, mark in reversed(marks):
        del buf[at:at + len(mark)]
    return buf


def _strings(values: list) -> pa.Array:
    """UTF-8 values of one slice as a string column."""
    offs = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(values), [None, pa.py_buffer(offs), pa.py_buffer(b"".join(values))])


def transform(df: DataFrame, template: Template = Template(), id_col: str = "doc_id", text_col: str = "text",
              keep_text: bool = False) -> DataFrame:
    """Add n, form, prefix_chars, middle_chars and output; the text column goes unless kept."""
    ship_package(df.sparkSession)
    results = {name for name, _ in RESULT}
    kept = [c for c in df.columns if c.lower() not in results and (keep_text or c != text_col)]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(*r) for r in RESULT])
    text_at, draw = tk.free_name("_text", df.columns), tk.free_name("_draw", df.columns)
    digest = F.sha2(F.concat(F.lit(f"{template.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    parts = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            draws = np.asarray(batch.column(names.index(draw)).flatten()).reshape(-1, 4).tolist()
            for t in tk.text_slices(batch.column(names.index(text_at))):
                raw, chars = t.data.tobytes(), tk.char_counts(t.data)
                out: dict[str, list] = {name: [] for name, _ in RESULT}
                for i in range(t.rows):
                    text = raw[t.offs[i]:t.offs[i + 1]]
                    h1, h2, h3, h4 = draws[t.first + i]
                    ends = line_ends(text)
                    out["n"].append(len(ends))
                    if not text or h3 % 100 >= template.rate or any(s in text for s in template.sentinels):
                        values = PLAIN, None, None, text
                    else:
                        cuts = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
                        first, second = (int(ends[c - 1]) if c else 0 for c in cuts)
                        form = SPM if h4 % 100 < template.spm else PSM
                        sizes = np.diff(chars[t.offs[i] + np.array([0, first, second])]).tolist()
                        values = form, *sizes, arrange(text, first, second, form, template)
                    for name, value in zip(("form", "prefix_chars", "middle_chars", "output"), values):
                        out[name].append(value)
                rows = batch.slice(t.first, t.rows)
                columns = [rows.column(names.index(c)) for c in kept]
                columns += [pa.array(out["n"], pa.int64()), pa.array(out["form"], pa.string()),
                            pa.array(out["prefix_chars"], pa.int64()), pa.array(out["middle_chars"], pa.int64()),
                            _strings(out["output"])]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *out])

    columns = [F.col(c) for c in kept] + [F.col(text_col).alias(text_at), F.array(*parts).alias(draw)]
    return df.select(*columns).mapInArrow(run, schema)


def restore(df: DataFrame, template: Template = Template(), output_col: str = "output", form_col: str = "form") -> DataFrame:
    """Add ``restored``, the text of each output; a null output gives the empty text."""
    ship_package(df.sparkSession)
    kept = [c for c in df.columns if c.lower() != "restored"]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("restored", T.StringType())])

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            forms = batch.column(names.index(form_col)).to_pylist()
            for t in tk.text_slices(batch.column(names.index(output_col))):
                raw = t.data.tobytes()
                texts = [rearrange(raw[t.offs[i]:t.offs[i + 1]], forms[t.first + i], template) for i in range(t.rows)]
                rows = batch.slice(t.first, t.rows)
                yield pa.RecordBatch.from_arrays([rows.column(names.index(c)) for c in kept] + [_strings(texts)],
                                                 names=[*kept, "restored"])

    return df.select(*kept).mapInArrow(run, schema)
