"""HTML tables as rows: many pages parsed in parallel (mapInPandas over a pages DataFrame), one
output row per table row with its cells. Uses the standard-library parser; entities are decoded
and whitespace collapsed as a browser shows it. End tags of cells and rows may be missing, and so
may the table's; a cell that spans columns or rows is repeated in all of its places. The header
rows of a table are those of its thead, else its leading rows of th cells, else its first row."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import HTML_CELLS
from ledgerline.session import ship_package


MAX_SPAN = 1000  # the HTML standard's limit of colspan


class _Tables(HTMLParser):
    """Collects the rows of every table; a nested table keeps its own row/cell state, so the
    enclosing table's current row survives it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.done, self.count = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"no": self.count, "rows": [], "row": None, "cell": None, "head": False})
            self.count += 1
            return
        if not self.open:
            return
        t = self.open[-1]
        if tag in ("thead", "tbody", "tfoot"):
            self._end_row(t)
            t["head"] = tag == "thead"
        elif tag == "tr":
            self._end_row(t)
            t["row"] = []
        elif tag in ("td", "th"):
            self._end_cell(t)
            if t["row"] is None:
                t["row"] = []
            spans = {k: int(v) if (v or "").strip().isdigit() else 1 for k, v in attrs if k in ("colspan", "rowspan")}
            t["cell"] = {"text": [], "th": tag == "th", "across": min(max(spans.get("colspan", 1), 1), MAX_SPAN),
                         "down": max(spans.get("rowspan", 1), 1)}
        elif tag == "br" and t["cell"] is not None:
            t["cell"]["text"].append(" ")

    def handle_endtag(self, tag):
        if not self.open:
            return
        t = self.open[-1]
        if tag in ("td", "th"):
            self._end_cell(t)
        elif tag == "tr":
            self._end_row(t)
        elif tag in ("thead", "tbody", "tfoot"):
            self._end_row(t)
            t["head"] = False
        elif tag == "table":
            self._end_table()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"]["text"].append(data)

    def close(self):
        super().close()
        while self.open:
            self._end_table()

    @staticmethod
    def _end_cell(t):
        c = t["cell"]
        if c is not None:
            t["row"].append((" ".join("".join(c["text"]).split()), c["th"], c["across"], c["down"]))
            t["cell"] = None

    def _end_row(self, t):
        self._end_cell(t)
        if t["row"] is not None:
            t["rows"].append((t["head"], t["row"]))
            t["row"] = None

    def _end_table(self):
        t = self.open.pop()
        self._end_row(t)
        self.done.append((t["no"], _with_header(_spread(t["rows"]))))


def _spread(rows):
    """(in thead, all th, texts) of each row, with spanning cells in all of their places."""
    pending = {}  # column -> (rows still to fill, text)
    out = []
    for head, cells in rows:
        texts, kinds, at, queue = [], [], 0, list(cells)
        while queue or any(c >= at for c in pending):
            if at in pending:
                left, text = pending.pop(at)
                texts.append(text)
                if left > 1:
                    pending[at] = (left - 1, text)
                at += 1
            elif queue:
                text, th, across, down = queue.pop(0)
                for _ in range(across):
                    texts.append(text)
                    kinds.append(th)
                    if down > 1:
                        pending[at] = (down - 1, text)
                    at += 1
            else:
                at = min(c for c in pending if c >= at)
                texts += [""] * (at - len(texts))
        out.append((head, bool(kinds) and all(kinds), texts))
    return out


def _with_header(rows):
    """(is header, texts) of each row."""
    if any(head for head, _, _ in rows):
        return [(head, texts) for head, _, texts in rows]
    leading = next((i for i, (_, th, _) in enumerate(rows) if not th), len(rows))
    return [(i < max(leading, 1), texts) for i, (_, _, texts) in enumerate(rows)]


def _parse(it):
    cols = [f.name for f in HTML_CELLS.fields]
    for pdf in it:
        out = []
        for page_id, html in zip(pdf["page_id"], pdf["html"]):
            p = _Tables()
            p.feed(html or "")
            p.close()
            for table_no, rows in sorted(p.done, key=lambda t: t[0]):
                for row_no, (is_header, cells) in enumerate(rows):
                    out.append((int(page_id), table_no, row_no, is_header, cells))
        yield pd.DataFrame(out, columns=cols)


def table_cells(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, table_no, row_no, is_header, cells) for every table row of every page."""
    ship_package(pages.sparkSession)
    return pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(html).alias("html")).mapInPandas(
        _parse, HTML_CELLS)


def first_table(cells: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of each page's first table, picking ``columns`` (header text -> output name) by
    their header position; an empty cell is null."""
    first = cells.filter(F.col("table_no") == 0)
    header = first.filter("is_header").groupBy("page_id").agg(F.min_by("cells", "row_no").alias("_header"))
    data = first.filter(~F.col("is_header")).join(header, "page_id")
    out = [F.col("page_id"), F.col("row_no")]
    for text, name in columns.items():
        pos = F.array_position("_header", F.lit(text)).cast("int")
        v = F.when(pos > 0, F.element_at("cells", pos))
        out.append(F.when(F.length(v) > 0, v).alias(name))
    return data.select(*out)


def _esc(c):
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def render_tables(rows: DataFrame, columns: list[tuple[str, str]], page_of: str, order: str,
                  title: str = "List") -> DataFrame:
    """Render rows as one HTML table per page (bounded rows per page), plus a second table that
    readers of the first table must skip. ``columns``: (header text, column name)."""
    th = "".join(f"<th>{h}</th>" for h, _ in columns)
    cells = [F.concat(F.lit("<td>"), F.coalesce(_esc(F.col(c).cast("string")), F.lit("")), F.lit("</td>"))
             for _, c in columns]
    tr = F.concat(F.lit("<tr>"), *cells, F.lit("</tr>\n"))
    g = rows.select(F.col(page_of).alias("page_id"), F.col(order).alias("_o"), tr.alias("_tr")).groupBy("page_id").agg(
        F.sort_array(F.collect_list(F.struct("_o", "_tr"))).alias("_rows"))
    body = F.array_join(F.transform("_rows", lambda x: x["_tr"]), "")
    html = F.concat(
        F.lit(f"<html><body><h1>{title}</h1>\n<table class=\"wikitable\" id=\"constituents\">\n<thead><tr>{th}</tr></thead>\n<tbody>\n"),
        body,
        F.lit("</tbody></table>\n<h2>Changes</h2><table><tr><th>Date</th><th>Added</th></tr>"
              "<tr><td>2024&nbsp;01</td><td>none</td></tr></table></body></html>"),
    )
    return g.select("page_id", html.alias("html"))
