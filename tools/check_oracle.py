"""Local twin of the driver's correctness gate: run each Spark query and its DuckDB oracle on
the same parquet tables and compare columns, row counts and the multiset of rows.

usage: python tools/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from ledgerline.plans import oracle_sql, queries  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in records)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    import os

    spark = local_session(8, shuffle_partitions=int(os.environ.get("CHECK_SHUFFLE_PARTITIONS", "8")))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for key in keys or sorted(qs):
        t0 = time.time()
        try:
            df = qs[key](spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {key}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if key not in sqls:
            print(f"ROWS {key}: {len(srows)} rows (no oracle) {dt:.1f}s")
            continue
        try:
            cur = con.execute(sqls[key])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {key}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {key}: columns spark={scols} duckdb={dcols}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            bad += 1
            print(f"FAIL {key}: rows spark={len(srows)} duckdb={len(drows)}; "
                  f"only spark {list((a - b).items())[:3]}; only duckdb {list((b - a).items())[:3]}")
        else:
            print(f"OK   {key}: {len(srows)} rows {dt:.1f}s")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
