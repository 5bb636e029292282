"""Local stand-in for the driver's correctness gate: run each registered query
in Spark and its oracle SQL in DuckDB on the same parquet, then compare row
count, column names and order-insensitive values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, "/root/repo")

from parley.plans.registry import load_all  # noqa: E402
from parley.session import build_session  # noqa: E402
from parley.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(norm(None if (isinstance(x, float) and math.isnan(x)) else x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def main(sf_dir: str, names: list[str]):
    reg = load_all()
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = 0
    todo = [n for n in reg if not names or n in names]
    for n in todo:
        qd = reg[n]
        t0 = time.time()
        try:
            sp = qd.build(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        t1 = time.time()
        if qd.sql is None:
            print(f"ROWS {n}: {len(sp)} rows (no oracle) {t1 - t0:.1f}s")
            ok += 1
            continue
        try:
            dd = con.execute(qd.sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:600]}")
            continue
        sc, sr = rows_of(sp)
        dc, dr = rows_of(dd)
        st = {c: str(sp[c].dtype) for c in sp.columns}
        dt = {c: str(dd[c].dtype) for c in dd.columns}
        diff = {c: (st[c], dt.get(c)) for c in st if c in dt and st[c] != dt[c]}
        if diff:
            print(f"TYPE {n}: {diff}")
        if sc != dc:
            print(f"FAIL {n}: columns spark={sc} duck={dc}")
            continue
        if len(sr) != len(dr):
            print(f"FAIL {n}: rows spark={len(sr)} duck={len(dr)}")
            continue
        bad = [(a, b) for a, b in zip(sr, dr) if a != b]
        if bad:
            print(f"FAIL {n}: {len(bad)} differing rows, e.g.\n  spark={bad[0][0]}\n  duck ={bad[0][1]}")
            continue
        ok += 1
        print(f"OK   {n}: {len(sr)} rows {t1 - t0:.1f}s")
    print(f"{ok}/{len(todo)} ok")


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    main(sf, sys.argv[2:])
