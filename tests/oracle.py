"""Run registered queries beside their SQL and compare. ``python -m tests.oracle [-d DIR] [name...]``"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import time

import duckdb

from spindrift.queries import load
from spindrift.sources.tables import TABLE_NAMES


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, int, str)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v.normalize()))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    return v


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = sorted(([plain(r[i]) for i in order] for r in rows), key=repr)
    return [names[i] for i in order], body


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool | None, str]:
    """(matches, note); matches is None where the query has no SQL."""
    queries, oracles = load()
    df = queries[name](spark, sf_dir)
    got = df.collect()
    if name not in oracles:
        return None, f"{len(got)} rows"
    cur = con.execute(oracles[name])
    want_names = [d[0] for d in cur.description]
    a = canon(df.columns, got)
    b = canon(want_names, cur.fetchall())
    if a[0] != b[0]:
        return False, f"columns {a[0]} <> {b[0]}"
    if len(a[1]) != len(b[1]):
        return False, f"rows {len(a[1])} <> {len(b[1])}"
    for x, y in zip(a[1], b[1]):
        if repr(x) != repr(y):
            return False, f"{a[0]}\n  spark  {x}\n  oracle {y}"
    return True, f"{len(got)} rows"


def main() -> None:
    from spindrift.session import local_session

    ap = argparse.ArgumentParser()
    ap.add_argument("-d", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = local_session(8)
    con = connect(args.d)
    queries, _ = load()
    names = [n for n in queries if not args.names or any(n.startswith(p) for p in args.names)]
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            ok, note = compare(spark, con, args.d, name)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        bad += ok is False
        mark = {True: "ok  ", None: "rows", False: "FAIL"}[ok]
        print(f"{mark} {name} {time.time() - t0:.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} failed")


if __name__ == "__main__":
    main()
