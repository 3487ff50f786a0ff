"""Compare registered queries with their SQL in DuckDB, column by column and row by row.

    python tests/oracle.py [--sf DIR] [name-prefix ...]
"""
from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from allelespark.plans.fixtures import BASE

SF = "/root/testdata/sf0.01"


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def kind(v) -> str:
    return type(v).__name__


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6) or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(df, con, sql: str) -> tuple[str, int]:
    rows = [r.asDict() for r in df.collect()]
    names = sorted(df.columns)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = [dict(zip(cols, r)) for r in cur.fetchall()]
    if sorted(cols) != names:
        return f"columns {names} != {sorted(cols)}", len(rows)
    if len(rows) != len(want):
        return f"rows {len(rows)} != {len(want)}", len(rows)
    a = sorted(tuple(canon(r[c]) for c in names) for r in rows)
    b = sorted(tuple(canon(r[c]) for c in names) for r in want)
    if a == b:
        for c in names:
            ka = {kind(r[c]) for r in rows if r[c] is not None}
            kb = {kind(r[c]) for r in want if r[c] is not None}
            if ka != kb:
                return f"type of {c}: {ka} != {kb}", len(rows)
        return "ok", len(rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} differ, e.g. {names} {bad[0]}", len(rows)


def main(argv: list[str]) -> int:
    from allelespark.plans import catalog
    from allelespark.session import local_session

    sf = SF
    if argv and argv[0] == "--sf":
        sf, argv = argv[1], argv[2:]
    spark = local_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    fails = 0
    for name, fn in catalog.QUERIES.items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        t = time.time()
        try:
            if name in catalog.ORACLES:
                msg, n = compare(fn(spark, sf), con, catalog.ORACLES[name])
            else:
                n = len(fn(spark, sf).collect())
                msg = "ok (rows only)"
        except Exception as e:  # noqa: BLE001
            msg, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        fails += not msg.startswith("ok")
        print(f"{name:42s} {n:7d} {time.time() - t:6.2f}s {msg}", flush=True)
    print("failures", fails)
    return fails


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
