"""Run registered queries against their SQL and compare values.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    types = {c[0]: str(c[1]) for c in res.description}
    want = res.fetchall()
    cols = sorted(df.columns)
    if cols != sorted(names):
        return f"columns {cols} != {sorted(names)}"
    kinds = dict(df.dtypes)
    bad = [f"{c}: {kinds[c]} vs {types[c]}" for c in cols if KINDS.get(kinds[c]) != types[c]]
    got = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    want = [tuple(_norm(r[names.index(c)]) for c in cols) for r in want]
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    a, b = sorted(got, key=key), sorted(want, key=key)
    if a != b:
        ex = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"{len(a)} rows vs {len(b)}; first differences {ex}"
    if bad:
        return "types " + "; ".join(bad)
    return None


def main(argv):
    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        argv = argv[:i] + argv[i + 2 :]
    import __spark_entry__ as entry
    from quillspark.session import build_session

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, oracle = entry.queries(), entry.oracle_sql()
    names = [n for n in qs if not argv or any(n.startswith(a) for a in argv)]
    failed = []
    for n in names:
        t = time.time()
        try:
            if n in oracle:
                out = compare(qs[n](spark, sf), con, oracle[n])
            else:
                out = None if qs[n](spark, sf).count() > 0 else "no rows"
        except Exception as e:  # noqa: BLE001 - report every query
            out = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok  ' if out is None else 'FAIL'} {n:36s} {time.time() - t:6.2f}s {'' if n in oracle else '(rows only)'} {out or ''}", flush=True)
        if out:
            failed.append(n)
    print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
