"""Run registered queries next to their DuckDB oracle and compare rows, column names and values.

Usage: ``python -m spindle.plans.verify [sf_dir] [name ...]``.  Values are compared as multisets of rows with
columns sorted by name, the way the driver's check does.
"""

from __future__ import annotations

import json
import math
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duckdb_con(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0  # exact: both sides already round to 6 decimals
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from spindle.plans.catalog import registry

    e = registry()[name]
    t0 = time.time()
    df = e.fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
    if e.sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duckdb_con(sf_dir)
    t0 = time.time()
    res = con.execute(e.sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out["duck_s"] = round(time.time() - t0, 2)
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    d_types = {d[0]: str(d[1]) for d in res.description}
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if bad_types:
        out["types"] = bad_types
    a, b = _canon(s_cols, s_rows), _canon(d_cols, d_rows)
    if a == b:
        out["status"] = "match"
    else:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        out["status"] = f"values differ: spark-only {only_s} oracle-only {only_d}"
    return out


def main(argv: list[str]) -> int:
    from spindle.plans.catalog import registry
    from spindle.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(registry())
    spark = local_session(8)
    con = duckdb_con(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "status": f"error: {type(exc).__name__}: {str(exc)[:300]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(json.dumps(r), flush=True)
    print(json.dumps({"checked": len(names), "failed": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
