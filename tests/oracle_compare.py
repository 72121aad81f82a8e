"""Run a registered query in Spark and its oracle SQL in DuckDB; compare.

Order-insensitive: columns sorted by name, rows compared as a multiset of
normalised text tuples. Used by the tests and by ``python -m tests.oracle_compare``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
         "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{sf_dir}/{v}.parquet')")
    return con


def compare(spark, name: str, sf_dir: str, con=None, show: int = 3) -> tuple[bool, str]:
    sys.path.insert(0, ROOT)
    import __spark_entry__ as se
    df = se.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    sql = se.oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: rows-only ({len(rows)} rows)"
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows_raw = rel.fetchall()
    if sorted(ocols) != cols:
        return False, f"{name}: columns differ\n spark={cols}\n oracle={sorted(ocols)}"
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(_norm(r[i]) for i in idx) for r in orows_raw]
    a, b = Counter(rows), Counter(orows)
    if a == b:
        return True, f"{name}: OK ({len(rows)} rows)"
    only_s = list((a - b).elements())[:show]
    only_o = list((b - a).elements())[:show]
    return False, (f"{name}: MISMATCH spark={len(rows)} oracle={len(orows)}\n cols={cols}\n"
                   f" only spark: {only_s}\n only oracle: {only_o}")


def main(argv: list[str]) -> int:
    sys.path.insert(0, ROOT)
    from boxoffice.session import get_spark
    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = a.split("=", 1)[1]
    spark = get_spark("local[8]", 8)
    import __spark_entry__ as se
    names = names or list(se.queries())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
