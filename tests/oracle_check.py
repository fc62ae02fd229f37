"""Run registered queries on Spark and their SQL oracle on DuckDB; compare.

Comparison: same column names, same type family per column, and the same
multiset of rows; doubles must be bit-equal (queries round noisy columns
themselves), dates and timestamps compare as ISO text, arrays as tuples.

    python tests/oracle_check.py [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "NaN"
        if math.isinf(f):
            return "inf" if f > 0 else "-inf"
        return repr(f + 0.0)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    return str(v)


def spark_family(t) -> str:
    n = t.typeName()
    if n in ("byte", "short", "integer", "long"):
        return "int"
    if n in ("float", "double", "decimal"):
        return "float"
    if n in ("timestamp", "timestamp_ntz"):
        return "timestamp"
    return n


def duck_family(t: str) -> str:
    t = str(t).upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT",
             "UINTEGER", "UBIGINT"):
        return "int"
    if t in ("FLOAT", "DOUBLE") or t.startswith("DECIMAL"):
        return "float"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "VARCHAR":
        return "string"
    if t.endswith("[]"):
        return "array"
    return t.lower()


def compare(spark, con, key: str, sf_dir: str) -> tuple[bool, str]:
    import __spark_entry__ as E
    q = E.queries()[key]
    sql = E.oracle_sql()[key]
    t0 = time.time()
    sdf = q(spark, sf_dir)
    s_rows = sdf.collect()
    t1 = time.time()
    cur = con.execute(sql)
    d_rows = cur.fetchall()
    d_cols = [d[0] for d in cur.description]
    d_types = [duck_family(d[1]) for d in cur.description]
    t2 = time.time()
    s_cols = sdf.columns
    s_types = [spark_family(f.dataType) for f in sdf.schema.fields]
    msg = f"spark {len(s_rows)} rows {t1 - t0:.1f}s, duck {len(d_rows)} rows {t2 - t1:.1f}s"
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    st = dict(zip(s_cols, s_types))
    dtp = dict(zip(d_cols, d_types))
    bad = [c for c in s_cols if st[c] != dtp[c]]
    if bad:
        return False, "types differ: " + ", ".join(f"{c}:{st[c]}/{dtp[c]}" for c in bad)
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_set = Counter(tuple(norm(r[i]) for i in si) for r in s_rows)
    d_set = Counter(tuple(norm(r[i]) for i in di) for r in d_rows)
    if s_set != d_set:
        only_s = list((s_set - d_set).elements())[:3]
        only_d = list((d_set - s_set).elements())[:3]
        return False, f"{msg}; values differ cols={order}\n  spark-only {only_s}\n  duck-only {only_d}"
    return True, msg


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--partitions", type=int, default=8)
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    from cartographer.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("local[8]", a.partitions)
    con = duck(a.sf)
    keys = a.keys or sorted(E.oracle_sql())
    fails = []
    for k in keys:
        try:
            ok, msg = compare(spark, con, k, a.sf)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(("PASS " if ok else "FAIL ") + k + ": " + msg, flush=True)
        if not ok:
            fails.append(k)
    print(f"{len(keys) - len(fails)}/{len(keys)} pass; failing: {fails}")
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main())
