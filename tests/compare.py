"""Compare registered queries with their SQL at one scale: ``python tests/compare.py [name prefix ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value
    return value


def keyed(rows):
    return sorted(repr(tuple(plain(v) for v in r)) for r in rows)


def kinds(rows, n):
    found = []
    for i in range(n):
        v = next((r[i] for r in rows if r[i] is not None), None)
        found.append("float" if isinstance(v, Decimal) else type(v).__name__)
    return found


def differences(df, con, sql, show=3):
    """Empty when names, Python types and the multiset of rows agree."""
    cols = sorted(df.columns)
    got = [tuple(r) for r in df.select(*cols).collect()]
    rel = con.sql(sql)
    names = list(rel.columns)
    if sorted(names) != cols:
        return [f"columns {cols} against {sorted(names)}"], len(got)
    order = [names.index(c) for c in cols]
    want = [tuple(r[i] for i in order) for r in rel.fetchall()]
    problems = []
    if len(got) != len(want):
        problems.append(f"rows {len(got)} against {len(want)}")
    if got and want and kinds(got, len(cols)) != kinds(want, len(cols)):
        pairs = zip(cols, kinds(got, len(cols)), kinds(want, len(cols)))
        problems.append("types " + ", ".join(f"{c}: {a}/{b}" for c, a, b in pairs if a != b))
    a, b = keyed(got), keyed(want)
    if a != b:
        only_a = sorted(set(a) - set(b))
        only_b = sorted(set(b) - set(a))
        problems.append(f"{len(only_a)} rows differ: {only_a[:show]} against {only_b[:show]}")
    return problems, len(got)


def main(prefixes):
    import __spark_entry__ as entry
    from shelfcast.session import local_session

    folder = os.environ.get("COMPARE_SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    con = connect(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in oracles:
                problems, n = differences(df, con, oracles[name])
            else:
                problems, n = [], len(df.collect())
        except Exception as err:  # report and go on with the next query
            problems, n = [f"{type(err).__name__}: {str(err)[:1500]}"], 0
        bad += bool(problems)
        mark = "FAIL" if problems else ("ok  " if name in oracles else "rows")
        print(f"{mark} {name} {n} rows {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ",
              flush=True)
    print(f"{bad} with differences")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
