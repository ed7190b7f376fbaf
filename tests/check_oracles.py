"""Compare every registered query with its SQL twin: python tests/check_oracles.py [sf_dir] [name...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
    "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    return got, want, dict(df.dtypes), types


def main() -> int:
    import __spark_entry__ as entry
    from delaylake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session(
        "oracles", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, q in entry.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        if name not in oracles:
            print(f"rows  {name:24s} {q(spark, sf_dir).count()}")
            continue
        try:
            got, want, st, dt = compare(spark, con, name, q, oracles[name], sf_dir)
        except Exception as e:  # report and go on
            bad += 1
            print(f"ERROR {name:24s} {str(e)[:600]}")
            continue
        wrong = {c: (st[c], dt[c]) for c in st if TYPES.get(st[c], st[c]).upper() != dt.get(c, "").upper()}
        ok = got == want and not wrong
        bad += not ok
        print(f"{'ok   ' if ok else 'DIFF '} {name:24s} rows={len(got[1])}/{len(want[1])} {time.time() - t0:.2f}s")
        if not ok:
            print("   columns", got[0], want[0])
            a, b = set(got[1]), set(want[1])
            print("   spark only", list(a - b)[:2])
            print("   sql only  ", list(b - a)[:2])
        if only or not ok:
            print("   types", wrong or st)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
