"""Runs registered queries and their SQL counterparts on one folder and compares the rows.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return f"{type(v).__name__}:{v}"


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, folder, query, sql):
    """None when equal, else a short description of the difference."""
    df = query(spark, folder)
    names = sorted(df.columns)
    got = [tuple(_plain(r[c]) for c in names) for r in df.collect()]
    cur = con.execute(sql)
    found = [d[0] for d in cur.description]
    if sorted(found) != names:
        return f"columns {names} vs {sorted(found)}"
    at = [found.index(c) for c in names]
    want = [tuple(_plain(r[i]) for i in at) for r in cur.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    got, want = _sorted(got), _sorted(want)
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    return f"{len(bad)} of {len(got)} rows differ in {names}: {bad[0][0]} vs {bad[0][1]}" if bad else None


if __name__ == "__main__":
    from tillroll import oracles, registry
    from tillroll.session import get_session

    folder, only = sys.argv[1], set(sys.argv[2:])
    spark = get_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(folder), oracles.oracle_sql()
    failed = 0
    for name, query in registry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            result = compare(spark, con, folder, query, sql[name]) if name in sql else "no SQL"
        except Exception as e:
            result = f"{type(e).__name__}: {str(e)[:700]}"
        failed += result is not None
        print(f"{name:32s} {time.time() - start:6.2f} {result or 'ok'}", flush=True)
    print("failed", failed)
