"""Run registered queries against their SQL in DuckDB: `python -m tests.oracle [sf_dir] [name-prefix ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def _table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


FAMILIES = [
    {"tinyint", "smallint", "int", "bigint", "INTEGER", "BIGINT"},
    {"double", "float", "DOUBLE", "FLOAT"},
    {"string", "VARCHAR"},
    {"boolean", "BOOLEAN"},
]


def _family(t: str) -> int:
    return next((i for i, f in enumerate(FAMILIES) if t in f), -1)


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    cols, got = _table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows-only ({len(got)} rows)" if got else "EMPTY"
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    kinds = dict(df.dtypes)
    bad_types = {c: (kinds[c], types.get(c)) for c in df.columns if _family(kinds[c]) != _family(types.get(c, ""))}
    want_cols, want = _table([d[0] for d in cur.description], cur.fetchall())
    if cols != want_cols:
        return f"COLUMNS {cols} vs {want_cols}"
    if bad_types:
        return f"TYPES {bad_types}"
    if len(got) != len(want):
        return f"ROWS {len(got)} vs {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            n = sum(1 for a, b in zip(got, want) if a != b)
            return f"VALUES ({n} of {len(got)}) {str(g)[:300]} vs {str(w)[:300]}"
    return f"ok ({len(got)} rows)" if got else "ok but EMPTY"


def main(argv):
    import __spark_entry__ as entry
    from larkspur.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = argv[1:]
    spark = get_session("oracle", master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            res = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:  # report and go on
            res = "ERROR " + " ".join(str(e).split())[:600]
        spark.catalog.clearCache()
        if not res.startswith(("ok", "rows-only")) or "EMPTY" in res:
            bad.append(name)
        print(f"{time.time() - t:6.2f}s {name}: {res}", flush=True)
    print("bad:", bad, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
