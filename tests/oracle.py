"""Run registered queries against their SQL on the same parquet files."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v + 0.0:.6f}".replace("-0.000000", "0.000000")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got = table(df.columns, df.collect())
    cur = con.execute(sql)
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(g, w) for g, w in zip(*[got[1], want[1]]) if g != w]
    if bad:
        return f"{len(bad)} of {len(want[1])} rows differ, first {bad[0]}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    duck = {d[0]: str(d[1]).lower() for d in cur.description}
    same = {"long": "bigint", "string": "varchar", "timestamp_ntz": "timestamp", "int": "integer"}
    off = {c: (k, duck[c]) for c, k in kinds.items() if same.get(k, k) != duck[c]}
    return f"ok types {off}" if off else "ok"


def main(sf, names):
    import __spark_entry__ as entry
    from fadecast.session import local_session

    spark = local_session()
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        t = time.time()
        try:
            if name in oracles:
                res = compare(spark, con, queries[name], oracles[name], sf_dir)
            else:
                rows = queries[name](spark, sf_dir).collect()
                res = f"rows {len(rows)} {rows[:1]}"
        except Exception as e:
            res = "ERROR " + str(e)[:600]
        print(f"{name:32s} {time.time() - t:6.2f}s {res}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
