"""Run registered Spark queries and their oracle SQL side by side and compare results.

Mirrors the driver's check: same column names (compared sorted), same row count, same multiset of
rows (order-insensitive), plus a column type check. Usable from pytest and as a script::

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakesmith.sources.tables import DRIVER_TABLES  # noqa: E402

SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return ("dec", format(v.normalize(), "f") if v != 0 else "0")
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        return ("f", repr(round(v, 9)))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(canon(x) for x in v))
    return ("s", str(v))


def spark_types(df) -> dict[str, str]:
    out = {}
    for f in df.schema.fields:
        s = f.dataType.simpleString()
        if s.startswith("decimal"):
            out[f.name] = s.upper()
        else:
            out[f.name] = SPARK_TO_DUCK.get(s, s.upper())
    return out


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    res = {"name": name}
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res["spark_sec"] = round(time.time() - t0, 2)
    res["rows"] = len(s_rows)
    if sql is None:
        res["status"] = "no-oracle"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    st = spark_types(df)
    type_diff = {c: (st[c], d_types[c]) for c in s_cols if st[c] != d_types[c]}
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(canon(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(canon(r[i]) for i in di) for r in d_rows)
    if sc == dc:
        res["status"] = "OK" if not type_diff else f"OK-VALUES TYPES {type_diff}"
    else:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res["status"] = f"VALUES differ ({len(s_rows)} vs {len(d_rows)}); spark-only {only_s}; oracle-only {only_d}"
        if type_diff:
            res["status"] += f" TYPES {type_diff}"
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from lakesmith.session import local_session

    spark = local_session()
    q = E.queries()
    o = E.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name in names or sorted(q):
        try:
            r = compare(spark, con, name, q[name], o.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        ok = str(r["status"]).startswith("OK") or r["status"] == "no-oracle"
        bad += 0 if ok else 1
        print(f"{'  ' if ok else '!!'} {name:34s} {r.get('rows', '-')!s:>7} {r.get('spark_sec', '-')!s:>6}s  {r['status']}",
              flush=True)
    missing = sorted(set(q) - set(o))
    print("queries without oracle:", missing)
    print("oracle without query:", sorted(set(o) - set(q)))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
