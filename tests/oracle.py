"""Runs a registered query and its SQL side by side and compares values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else format(v, ".12g")
    if isinstance(v, decimal.Decimal):
        return format(float(v), ".12g") if v != v.to_integral_value() else str(int(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


KIND = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "hugeint": "int",
    "string": "text", "varchar": "text", "double": "float", "float": "float", "boolean": "bool",
    "timestamp": "ts", "timestamp with time zone": "ts", "date": "date",
}


def kind(t: str) -> str:
    t = t.lower()
    return "decimal" if t.startswith("decimal") else KIND.get(t, t)


def compare(spark_df, con, sql: str) -> str | None:
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    types = {c[0]: kind(str(c[1])) for c in rel.description}
    want = rel.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    mine = {c: kind(t) for c, t in spark_df.dtypes}
    diff = {c: (mine[c], types[c]) for c in names if mine[c] != types[c]}
    if diff:
        return f"types spark/duckdb {diff}"
    order = sorted(names)
    idx = [names.index(c) for c in order]
    a = sorted(tuple(norm(r[c]) for c in order) for r in spark_df.collect())
    b = sorted(tuple(norm(r[i]) for i in idx) for r in want)
    if a != b:
        sa, sb = set(a), set(b)
        return f"{order}: rows {len(a)}/{len(b)} only spark {sorted(sa - sb)[:3]} only sql {sorted(sb - sa)[:3]}"
    return None if a else "EMPTY"


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from changeflow.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("oracle", 8)
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if argv and not any(a in name for a in argv):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                n = len(df.collect())
                problem = None if n else "EMPTY"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        tag = "ok " if problem is None else "BAD"
        bad += problem is not None
        print(f"{tag} {name} {'' if name in oracles else '(no sql)'} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
