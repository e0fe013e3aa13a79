"""Run catalogue queries in Spark and their SQL oracles in DuckDB; compare as multisets.

    python -m tests.oracle_check [--sf /root/testdata/sf0.01] [key ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, int):
        return v
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


SPARK_CANON = {"IntegerType": "int", "LongType": "bigint", "DoubleType": "double", "StringType": "string",
               "BooleanType": "boolean", "ShortType": "smallint", "ByteType": "tinyint", "FloatType": "float"}
DUCK_CANON = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
              "SMALLINT": "smallint", "TINYINT": "tinyint", "FLOAT": "float", "HUGEINT": "hugeint"}


def type_mismatches(sdf, res):
    """Columns whose Spark and DuckDB types differ (after mapping both to one vocabulary)."""
    s_types = {f.name: SPARK_CANON.get(type(f.dataType).__name__, str(f.dataType)) for f in sdf.schema.fields}
    d_types = {d[0]: DUCK_CANON.get(str(d[1]), str(d[1])) for d in res.description}
    return {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    types = type_mismatches(sdf, res)
    if types:
        problems.append(f"types differ: {types}")
    if len(sr) != len(dr):
        problems.append(f"rows differ: spark={len(sr)} duck={len(dr)}")
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return problems, len(sr), t1 - t0, t2 - t1


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from basketflow.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(a.sf)
    keys = a.keys or list(qs)
    failed = 0
    for k in keys:
        if k not in sqls:
            print(f"{k:28s} (no oracle)")
            continue
        try:
            problems, n, ts, td = compare(spark, con, k, qs[k], sqls[k], a.sf)
        except Exception as e:  # report and continue
            problems, n, ts, td = [f"error: {type(e).__name__}: {str(e)[:400]}"], -1, 0, 0
        failed += bool(problems)
        print(f"{k:28s} {'OK ' if not problems else 'BAD'} rows={n:<7d} spark={ts:5.1f}s duck={td:5.1f}s "
              + ("; ".join(problems) if problems else ""), flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
