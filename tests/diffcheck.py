"""Differential check: every ``queries()`` entry vs its DuckDB ``oracle_sql()``.

Mirrors the driver's check: row count, column names, and an order-insensitive
comparison of all values. Run as a script:

    python tests/diffcheck.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


_TYPES = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
          "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "FloatType()": "FLOAT"}


def type_differences(sdf, rel) -> dict:
    s = {f.name: _TYPES.get(str(f.dataType), str(f.dataType)) for f in sdf.schema.fields}
    d = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark, key: str, sf_dir: str, con) -> tuple[bool, str]:
    import __spark_entry__ as E
    sdf = E.queries()[key](spark, sf_dir)
    s_pdf = sdf.toPandas()
    oracle = E.oracle_sql().get(key)
    if oracle is None:
        return True, f"{len(s_pdf)} rows (no oracle)"
    rel = con.sql(oracle)
    types = type_differences(sdf, rel)
    if types:
        return False, f"column types differ (spark, duckdb): {types}"
    o_pdf = rel.df()
    s_cols, o_cols = sorted(s_pdf.columns), sorted(o_pdf.columns)
    if s_cols != o_cols:
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    if len(s_pdf) != len(o_pdf):
        return False, f"row count spark={len(s_pdf)} oracle={len(o_pdf)}"
    a = _rows(s_pdf.to_dict("records"), s_cols)
    b = _rows(o_pdf.to_dict("records"), s_cols)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({len(s_pdf)} rows), cols={s_cols}, e.g. {bad}"
    return True, f"{len(s_pdf)} rows"


def main(argv):
    from pitchlake.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    import __spark_entry__ as E
    con = duck(sf_dir)
    keys = keys or list(E.queries())
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            ok, msg = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:32s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
