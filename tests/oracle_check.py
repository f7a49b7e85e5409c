"""Run catalogue queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402,I001
import pandas as pd  # noqa: E402

STRICT = os.environ.get("ORACLE_STRICT") == "1"   # exact float equality (no tolerance)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


_FAMILY = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
           "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "float": "FLOAT",
           "smallint": "SMALLINT", "timestamp_ntz": "TIMESTAMP"}


def same_type(spark_t, duck_t):
    return _FAMILY.get(spark_t, spark_t).upper() == str(duck_t).upper()


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    sdf = build(spark, sf_dir)
    sp = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(sp), spark_s=round(t1 - t0, 2))
    dp = con.execute(sql).df()
    scols, srows = frame_rows(sp)
    dcols, drows = frame_rows(dp)
    res = dict(name=name, rows=len(sp), oracle_rows=len(dp), spark_s=round(t1 - t0, 2))
    if scols != dcols:
        res.update(ok=False, why=f"columns {scols} vs {dcols}")
        return res
    if len(srows) != len(drows):
        res.update(ok=False, why="row count")
        return res
    bad = [(a, b) for a, b in zip(srows, drows) if a != b]
    if bad:
        res.update(ok=False, why=f"{len(bad)} rows differ, e.g. {bad[0]}")
        return res
    sty = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    desc = con.execute(sql).description
    dty = {d[0]: str(d[1]) for d in desc}
    res.update(ok=True)
    odd = {c: (sty[c], dty.get(c)) for c in scols if not same_type(sty[c], dty.get(c))}
    if odd:
        res["types"] = odd
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 and "/" in sys.argv[1] else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if "/" not in a]
    from civica.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    failed = 0
    for n in names or list(qs):
        try:
            r = compare(spark, con, n, qs[n], sqls.get(n), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=n, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        if r.get("ok") is False:
            failed += 1
        print(r, flush=True)
    print(f"FAILED {failed} of {len(names or qs)}")


if __name__ == "__main__":
    main()
