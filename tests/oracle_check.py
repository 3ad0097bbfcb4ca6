"""Differential check of registered jobs against their DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name), as the driver's correctness gate does.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return hashlib.sha256(repr(normed).encode()).hexdigest()[:16], [cols[i] for i in order]


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diffs(scols, stypes, dcols, dtypes):
    d = dict(zip(dcols, dtypes))
    out = []
    for c, t in zip(scols, stypes):
        want = SPARK_TO_DUCK.get(t, t.upper())
        if c in d and d[c] != want:
            out.append(f"{c}: spark {t} duck {d[c]}")
    return out


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:400])
            if verbose:
                print(f"{name:24s} SPARK-ERROR {str(e)[:400]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("ROWS-ONLY", len(srows))
            if verbose:
                print(f"{name:24s} rows-only {len(srows)} rows  {ts:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            drows = rel.fetchall()
            dcols = rel.columns
            dtypes = [str(t) for t in rel.types]
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK-ERROR", str(e)[:400])
            if verbose:
                print(f"{name:24s} DUCK-ERROR {str(e)[:400]}")
            continue
        sh, sc = digest(scols, srows)
        dh, dc = digest(dcols, drows)
        ok = (len(srows) == len(drows)) and sc == dc and sh == dh
        tdiff = type_diffs(scols, stypes, dcols, dtypes)
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows), tdiff)
        if verbose and tdiff:
            print(f"{name:24s} TYPES {tdiff}")
        if verbose:
            print(f"{name:24s} {'OK' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} "
                  f"{ts:.1f}s" + ("" if sc == dc else f" cols {sc} vs {dc}")
                  + ("" if ok else f"\n   spark types {list(zip(scols, stypes))}\n   duck types {list(zip(dcols, dtypes))}"))
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "ROWS-ONLY")]
    print("BAD:", bad)
