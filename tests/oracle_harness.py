"""Run a registered query in Spark and its oracle SQL in DuckDB; compare.

Comparison: column names (sorted), row count, and the multiset of rows
with doubles compared to 1e-6 (relative for large magnitudes).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not hasattr(v, "item")):
        return (2, tuple(_norm(x) for x in list(v)))
    if hasattr(v, "item"):
        v = v.item()
    if v is None or v is pd.NaT or v is pd.NA:
        return (0, "")
    if isinstance(v, bool):
        return (3, str(v))
    if isinstance(v, (int, float)):
        f = float(v)
        if math.isnan(f):
            return (0, "")
        return (1, f)
    return (3, str(v))


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in rec) for rec in pdf[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((k, round(x, 4) if k == 1 else x) for k, x in r).__repr__())


def _close(a, b) -> bool:
    if a == b:
        return True
    if a[0] == 1 and b[0] == 1:
        x, y = a[1], b[1]
        return abs(x - y) <= 2e-5 * max(1.0, abs(x), abs(y))
    if a[0] == 2 and b[0] == 2 and len(a[1]) == len(b[1]):
        return all(_close(p, q) for p, q in zip(a[1], b[1]))
    return False


_TYPE_MAP = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def spark_types(sdf) -> dict[str, str]:
    out = {}
    for f in sdf.schema.fields:
        s = f.dataType.simpleString()
        if s.startswith("array<"):
            inner = _TYPE_MAP.get(s[6:-1], s[6:-1].upper())
            out[f.name] = f"{inner}[]"
        else:
            out[f.name] = _TYPE_MAP.get(s, s.upper())
    return out


def compare_types(st: dict[str, str], dt: dict[str, str]) -> str | None:
    bad = {c: (st[c], dt.get(c)) for c in st if c in dt and st[c] != dt[c]}
    return f"types differ (spark, duck): {bad}" if bad else None


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str | None:
    sc, dc = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if sc != dc:
        return f"columns differ: spark-only {set(sc) - set(dc)}, duck-only {set(dc) - set(sc)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = _rows(spark_pdf), _rows(duck_pdf)
    for ra, rb in zip(a, b):
        if len(ra) != len(rb) or not all(_close(x, y) for x, y in zip(ra, rb)):
            diff = [(c, x, y) for c, x, y in zip(sc, ra, rb) if not _close(x, y)]
            return f"row differs: {diff[:6]}"
    return None


def check(spark, names=None, sf_dir="/root/testdata/sf0.01", verbose=True) -> dict[str, str]:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as exc:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}"
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = f"rows-only {len(spdf)}"
        else:
            try:
                rel = con.sql(sqls[name])
                dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
                dpdf = rel.df()
            except Exception as exc:  # noqa: BLE001
                results[name] = f"DUCK ERROR {str(exc)[:300]}"
                continue
            err = compare(spdf, dpdf) or compare_types(spark_types(sdf), dtypes)
            results[name] = "OK" if err is None else f"MISMATCH {err}"
        if verbose:
            print(f"{name:32s} {time.time() - t0:6.1f}s (spark {t1 - t0:5.1f}s) {results[name]}", flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from lapse.session import build_session

    sf = "/root/testdata/sf0.01"
    names = None
    args = sys.argv[1:]
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    if args:
        names = args
    spark = build_session("local[8]", shuffle_partitions=8)
    res = check(spark, names, sf)
    bad = {k: v for k, v in res.items() if not (v == "OK" or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("FAIL", k, v)
