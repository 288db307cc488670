"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
row count, column names and the multiset of row values (columns sorted by
name, the way the driver compares them)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if v is None:
        return None
    return str(v)


def spark_family(t) -> str:
    name = t.simpleString()
    if name in ("tinyint", "smallint", "int", "bigint"):
        return "integer"
    if name in ("float", "double") or name.startswith("decimal"):
        return "number"
    if name.startswith("timestamp"):
        return "timestamp"
    return name.split("<")[0].split("(")[0]


def duck_family(t) -> str:
    name = str(t).upper()
    if name in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "integer"
    if name in ("FLOAT", "DOUBLE") or name.startswith("DECIMAL"):
        return "number"
    if name.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}.get(name, name.lower())


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def compare(spark, spec, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = spec.run(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.sql(spec.sql)
    d_cols = res.columns
    s_types = {f.name: spark_family(f.dataType) for f in sdf.schema.fields}
    d_types = {c: duck_family(t) for c, t in zip(res.columns, res.types)}
    d_rows = res.fetchall()
    out = {
        "key": spec.name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols), "spark_sec": round(t1 - t0, 2),
    }
    if out["cols_match"]:
        out["types_match"] = s_types == d_types
        if not out["types_match"]:
            out["type_diff"] = {c: (s_types[c], d_types[c]) for c in s_types if s_types[c] != d_types.get(c)}
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            sa, sb = set(a), set(b)
            out["only_spark"] = list(sa - sb)[:3]
            out["only_oracle"] = list(sb - sa)[:3]
    else:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        out["values_match"] = False
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tidewater import build_session
    from tidewater.plans.catalog import REGISTRY

    sf_dir = "/root/testdata/sf0.01"
    keys = sys.argv[1:] or [k for k, v in REGISTRY.items() if v.sql]
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        spec = REGISTRY[k]
        if not spec.sql:
            df = spec.run(spark, sf_dir)
            print({"key": k, "rows_only": df.count()})
            continue
        try:
            r = compare(spark, spec, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:800]}
        bad += not (r.get("values_match") and r.get("types_match"))
        print(r, flush=True)
    print("mismatches:", bad)
