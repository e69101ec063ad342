"""Spark-vs-DuckDB comparison used by the tests and tools/check_oracle.py.

Rows are compared as multisets after normalising values (floats to 9
significant digits, timestamps/dates to ISO text, arrays/structs to
tuples), with columns sorted by name - the same contract the driver uses.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0:
            return 0.0
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in v.items())
    if hasattr(v, "asDict"):
        return tuple((k, norm(x)) for k, x in v.asDict().items())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def _struct_vals(v):
    # structs compare by values only (DuckDB/Spark field naming can differ)
    if isinstance(v, tuple) and v and all(isinstance(x, tuple) and len(x) == 2 and isinstance(x[0], str) for x in v):
        return tuple(_struct_vals(x[1]) for x in v)
    if isinstance(v, tuple):
        return tuple(_struct_vals(x) for x in v)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_struct_vals(norm(r[c])) for c in cols) for r in df.select(*cols).collect()]
    return cols, rows


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_struct_vals(norm(r[i])) for i in order) for r in data]
    return cols, rows


def compare(df, con, sql, show: int = 3) -> tuple[bool, str]:
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return False, f"columns differ: spark-only={sorted(set(sc) - set(dc))} duck-only={sorted(set(dc) - set(sc))}"
    if len(sr) != len(dr):
        msg = f"row count {len(sr)} vs {len(dr)}"
    else:
        msg = ""
    cs, cd = Counter(sr), Counter(dr)
    if cs == cd:
        return True, f"{len(sr)} rows"
    only_s = list((cs - cd).elements())[:show]
    only_d = list((cd - cs).elements())[:show]
    diffcols = set()
    for a, b in zip(sorted(only_s, key=repr), sorted(only_d, key=repr)):
        for i, (x, y) in enumerate(zip(a, b)):
            if x != y:
                diffcols.add(sc[i])
    return False, (f"{msg} values differ ({sum((cs - cd).values())} rows); cols={sorted(diffcols)[:10]}\n"
                   f"  spark: {only_s[:2]}\n  duck : {only_d[:2]}")


def _spark_family(dt) -> str:
    from pyspark.sql import types as T
    m = {T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32", T.LongType: "int64",
         T.FloatType: "float32", T.DoubleType: "float64", T.StringType: "string", T.BooleanType: "bool",
         T.DateType: "date", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamptz",
         T.DecimalType: "decimal", T.ArrayType: "list", T.StructType: "struct", T.MapType: "map"}
    for k, v in m.items():
        if isinstance(dt, k):
            return v
    return type(dt).__name__


def _duck_family(t: str) -> str:
    t = t.upper()
    if t.endswith("[]"):
        return "list"
    if t.startswith("STRUCT"):
        return "struct"
    if t.startswith("DECIMAL"):
        return "decimal"
    return {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64", "HUGEINT": "int128",
            "FLOAT": "float32", "DOUBLE": "float64", "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date",
            "TIMESTAMP": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamptz", "UBIGINT": "uint64",
            "INTEGER[]": "list"}.get(t, t)


def type_diffs(df, con, sql) -> list[str]:
    """Columns whose type family differs between the Spark result and the oracle."""
    sp = {f.name: _spark_family(f.dataType) for f in df.schema.fields}
    rel = con.sql(sql)
    dk = {n: _duck_family(str(t)) for n, t in zip(rel.columns, rel.types)}
    return [f"{c}: spark {sp[c]} vs duck {dk[c]}" for c in sorted(sp) if c in dk and sp[c] != dk[c]]
