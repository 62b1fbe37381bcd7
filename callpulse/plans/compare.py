"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows once columns are sorted by name and doubles rounded.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame

from callpulse.sources.tables import DRIVER_TABLES


def duckdb_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if hasattr(v, "isoformat"):
        s = v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
        return s
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


@dataclass
class Outcome:
    name: str
    ok: bool
    spark_rows: int
    oracle_rows: int
    detail: str = ""


def compare(name: str, sdf: DataFrame, con, sql: str) -> Outcome:
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    rel = con.sql(sql)
    o_cols_raw = rel.columns
    o_cols = sorted(o_cols_raw)
    idx = [o_cols_raw.index(c) for c in o_cols]
    o_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if s_cols != o_cols:
        return Outcome(name, False, len(s_rows), len(o_rows), f"columns differ: {s_cols} vs {o_cols}")
    if len(s_rows) != len(o_rows):
        return Outcome(name, False, len(s_rows), len(o_rows), "row counts differ")
    cs, co = Counter(s_rows), Counter(o_rows)
    if cs != co:
        only_s = list((cs - co).elements())[:3]
        only_o = list((co - cs).elements())[:3]
        return Outcome(name, False, len(s_rows), len(o_rows), f"cols={s_cols}\nspark-only={only_s}\noracle-only={only_o}")
    return Outcome(name, True, len(s_rows), len(o_rows))
