"""Compare a Spark result with DuckDB SQL over the same files."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day).isoformat()
    if hasattr(v, "__float__") and not isinstance(v, str):
        f = float(v)
        return "nan" if math.isnan(f) else 0.0 if f == 0 else float(f"{f:.9g}")
    return str(v)


def differences(df, sql: str, sf_dir: str) -> list[str]:
    """What differs, empty if nothing does."""
    c = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    r = c.sql(sql)
    if sorted(r.columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} <> {sorted(r.columns)}"]
    cols = sorted(df.columns)
    own = Counter(tuple(plain(x[k]) for k in cols) for x in df.select(*cols).collect())
    at = [r.columns.index(k) for k in cols]
    ref = Counter(tuple(plain(x[k]) for k in at) for x in r.fetchall())
    out = []
    if own != ref:
        out.append(f"{sum(own.values())} rows <> {sum(ref.values())} rows; only here {list((own - ref).items())[:3]}; only SQL {list((ref - own).items())[:3]}")
    return out
