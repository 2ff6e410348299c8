"""Order-insensitive comparison of result sets (rows, column names, values)."""

from __future__ import annotations

import hashlib
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    """DuckDB connection with one view per driver table."""
    import duckdb  # only here: digests are also computed where it is not installed

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool = False) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v if exact else round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, list | tuple):
        return "[" + ",".join(_norm(x, exact) for x in v) + "]"
    return repr(v)


def digest(rows, cols, exact: bool = False) -> str:
    """Order-insensitive hash of rows; columns sorted by name; floats to 6 digits unless ``exact``."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i], exact) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:16]


def same_result(spark_df, con, sql: str, exact: bool = False) -> tuple[bool, str]:
    """Compare a Spark frame with a DuckDB query; returns (equal, explanation).

    ``exact=True`` compares floats bit for bit instead of to 6 digits.
    """
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns {sorted(scols)} != {sorted(dcols)}"
    if len(srows) != len(drows):
        return False, f"rows {len(srows)} != {len(drows)}"
    if digest(srows, scols, exact) != digest(drows, dcols, exact):
        return False, "values differ"
    return True, f"{len(srows)} rows"
