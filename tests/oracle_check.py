"""Run registered queries and their SQL side by side. Usage: oracle_check.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def compare(df, con, text: str) -> str | None:
    """None if both engines agree on column names and on the multiset of rows."""
    res = con.execute(text)
    names = [c[0] for c in res.description]
    want = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    pos = [names.index(c) for c in order]
    a = sorted((tuple(_plain(r[c]) for c in order) for r in df.collect()), key=repr)
    b = sorted((tuple(_plain(r[i]) for i in pos) for r in want), key=repr)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from rareclass.session import build_session

    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    sf, names = sys.argv[1], sys.argv[2:]
    con, sqls = connect(sf), oracle_sql()
    for name, fn in queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            got = compare(df, con, sqls[name]) if name in sqls else f"rows only: {len(df.collect())}"
        except Exception as exc:  # report and go on
            got = f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {'ok' if got is None else got}", flush=True)
