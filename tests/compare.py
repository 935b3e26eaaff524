"""Run registered queries and compare them with their SQL in DuckDB.

    python tests/compare.py [sf] [name-substring ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "\0null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sf_dir):
    """None when equal or without SQL, else a short description."""
    df = query.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if query.sql is None:
        return None if got else "no rows"
    cur = con.execute(query.sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if not b:
        return "no rows expected: the query proves nothing"
    if a == b:
        return None
    extra = sorted(set(a) - set(b))[:2]
    missing = sorted(set(b) - set(a))[:2]
    return f"{len(a)} rows vs {len(b)}\n  only spark: {extra}\n  only sql:   {missing}"[:1500]


def session(cpus: int = 8):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-compare")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-tests-"))
             .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    sys.path.insert(0, str(ROOT))
    from tidemark.plans.catalog import QUERIES
    sf = argv[0] if argv else "0.01"
    wanted = argv[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, bad = session(), duck(sf_dir), 0
    for name, q in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            problem = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {time.time() - t:6.2f}s {name}" + (f": {problem}" if problem else ""),
              flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
