"""Compare catalogue queries with their SQL: `python tests/parity.py DIR [names]`."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{v + 0.0:.10g}"
    return str(v)


# Spark type -> DuckDB type.
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> str | None:
    """None where equal, else a description of the difference."""
    df = query(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        return "the plan holds a cross join"
    got = normalised(df.columns, df.collect())
    res = con.execute(sql)
    want = normalised([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    kinds = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    other = {c: (t, kinds[c]) for c, t in df.dtypes if TYPES.get(t) != kinds[c]}
    if other:
        return f"types differ: {other}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    diff = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(diff)} of {len(got[1])} rows differ, first {diff[0]}" if diff else None


def main() -> int:
    from storecast.plans.catalog import QUERIES
    from storecast.plans.oracles import ORACLES
    from storecast.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session(os.environ.get("PARITY_CPUS", "8"))
    spark.conf.set("spark.sql.shuffle.partitions", os.environ.get("PARITY_PARTITIONS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name])
            else:
                n = len(QUERIES[name](spark, sf_dir).collect())
                problem = None if n else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:300]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.2f}s "
              f"{problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
