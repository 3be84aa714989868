"""Compare queries with their SQL counterparts: python -m workload.check [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from match_lake.session import build_session
from workload.oracles import ORACLES
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of plain values, columns by name."""
    def plain(value):
        if pd.isna(value):
            return "~null"
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, float):
            return repr(int(value)) if value.is_integer() else repr(value)
        return str(value)

    columns = sorted(df.columns)
    return sorted(zip(*[[plain(v) for v in df[c].astype(object)] for c in columns])) if len(df) else []


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """None if equal, else what differs."""
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = con.execute(ORACLES[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    left, right = normal(ours), normal(theirs)
    if left != right:
        first = next((a, b) for a, b in zip(left, right) if a != b)
        return f"values differ: {first}"
    kinds = {c: (str(ours[c].dtype), str(theirs[c].dtype)) for c in ours.columns}
    print(f"    {len(ours)} rows", {c: k for c, k in kinds.items() if k[0] != k[1]} or "")
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} agree")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
