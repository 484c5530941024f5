"""Compare every named query with its SQL twin: names, types, rows, values.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_numeric_dtype(frame[c]):
            frame[c] = frame[c].astype("float64") + 0.0
        else:
            frame[c] = frame[c].astype(object).where(frame[c].notna(), None)
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> list[str]:
    found = []
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        odd = set(spark_frame.columns) ^ set(sql_frame.columns)
        return [f"columns {sorted(odd)}"]
    if len(spark_frame) != len(sql_frame):
        return [f"rows {len(spark_frame)} and {len(sql_frame)}"]
    for c in spark_frame.columns:
        if spark_frame[c].dtype != sql_frame[c].dtype and len(spark_frame):
            found.append(f"type of {c}: {spark_frame[c].dtype} and {sql_frame[c].dtype}")
    a, b = normal(spark_frame), normal(sql_frame)
    for c in a.columns:
        bad = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna()))
        if bad.any():
            i = bad.idxmax()
            found.append(f"{int(bad.sum())} values of {c}, first {a[c][i]!r} and {b[c][i]!r}")
    return found


def main(arguments: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from residualkit.session import local_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(queries())
    spark = local_session("compare", 4)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name in chosen:
        start = time.time()
        try:
            result = queries()[name](spark, sf_dir).toPandas()
            seconds = time.time() - start
            start = time.time()
            notes = differences(result, connection.execute(sql[name]).df()) if name in sql else ["no sql"]
            print(f"{name:26} {len(result):7} rows {seconds:6.2f}s sql {time.time() - start:6.2f}s {'; '.join(notes) or 'ok'}", flush=True)
            bad += bool(notes) and name in sql
        except Exception as error:
            bad += 1
            print(f"{name:26} FAILED {type(error).__name__}: {str(error)[:600]}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
