"""Run registered queries next to their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import os
import sys
import time
import warnings

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    for column in frame.columns:
        frame[column] = [
            None if v is None else format(float(v), ".6f") if isinstance(v, float) else str(v) for v in frame[column]
        ]
    return frame.sort_values(list(frame.columns), na_position="first", ignore_index=True)


def rows_of(frame) -> pd.DataFrame:
    """A DataFrame's rows without the widening pandas does to columns with nulls."""
    table = frame.toArrow() if hasattr(frame, "toArrow") else frame
    return pd.DataFrame({c: pd.Series(table.column(c).to_pylist(), dtype=object) for c in table.column_names})


def differences(expected: pd.DataFrame, got: pd.DataFrame) -> str | None:
    if sorted(expected.columns) != sorted(got.columns):
        return f"columns {sorted(expected.columns)} != {sorted(got.columns)}"
    a, b = normal(expected), normal(got)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    unequal = (a != b) & ~(a.isna() & b.isna())
    if unequal.any().any():
        at = unequal.any(axis=1).idxmax()
        return f"{int(unequal.any(axis=1).sum())} rows differ, first:\n{a.loc[at].to_dict()}\n{b.loc[at].to_dict()}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry

    from quarry.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    warnings.simplefilter("ignore")
    wanted = sys.argv[2:] or list(entry.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    duck, statements = connect(sf), entry.oracle_sql()
    failed = 0
    for name in wanted:
        try:
            start = time.time()
            answer = entry.queries()[name](spark, sf).toArrow()
            got = rows_of(answer)
            spark_seconds = time.time() - start
            start = time.time()
            table = duck.execute(statements[name]).to_arrow_table() if name in statements else None
            expected = None if table is None else rows_of(table)
            if table is not None:
                types = {f.name: str(f.type) for f in table.schema}
                unlike = {f.name: (str(f.type), types.get(f.name)) for f in answer.schema if types.get(f.name) != str(f.type)}
                if unlike:
                    print("     types:", unlike)
            difference = "no SQL" if expected is None else differences(expected, got)
        except Exception as error:  # the next query is to run all the same
            difference, got, spark_seconds = f"{type(error).__name__}: {str(error)[:600]}", [], 0.0
        failed += difference is not None
        seconds = time.time() - start
        print(f"{'ok  ' if difference is None else 'FAIL'} {name:26s} rows={len(got):7d} spark={spark_seconds:6.2f} duck={seconds:6.2f} {difference or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} equal")
