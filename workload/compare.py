"""Run queries in Spark and DuckDB and compare the rows exactly."""

import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from workload.oracles import ORACLES
from workload.queries import REGISTRY


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str:
    """Empty if both engines agree, else what differs first."""
    df = REGISTRY[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    answer = con.sql(ORACLES[name])
    if sorted(df.columns) != sorted(answer.columns):
        return f"columns {sorted(df.columns)} against {sorted(answer.columns)}"
    theirs = rows_of(answer.columns, answer.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if repr(a) != repr(b):
            return f"{a} against {b}"
    return "" if mine else "no rows"


def main() -> None:
    import sys

    from gatetally.session import local_session

    sf_dir = sys.argv[1]
    spark, con = local_session(), duck(sf_dir)
    for name in sys.argv[2:] or list(REGISTRY):
        start = time.time()
        try:
            found = difference(spark, con, name, sf_dir) if name in ORACLES else "no SQL"
        except Exception as problem:  # report and go on with the next query
            found = f"{type(problem).__name__}: {str(problem)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
