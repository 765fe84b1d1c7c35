"""Run queries on Spark and their SQL on DuckDB, and compare rows.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from tidemark.session import open_session

# Type names of the other engine, per Spark type.
_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in sorted(Path(sf_dir).glob("*.parquet")):
        files = f"{table}/*.parquet" if table.is_dir() else table
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{files}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """What differs between the two results, None if nothing does."""
    df = QUERIES[name](spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    if name not in ORACLE_SQL:
        return None if mine else "no rows"
    relation = con.sql(ORACLE_SQL[name])
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} and {sorted(relation.columns)}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    for column, spark_type in df.dtypes:
        if _TYPES.get(spark_type) != types[column]:
            return f"type of {column}: {spark_type} and {types[column]}"
    theirs = _rows(relation.columns, relation.fetchall())
    if mine != theirs:
        return (
            f"rows {sum(mine.values())} and {sum(theirs.values())}, "
            f"here only {list((mine - theirs).items())[:3]}, "
            f"there only {list((theirs - mine).items())[:3]}"
        )
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = open_session(
        "tidemark-compare",
        **{"spark__ui__enabled": "false", "spark__sql__shuffle__partitions": "8"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the others
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failures += found is not None
        kind = "exact" if name in ORACLE_SQL else "rows"
        print(f"{name:28} {time.perf_counter() - start:6.2f}s {kind:6} {found or 'ok'}", flush=True)
    print(f"{len(names or QUERIES)} queries, {failures} differ")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
