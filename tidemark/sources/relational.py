"""Relational serving store over JDBC. The driver jar is the caller's to provide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.scratch import write_counted


def jdbc_options(
    properties: Mapping[str, str], connections: int, batch_rows: int
) -> dict[str, str]:
    """Writer options; what the caller gives wins."""
    return {
        "truncate": "true",
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
        **properties,
    }


class IncompleteTable(RuntimeError):
    """The store does not hold the rows that were sent."""


class ChangedColumns(RuntimeError):
    """The table in the store has other columns than the rows to be published."""


# How a loaded table takes the place of the one that is read.
BY_ROWS, BY_NAME = "rows", "name"


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    connections: int = 16,
    batch_rows: int = 10_000,
    attempts: int = 2,
) -> int:
    """Replace a table with the rows of `df`; return how many it holds then.

    The table is emptied and refilled rather than dropped, so that views on it
    stay; pass `truncate="false"` to replace its schema too. The store, not the
    cluster, limits the throughput: at most `connections` tasks write at a time,
    in batches.

    Tasks commit on their own. An executor lost between a task's commit and its
    report makes Spark send the task's rows again, so the store's own count is
    compared with the rows of `df`, and the table replaced anew if they differ.
    """
    options = jdbc_options(properties, connections, batch_rows)
    for _ in range(attempts):
        rows = write_counted(
            df, lambda counted: counted.write.jdbc(url, table, "overwrite", options)
        )
        held = _held_rows(df.sparkSession, url, table, properties)
        if held == rows:
            return rows
    raise IncompleteTable(f"{table} holds {held} rows, {rows} were sent")


def publish_staged(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    swap: str = BY_ROWS,
    connections: int = 16,
    batch_rows: int = 10_000,
    attempts: int = 2,
) -> int:
    """Replace a table in one transaction; return how many rows it holds then.

    The rows are loaded under a second name, where nobody reads them, and counted in the
    store; a load that is repeated in parts is done anew. Only then a transaction of the
    store puts them in place, so readers see the old rows or the new ones, and a run that
    dies at any step can be repeated.

    By `rows`, the table stays and its rows are exchanged: views on it, rights and
    indexes stay; its columns have to be the same. By `name`, the loaded table takes the
    name: columns may change, but dependents would go on with the old one, so a store
    refuses if there are any. The store has to put DDL under its transactions for that.
    """
    if swap not in (BY_ROWS, BY_NAME):
        raise ValueError(f"swap is {BY_ROWS} or {BY_NAME}")
    spark = df.sparkSession
    there = _columns(spark, url, table, properties)
    if swap == BY_ROWS and there is not None and there != df.columns:
        raise ChangedColumns(f"{table} has {', '.join(there)}; to send {', '.join(df.columns)}")
    staged = f"{table}{_STAGED}"
    # The staged table is made anew, so that what a dead run left does not stay.
    options = jdbc_options({**properties, "truncate": "false"}, connections, batch_rows)
    for _ in range(attempts):
        rows = write_counted(
            df, lambda counted: counted.write.jdbc(url, staged, "overwrite", options)
        )
        held = _held_rows(spark, url, staged, properties)
        if held == rows:
            break
    else:
        raise IncompleteTable(f"{staged} holds {held} rows, {rows} were sent")
    run_transaction(
        spark, url, properties, swap_statements(table, staged, df.columns, swap, there is not None)
    )
    return rows


_STAGED, _BEFORE = "__next", "__before"


def swap_statements(
    table: str, staged: str, columns: Sequence[str], swap: str, exists: bool
) -> list[str]:
    """What puts a loaded table in place of another, in order, in one transaction."""
    last_part = table.rsplit(".", 1)[-1]
    take_name = f"ALTER TABLE {staged} RENAME TO {last_part}"
    if not exists:
        return [take_name]
    if swap == BY_NAME:
        before = f"{table}{_BEFORE}"
        return [
            f"DROP TABLE IF EXISTS {before}",
            f"ALTER TABLE {table} RENAME TO {last_part}{_BEFORE}",
            take_name,
            f"DROP TABLE {before}",
        ]
    names = ", ".join('"' + name.replace('"', '""') + '"' for name in columns)
    return [
        f"DELETE FROM {table}",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staged}",
        f"DROP TABLE {staged}",
    ]


def run_transaction(
    spark: SparkSession, url: str, properties: Mapping[str, str], statements: Sequence[str]
) -> None:
    """Run statements in the store, all or none."""
    jvm = spark._jvm
    given = jvm.java.util.Properties()
    for key, value in properties.items():
        given.setProperty(key, value)
    if "driver" in properties:
        # As Spark's own source does it: also drivers of --jars are found.
        registry = jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry
        registry.register(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        try:
            statement = connection.createStatement()
            for text in statements:
                statement.execute(text)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
    finally:
        connection.close()


def _columns(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str]
) -> list[str] | None:
    """The columns of a table in the store, None if there is no such table."""
    try:
        return read_jdbc(spark, url, f"SELECT * FROM {table} WHERE 1 = 0", properties).columns
    except Exception as error:
        if _no_such_table(error):
            return None
        raise


# States of the SQL standard and of two stores for a table that is not there.
_MISSING_STATES = ("42P01", "42S02", "42Y07", "42X05")


def _no_such_table(error: Exception) -> bool:
    """Told by the SQL state, which the JDBC standard fixes, and not by the message."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        state = cause.getSQLState() if hasattr(cause, "getSQLState") else None
        if state in _MISSING_STATES:
            return True
        cause = cause.getCause()
    return False


def _held_rows(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str]
) -> int:
    count = read_jdbc(spark, url, f"SELECT COUNT(*) AS held FROM {table}", properties)
    return int(count.first()[0])


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str],
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Rows of a query that the store runs.

    `split` = (column, low, high, parts) reads a large result over several
    connections by ranges of a numeric column; rows outside low..high are in the
    first and last part, none is lost.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if split is None:
        return reader.option("query", query).load()
    column, low, high, parts = split
    return (
        reader.option("dbtable", f"({query}) split_source")
        .option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", parts)
        .load()
    )
