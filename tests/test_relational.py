"""No database may be started here: the store, its reader and its connection are stood in for."""

from types import SimpleNamespace

import pytest

from tidemark.sources import relational
from tidemark.sources.relational import (
    BY_NAME,
    ChangedColumns,
    IncompleteTable,
    publish_staged,
    read_jdbc,
    run_transaction,
    swap_statements,
)

URL = "jdbc:store://h/db"


class Reader:
    """A JDBC reader that notes what it is asked."""

    def __init__(self):
        self.asked = {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, key, value):
        assert key not in self.asked
        self.asked[key] = value
        return self

    def options(self, **given):
        self.asked |= given
        return self

    def load(self):
        return self.asked


def test_options_of_a_plain_read():
    session = SimpleNamespace(read=Reader())
    assert read_jdbc(session, URL, "SELECT 1", {"user": "u"}) == {
        "url": URL, "user": "u", "query": "SELECT 1",
    }


def test_options_of_a_split_read():
    """A split read takes the query as a table, as the source does not allow both."""
    session = SimpleNamespace(read=Reader())
    asked = read_jdbc(session, URL, "SELECT * FROM t", {"fetchsize": "9"}, ("id", 5, 105, 4))
    assert asked == {
        "url": URL, "fetchsize": "9", "dbtable": "(SELECT * FROM t) split_source",
        "partitionColumn": "id", "lowerBound": 5, "upperBound": 105, "numPartitions": 4,
    }


class Store:
    """Tables as lists of rows, and everything that was done, in order."""

    def __init__(self, monkeypatch, spark, tables=None, repeats=0):
        self.tables, self.done, self.repeats = dict(tables or {}), [], repeats
        self.fails_at = None
        monkeypatch.setattr(relational, "_columns", self.columns)
        monkeypatch.setattr(relational, "_held_rows", self.held)
        monkeypatch.setattr(relational, "write_counted", self.write)
        monkeypatch.setattr(relational, "run_transaction", self.transaction)

    def columns(self, spark, url, table, properties):
        assert url == URL
        return ["id"] if table in self.tables else None

    def write(self, df, write):
        store = self

        class Writer:
            def jdbc(self, url, table, mode, options):
                store.done.append((table, mode, dict(options)))
                store.tables[table] = df.count() + (7 if store.repeats else 0)

        write(SimpleNamespace(write=Writer()))
        self.repeats -= bool(self.repeats)
        return df.count()

    def held(self, spark, url, table, properties):
        self.done.append(("count", table))
        return self.tables[table]

    def transaction(self, spark, url, properties, statements):
        self.done.append(tuple(statements))
        after = dict(self.tables)
        for number, text in enumerate(statements):
            if number == self.fails_at:
                raise ConnectionError("lost")
            words = text.split()
            if words[0] == "DELETE":
                after[words[2]] = 0
            elif words[0] == "INSERT":
                after[words[2]] += after[words[-1]]
            elif words[:2] == ["DROP", "TABLE"]:
                after.pop(words[-1], None)
            elif words[0] == "ALTER":
                after[words[-1]] = after.pop(words[2])
        self.tables = after


OPTIONS = {"truncate": "false", "numPartitions": "16", "batchsize": "10000", "user": "u"}


def test_rows_are_loaded_counted_and_then_exchanged(spark, monkeypatch):
    store = Store(monkeypatch, spark, {"t": 3})
    assert publish_staged(spark.range(5), URL, "t", {"user": "u"}) == 5
    assert store.done == [
        ("t__next", "overwrite", OPTIONS),
        ("count", "t__next"),
        (
            "DELETE FROM t",
            'INSERT INTO t ("id") SELECT "id" FROM t__next',
            "DROP TABLE t__next",
        ),
    ]
    assert store.tables == {"t": 5}


def test_the_first_load_takes_the_name(spark, monkeypatch):
    store = Store(monkeypatch, spark)
    assert publish_staged(spark.range(2), URL, "s.t", {}) == 2
    assert store.done[-1] == ("ALTER TABLE s.t__next RENAME TO t",)


def test_a_load_that_was_repeated_in_parts_is_done_anew(spark, monkeypatch):
    store = Store(monkeypatch, spark, {"t": 1}, repeats=1)
    assert publish_staged(spark.range(4), URL, "t", {}) == 4
    assert [d[0] for d in store.done[:4]] == ["t__next", "count", "t__next", "count"]
    assert store.tables == {"t": 4}


def test_a_load_that_stays_wrong_changes_nothing(spark, monkeypatch):
    store = Store(monkeypatch, spark, {"t": 1}, repeats=5)
    with pytest.raises(IncompleteTable, match="t__next holds 11 rows, 4 were sent"):
        publish_staged(spark.range(4), URL, "t", {})
    assert store.tables["t"] == 1


@pytest.mark.parametrize("swap, steps", [("rows", 3), ("name", 4)])
def test_a_run_that_dies_can_be_repeated(spark, monkeypatch, swap, steps):
    """At every statement: readers keep the old rows, and the next run puts all right."""
    store = Store(monkeypatch, spark, {"t": 9})
    for step in range(steps):
        store.fails_at, old = step, store.tables["t"]
        with pytest.raises(ConnectionError):
            publish_staged(spark.range(3 + step), URL, "t", {}, swap)
        assert store.tables["t"] == old and store.tables["t__next"] == 3 + step
        store.fails_at = None
        assert publish_staged(spark.range(3 + step), URL, "t", {}, swap) == 3 + step
        assert store.tables == {"t": 3 + step}
        assert publish_staged(spark.range(3 + step), URL, "t", {}, swap) == 3 + step


def test_changed_columns(spark, monkeypatch):
    store = Store(monkeypatch, spark, {"t": 1})
    changed = spark.range(2).selectExpr("id", "id AS more")
    with pytest.raises(ChangedColumns, match="t has id; to send id, more"):
        publish_staged(changed, URL, "t", {})
    assert store.done == []
    assert publish_staged(changed, URL, "t", {}, BY_NAME) == 2
    assert store.done[-1] == (
        "DROP TABLE IF EXISTS t__before",
        "ALTER TABLE t RENAME TO t__before",
        "ALTER TABLE t__next RENAME TO t",
        "DROP TABLE t__before",
    )
    with pytest.raises(ValueError, match="swap is"):
        publish_staged(changed, URL, "t", {}, "other")


def test_names_are_quoted():
    statements = swap_statements("t", "t__next", ['a"b', "select"], "rows", True)
    assert statements[1] == 'INSERT INTO t ("a""b", "select") SELECT "a""b", "select" FROM t__next'


class Connection:
    def __init__(self, fails=None):
        self.done, self.fails = [], fails

    def __getattr__(self, name):
        def call(*given):
            self.done.append((name, *given))
            if given and given[0] == self.fails:
                raise ConnectionError(self.fails)
            return self

        return call


def session(connection):
    given = {}
    properties = SimpleNamespace(setProperty=given.__setitem__)
    sql = SimpleNamespace(DriverManager=SimpleNamespace(getConnection=lambda url, p: connection))
    java = SimpleNamespace(util=SimpleNamespace(Properties=lambda: properties), sql=sql)
    return SimpleNamespace(_jvm=SimpleNamespace(java=java)), given


def test_all_statements_or_none():
    connection = Connection()
    spark, given = session(connection)
    run_transaction(spark, URL, {"user": "u"}, ["A", "B"])
    assert given == {"user": "u"}
    assert connection.done == [
        ("setAutoCommit", False), ("createStatement",), ("execute", "A"), ("execute", "B"),
        ("commit",), ("close",),
    ]
    connection = Connection("B")
    with pytest.raises(ConnectionError):
        run_transaction(session(connection)[0], URL, {}, ["A", "B", "C"])
    assert [step[0] for step in connection.done[-3:]] == ["execute", "rollback", "close"]


@pytest.mark.parametrize("state, missing", [("42P01", True), ("08001", False), (None, False)])
def test_a_missing_table_is_told_by_its_state(monkeypatch, state, missing):
    inner = SimpleNamespace(getSQLState=lambda: state, getCause=lambda: None)
    error = RuntimeError("x")
    error.java_exception = SimpleNamespace(getCause=lambda: inner)

    def fail(*_):
        raise error

    monkeypatch.setattr(relational, "read_jdbc", fail)
    if missing:
        assert relational._columns(None, URL, "t", {}) is None
    else:
        with pytest.raises(RuntimeError):
            relational._columns(None, URL, "t", {})
