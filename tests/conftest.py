import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark import schemas  # noqa: E402
from tidemark.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = open_session(
        "tidemark-tests",
        spark__master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


NOON = datetime(2024, 1, 1, 12, 0)

_EVENT = {
    "event_id": "e1",
    "event_type": "post",
    "user_id": "u1",
    "username": "ann",
    "content": "text",
    "hashtags": ["Spark"],
    "likes": 10,
    "shares": 4,
    "comments": 2,
    "location": "Oslo",
    "device": "mobile",
    "timestamp": NOON,
    "ingested_at": NOON,
}


@pytest.fixture
def events(spark):
    """Bronze rows from dicts; what a dict leaves out is a valid post."""

    def build(*changes):
        rows = [{**_EVENT, "event_id": f"e{i}", **change} for i, change in enumerate(changes)]
        return spark.createDataFrame(
            [tuple(row[name] for name in schemas.BRONZE.names) for row in rows], schemas.BRONZE
        )

    return build


def values(df, *columns):
    """Rows as tuples, sorted as text so that NULLs sort too."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(row) for row in rows), key=str)
