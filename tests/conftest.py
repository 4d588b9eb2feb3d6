import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    warehouse = tmp_path_factory.mktemp("warehouse")
    SparkSession.builder.config("spark.sql.warehouse.dir", str(warehouse)).config(
        "spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    session = local_session(4, "tests", shuffle_partitions=2, driver_memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Frame from a schema string and rows; ISO dates may be given as text."""
    def build(schema: str, rows):
        types = [c.split()[-1] for c in schema.split(",")]
        typed = [tuple(dt.date.fromisoformat(v) if t == "date" and isinstance(v, str) else v
                       for v, t in zip(row, types)) for row in rows]
        return spark.createDataFrame(typed, schema)
    return build


@pytest.fixture(scope="session")
def rows():
    """Rows of chosen columns as sorted tuples, dates as text."""
    def collect(df, *cols):
        def plain(v):
            return v.isoformat() if isinstance(v, dt.date) else v
        out = [tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect()]
        return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
    return collect
