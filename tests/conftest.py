import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from pricemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, app="tests", driver_memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    shared = str(tmp_path_factory.mktemp("shared"))
    session.conf.set("spark.pricemill.workDir", shared)
    session.sparkContext.setCheckpointDir(shared)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def day():
    return dt.date.fromisoformat


@pytest.fixture(scope="session")
def make(spark):
    """Frame from rows and a DDL schema; dates and times may be given as text."""

    def build(rows, schema):
        fields = [f.strip().rsplit(" ", 1) for f in schema.split(", ")]
        as_text = ", ".join(f"{n} {'string' if t in ('date', 'timestamp_ntz') else t}" for n, t in fields)
        df = spark.createDataFrame([tuple(map(_plain, r)) for r in rows], as_text)
        return df.select(*[df[n].cast(t).alias(n) for n, t in fields])

    def _plain(v):
        return v.isoformat() if isinstance(v, dt.date) else v

    return build


@pytest.fixture(scope="session")
def rows():
    """Collected rows as sorted tuples, dates as text."""

    def collect(df, *columns, sort=True):
        picked = df.select(*columns) if columns else df
        found = [tuple(v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v for v in r) for r in picked.collect()]
        return sorted(found, key=repr) if sort else found

    return collect
