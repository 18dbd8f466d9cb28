import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfline.session import SLICE_CHECK_BYTES, SLICE_ROWS, build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "shelfline-tests",
        "local[8]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="shelfline-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def sliced(spark):
    """Cut every key into slices of a few rows, as if all keys were hot."""
    spark.conf.set(SLICE_CHECK_BYTES, "-1")
    spark.conf.set(SLICE_ROWS, "7")
    yield
    spark.conf.unset(SLICE_CHECK_BYTES)
    spark.conf.unset(SLICE_ROWS)


@pytest.fixture
def both_ways(spark):
    """Run a query with and without slicing and return both results, sorted."""

    def run(build):
        plain = rows(build())
        spark.conf.set(SLICE_CHECK_BYTES, "-1")
        spark.conf.set(SLICE_ROWS, "7")
        try:
            cut = rows(build())
        finally:
            spark.conf.unset(SLICE_CHECK_BYTES)
            spark.conf.unset(SLICE_ROWS)
        return plain, cut

    return run


def rows(df):
    cols = sorted(df.columns)
    found = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
