import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ferrovia.session import checkpoint_root, get_session
    s = get_session("local[4]", shuffle_partitions=4, extra={"spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)          # the session's shared folder; a private one only when unset
    yield s
    s.stop()


@pytest.fixture(autouse=True, scope="module")
def nothing_kept(spark):
    """What a module's queries have kept doesn't show in the plans of the next."""
    yield
    spark.catalog.clearCache()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
