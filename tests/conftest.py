from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="kestrel-tests")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kestrel-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


class _Rows(list):
    """Rows that compare equal to any list holding the same tuples in any order."""

    def __eq__(self, other):
        return sorted(self, key=repr) == sorted((tuple(o) for o in other), key=repr)

    __hash__ = None


def plan_text(df, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def rows(df, *cols):
    """Collected rows as plain tuples (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return _Rows(tuple(r) for r in sel.collect())
