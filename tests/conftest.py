from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tests set their own shared folder; a cluster names it in its config.
    ckpt = tempfile.mkdtemp(prefix="dimspark-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="dimspark-tests",
        shuffle_partitions=8,
        # Tests list the plans of their executions; by default the session forgets all but the last 1000.
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="dimspark-wh-"),
                    "spark.sql.ui.retainedExecutions": "100000"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="dimspark-test-")


def rows(df, *cols):
    """Sorted plain tuples of a DataFrame's rows (optionally some columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
