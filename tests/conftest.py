from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quarry.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="quarry-test-ckpt-", dir="/tmp")
    s = get_session(
        "local[4]",
        shuffle_partitions=4,
        app_name="quarry-tests",
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def small_layers(spark):
    from quarry.plans.layers import from_driver_tables

    return from_driver_tables(spark, SF_SMALL)


def rows(df, order=None):
    """Collect as a list of dicts (sorted by ``order`` when given)."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[c] is not None, r[c]) for c in order))
    return out


def canon(collected):
    """Order-insensitive, NULL-safe canonical form of collected rows."""
    return sorted(tuple((v is None, str(type(v)), v if v is not None else 0) for v in r) for r in collected)
