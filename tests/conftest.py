"""One local session for all tests, and small builders for records and rules."""

from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from driverlens.operators.rules import Rule  # noqa: E402
from driverlens.session import build_session  # noqa: E402
from driverlens.streaming.incremental import RECORD_SCHEMA  # noqa: E402

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
DAY = datetime(2025, 11, 3, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cpus=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


def us(hour: int, minute: int = 0, micros: int = 0) -> int:
    return (DAY + timedelta(hours=hour, minutes=minute, microseconds=micros) - EPOCH) // timedelta(microseconds=1)


def raw(ts_us: int) -> str:
    at = EPOCH + timedelta(microseconds=ts_us)
    return at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{at.microsecond // 1000:03d}Z"


def record(ts_us: int, batch_id: int, cluster: str = "c", id: str = "q1", file_ord: int = 0, **metrics):
    return (cluster, id, batch_id, ts_us, raw(ts_us), {k: float(v) for k, v in metrics.items()}, file_ord, batch_id)


def rule(**fields) -> Rule:
    """A rule as a test says it; a field that plays no part in a test may be left out."""
    unsaid = dict(name="r", metric="m", aggregation="max", window_minutes=1, min_batches=1, operator="gt", threshold=0, cooldown_minutes=0, target_workers=1)
    return Rule(**{**unsaid, **fields})


def frame(spark, records):
    return spark.createDataFrame(records, RECORD_SCHEMA)


def initial(spark, **workers):
    rows = [(c, w, None) for c, w in (workers or {"c": 4}).items()]
    return spark.createDataFrame(rows, "cluster_id STRING, workers BIGINT, last_us BIGINT")
