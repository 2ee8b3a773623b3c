from __future__ import annotations

import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchcredit.schema import EXPORT_SCHEMA  # noqa: E402
from touchcredit.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="touchcredit-tests-")
    s = local_session(8, 8, app="touchcredit-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="touchcredit-t-")


def _micros(ts: str) -> int:
    dt = datetime.strptime(ts, "%Y-%m-%d %H:%M")
    return int((dt - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def export_row(pseudo, name, ts, sid, user_id=None, source=None, medium=None, campaign=None, revenue=None,
               txn=None):
    """One export row (EXPORT_SCHEMA) from the few fields the scenarios vary."""
    params = [("ga_session_id", (None, sid, None, None))]
    return (
        _micros(ts), ts[:10].replace("-", ""), name, pseudo, user_id, "WEB",
        (campaign, medium, source),
        [(k, v) for k, v in params],
        (revenue, txn) if revenue is not None else None,
        (None,),
        ("desktop", None, None, None, None, None, None, None, None, None, None, None, (None,)),
        ("Europe", "Germany", "Berlin", "Berlin"),
    )


def make_export(spark, rows):
    return spark.createDataFrame(rows, EXPORT_SCHEMA)
