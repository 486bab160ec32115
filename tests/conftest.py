from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
import unicodedata

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

RUN_TS = dt.datetime(2026, 1, 1)


def normalised_by_hand(text: str) -> str:
    """The normal form of a name, one character at a time: lower-case runs of letters and numbers
    (by Unicode category), one space between them."""
    out = ""
    gap = False
    for ch in text.lower():
        if unicodedata.category(ch)[0] in "LN":
            out += (" " if gap and out else "") + ch
            gap = False
        else:
            gap = True
    return out


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = (
        SparkSession.builder.master("local[*]")
        .appName("vinculum-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="vinculum-test-ckpt-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
