from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from aqarlens.session import checkpoint_dir, session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session(master="local[*]", app_name="aqarlens-tests", shuffle_partitions=8)
    if not checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aqarlens-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE
