from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = os.environ.get("BASKETRY_SF_DIR", "/root/testdata/sf0.001")


def make_session():
    from basketry.session import build_session

    spark = build_session("basketry-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SMALL).exists():
        pytest.skip("warehouse tables are absent")
    return SMALL
