import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from listingflow.session import get_spark

    return get_spark("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.sql.session.timeZone": "UTC", "spark.log.level": "ERROR", "spark.ui.showConsoleProgress": "false"})


@pytest.fixture(scope="session")
def tables(spark):
    from listingflow.queries import registry
    from listingflow.queries.base import Tables

    registry()
    return Tables(spark, SF)
