from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesloom.schema import STAGING_COLUMNS, STAGING_SCHEMA  # noqa: E402
from salesloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(scratch / "shared"),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


# One complete, readable sale; tests change single fields of it.
SALE = {
    **{c: c for c in STAGING_COLUMNS},
    "id": "1", "customer_age": "30", "product_price": "10.50", "product_quantity": "5",
    "sale_date": "1/5/2021", "sale_quantity": "2", "sale_total_price": "21.00",
    "product_weight": "1.5", "product_rating": "4.5", "product_reviews": "7",
    "product_release_date": "1/1/2020", "product_expiry_date": "12/31/2025",
}


@pytest.fixture(scope="session")
def feed(spark):
    """Staging rows: the sale above with the given fields replaced, one row per argument."""

    def make(*changes: dict):
        rows = [tuple({**SALE, **change}[c] for c in STAGING_COLUMNS) for change in changes]
        return spark.createDataFrame(rows, STAGING_SCHEMA)

    return make
