import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patronage.session import build_session  # noqa: E402
from rows import CUSTOMER, TRADE, at  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "tests", partitions=4, driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
    yield session
    session.stop()


@pytest.fixture
def trades(spark):
    """Cleaned trades from (shop, customer, trade, amount, time); the shop names tenant and platform."""

    def build(rows):
        full = []
        for shop, customer, trade, amount, time in rows:
            plat = shop.split("|")[0]
            full.append(("T", plat, shop, customer, trade, float(amount), 1, at(time)))
        return spark.createDataFrame(full, TRADE)

    return build


@pytest.fixture
def customers(spark):
    def build(pairs, modified="2000-01-01"):
        return spark.createDataFrame([("T", s.split("|")[0], s, c, at(modified)) for s, c in pairs], CUSTOMER)

    return build
