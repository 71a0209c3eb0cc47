import os
import sys
import time
from datetime import datetime, timedelta

# Fixture times are naive UTC wall-clock values: pin the test process (and
# the JVM and Python workers it launches) to UTC.
os.environ["TZ"] = "UTC"
time.tzset()

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel import schemas  # noqa: E402
from cartwheel.session import build_session  # noqa: E402

T0 = datetime(2026, 1, 1, 0, 0, 0)


def at(sec: float) -> datetime:
    return T0 + timedelta(seconds=sec)


# Hand-written event fixture (FIXTURES.md §2): event_id, user, type, product, t
EVENT_ROWS = [
    (1, 1, "page_view", None, 0),
    (2, 1, "product_view", 3, 2),
    (3, 1, "add_to_cart", 3, 4),
    (4, 1, "purchase", 3, 9),
    (4, 1, "purchase", 3, 9),
    (5, 2, "add_to_cart", 5, 0),
    (6, 2, "add_to_cart", 5, 1),
    (7, 2, "add_to_cart", 4, 3),
    (8, 2, "purchase", 4, 20),
    (9, 3, "search", None, 0),
    (10, 3, "purchase", 50, 1),
    (11, 4, "wishlist", 1, 0),
    (12, 5, "add_to_cart", 6, 0),
    (13, 5, "purchase", 7, 2),
]

# The original application's ten-product catalogue.
PRODUCT_ROWS = [
    (1, "iPhone 15", "Electronics", 10.0),
    (2, "MacBook Air", "Electronics", 15.0),
    (3, "Coffee Mug", "Home", 4.0),
    (4, "Gaming Chair", "Furniture", 100.0),
    (5, "OLED TV", "Electronics", 200.0),
    (6, "Notebook", "Stationery", 19.0),
    (7, "Mechanical Keyboard", "Electronics", 21.0),
    (8, "Running Shoes", "Fashion", 64.0),
    (9, "Backpack", "Fashion", 81.0),
    (10, "Desk Lamp", "Home", 100.0),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", app="cartwheel-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_events(spark):
    rows = [(e, u, t, p, at(s), None) for e, u, t, p, s in EVENT_ROWS]
    return spark.createDataFrame(rows, schemas.EVENT)


@pytest.fixture(scope="session")
def fixture_products(spark):
    return spark.createDataFrame(PRODUCT_ROWS, schemas.PRODUCT)


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
