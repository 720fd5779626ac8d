import datetime as dt

import pytest

from orderloom.operators import metrics
from orderloom.schemas import DIM_CUSTOMER, DIM_PRODUCT, FACT_ORDERS

DAY = dt.date(2024, 3, 5)
OPEN = dt.date(9999, 12, 31)


def _fact(spark, rows):
    """rows: order, customer, product, root, day, quantity, status flag, revenue"""
    full = [
        (o, c, p, 1, root, dt.datetime.combine(day, dt.time(9)), day, q, "s", paid, "USD", 1.0, 1.0, revenue)
        for o, c, p, root, day, q, paid, revenue in rows
    ]
    return spark.createDataFrame(full, FACT_ORDERS)


@pytest.fixture(scope="module")
def frames(spark):
    fact = _fact(
        spark,
        [
            ("A-001", "C1", 1, "Sweet", DAY, 2.0, True, 20.0),
            ("A-001", "C1", 2, "Sweet", DAY, 1.0, True, 5.0),
            ("A-002", "C1", 1, "Sweet", dt.date(2024, 1, 2), 1.0, False, 10.0),
            ("A-003", "C2", 2, "salt", DAY, 1.0, True, 7.0),
            ("A-004", "C2", 3, "Sweet", DAY, 3.0, True, None),
            ("A-005", "C2", 1, "Sweet", dt.date(2023, 1, 1), 1.0, True, 100.0),
            ("A-006", "C7", 1, "Sweet", DAY, 1.0, True, 50.0),
        ],
    )
    versions = [
        ("k1", "C1", "US", "east", "r", "1", True, dt.date(2024, 1, 1), dt.date(2024, 2, 29), False),
        ("k2", "C1", "US", "west", "r", "1", False, dt.date(2024, 3, 1), OPEN, True),
        ("k3", "C2", "US", "west", "r", "1", True, dt.date(2024, 1, 1), OPEN, True),
    ]
    products = [(1, 1, "bar", 10.0, "USD", "c", "Sweet"), (2, 1, "chip", 5.0, "USD", "c", "Sweet"),
                (3, 1, "bar", 1.0, "USD", "c", "Sweet")]
    return fact, spark.createDataFrame(products, DIM_PRODUCT), spark.createDataFrame(versions, DIM_CUSTOMER)


def test_active_customers(frames):
    fact, _, customers = frames
    rows = [tuple(r) for r in metrics.dau_by_region(fact, customers).collect()]
    # C7 has no version and A-005 precedes the first one, so neither counts.
    assert rows == [(dt.date(2024, 1, 2), "east", 1), (DAY, "west", 2)]


def test_conversion(frames):
    row = metrics.category_conversion(frames[0]).first()
    assert tuple(row) == (175.0, 4, 5, 0.8, 8.0)
    empty = metrics.category_conversion(frames[0], "none").first()
    assert tuple(empty) == (None, 0, 0, None, None)


@pytest.mark.parametrize("size", [None, 1 << 40])
def test_top_products(frames, size):
    fact, products, customers = frames
    rows = metrics.top_products_by_region(fact, products, customers, product_size=size).collect()
    # Products 1 and 3 share a name; a null revenue does not lead the ranking.
    assert [tuple(r) for r in rows] == [("west", "bar", 20.0, 1), ("west", "chip", 12.0, 2)]


def test_top_keeps_ties(spark, frames):
    _, products, customers = frames
    fact = _fact(spark, [(f"A-{i}", "C1", i % 2 + 1, "Sweet", DAY, 1.0, True, 5.0) for i in range(4)])
    rows = metrics.top_products_by_region(fact, products, customers, top=1).collect()
    assert [r.rnk for r in rows] == [1, 1]


def test_lifetime_value(frames):
    fact, _, customers = frames
    rows = {r.cust_id: r for r in metrics.customer_lifetime_value(fact, customers).collect()}
    # Two versions of C1 must not double its revenue.
    assert (rows["C1"].lifetime_value_usd, rows["C1"].realized_orders, rows["C1"].currently_active) == (25.0, 1, False)
    assert (rows["C2"].lifetime_value_usd, rows["C2"].realized_orders) == (107.0, 3)
    assert rows["C7"].currently_active is None
