import datetime as dt
from collections import Counter

import pytest
import samples
from pyspark.sql import functions as F

from orderloom.functions import rules
from orderloom.operators import orders, quality
from orderloom.schemas import RAW_ORDERS


def test_every_reason(spark):
    numbered = spark.createDataFrame(
        [(i, *row) for i, (row, _) in enumerate(samples.ORDERS)], "i int, " + _ddl(RAW_ORDERS)
    )
    found = {r.i: r.dq_reason for r in orders.flagged_orders(numbered).select("i", "dq_reason").collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(samples.ORDERS)}


def _ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def test_split_loses_nothing(spark):
    raw = samples.raw_orders(spark)
    assert orders.clean_orders(raw).count() + orders.quarantine_orders(raw).count() == len(samples.ORDERS)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("A-7", "A-007"),
        ("A-21", "A-021"),
        ("A-021", "A-021"),
        ("A-1234", "A-1234"),
        ("A-00021", "A-021"),
        ("A-0", "A-000"),
        ("abC-99999999999999999999", "abC-99999999999999999999"),
        ("\tA-1\n", "A-001"),
        ("A-1-2", None),
        ("A--1", None),
        (" A-", None),
        ("A- ", None),
        ("A 1", None),
        ("", None),
    ],
)
def test_order_id(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(rules.normal_order_id(F.col("t"))).first()[0] == expected


def test_timestamp_ignores_session_zone(spark):
    times = ["3/10/2024 2:05", "7/1/2024 9:05", "11/3/2024 1:30", "12/31/9999 23:59", "1/1/1900 0:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(rules.order_timestamp("t").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [
        "2024-03-10 02:05:00", "2024-07-01 09:05:00", "2024-11-03 01:30:00", "9999-12-31 23:59:00",
        "1900-01-01 00:00:00",
    ]


def test_normalised_values(spark):
    rows = {r.order_id: r for r in orders.clean_orders(samples.raw_orders(spark)).collect()}
    assert rows["A-007"].status == "shipped" and rows["A-007"].cust_id == "C1"
    assert rows["A-021"].quantity == 4.0
    assert rows["A-042"].status is None and rows["A-042"].quantity == 100.0
    assert rows["A-1234"].order_ts == dt.datetime(2024, 1, 5, 9, 5)
    assert rows["A-1234"].order_day == dt.date(2024, 1, 5)


def test_dedup_keeps_distinct_lines(spark):
    lines = orders.dedup_orders(orders.clean_orders(samples.raw_orders(spark))).collect()
    count = Counter(r.order_id for r in lines)
    assert count["A-005"] == 2 and count["A-041"] == 2 and count["A-040"] == 2


def test_dedup_tie_break_and_hot_copies(spark):
    rows = [("A-1", c, samples.DAY, "1", "1", "paid") for c in ("C9", "C2", "C5")] * 2000
    clean = orders.clean_orders(spark.createDataFrame(rows, RAW_ORDERS))
    assert [r.cust_id for r in orders.dedup_orders(clean).collect()] == ["C2"]
    assert orders.duplicate_orders(clean).first().dup_count == 6000


def test_gate(spark):
    flagged = orders.flagged_orders(samples.raw_orders(spark))
    bad = sum(reason is not None for _, reason in samples.ORDERS)
    row = quality.dq_gate(flagged, 0.5).first()
    assert (row.total_rows, row.rejected_rows) == (len(samples.ORDERS), bad)
    quality.enforce_gate(flagged, 0.99)
    with pytest.raises(quality.GateFailed):
        quality.enforce_gate(flagged, 0.01)
    assert quality.dq_gate(flagged.limit(0), 0.0).first().passed


def test_quantities_no_mart_type_can_hold(spark):
    rows = [("A-1", "C1", samples.DAY, "1", q, "paid") for q in ("1e30", "9999999999999999999", "5")]
    flagged = orders.flagged_orders(spark.createDataFrame(rows, RAW_ORDERS)).select("quantity", "dq_reason").collect()
    assert {r.quantity: r.dq_reason for r in flagged} == {"1e30": "bad_quantity", "9999999999999999999": "bad_quantity", "5": None}
