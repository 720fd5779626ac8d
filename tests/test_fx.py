import datetime as dt
import random
from collections import Counter

import pytest
import samples

from orderloom.operators import dims, fact, fx, orders

D = dt.date


def _lines(spark, rows):
    return spark.createDataFrame(rows, "id int, currency string, order_day date")


@pytest.mark.parametrize("convert", [fx.fx_asof, fx.fx_forward_fill])
@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_nearest_prior(spark, convert, limit):
    days = [D(2023, 12, 31), D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 9), D(2031, 6, 1)]
    lines = _lines(spark, [(i, "YEN", d) for i, d in enumerate(days)] + [(9, "GBP", D(2024, 1, 1)), (10, None, None)])
    got = {r.id: r.conversion for r in convert(lines, samples.rates(spark), limit=limit).collect()}
    assert got == {0: None, 1: 0.007, 2: 0.007, 3: 0.008, 4: 0.008, 5: 0.008, 9: None, 10: None}


def test_exact(spark):
    lines = _lines(spark, [(1, "YEN", D(2024, 1, 2)), (2, "YEN", D(2024, 1, 3)), (2, "YEN", D(2024, 1, 3))])
    got = Counter((r.id, r.conversion) for r in fx.fx_exact(lines, samples.rates(spark)).collect())
    assert got == {(1, None): 1, (2, 0.008): 2}


@pytest.mark.parametrize("limit", [1 << 30, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, limit):
    rng = random.Random(seed)
    day = lambda: D(2020, 1, 1) + dt.timedelta(rng.randrange(500))
    rates = [(day(), rng.choice("AB"), rng.choice([None, rng.random()])) for _ in range(60)]
    lines = [(i, rng.choice("AABC"), day()) for i in range(400)]

    def nearest(currency, when):
        usable = [(d, v) for d, c, v in rates if c == currency and v is not None and d <= when]
        return max(usable)[1] if usable else None

    expected = {i: nearest(c, d) for i, c, d in lines}
    rate_frame = spark.createDataFrame(rates, "fx_date date, currency string, conversion double")
    for convert in (fx.fx_asof, fx.fx_forward_fill):
        rows = convert(_lines(spark, lines), rate_frame, limit=limit).collect()
        assert len(rows) == len(lines)
        assert {r.id: r.conversion for r in rows} == expected


def test_filled_days_is_exact(spark):
    rates = samples.rates(spark)
    assert fx.filled_days(rates) == fx.forward_filled(fx.rate_spans(rates)).count()
    assert fx.filled_days(rates.limit(0)) == 0


def test_far_future_order_adds_no_rows(spark):
    lines = _lines(spark, [(1, "YEN", D(9999, 12, 31))])
    assert fx.fx_forward_fill(lines, samples.rates(spark)).first().conversion == 0.008
    assert fx.filled_days(samples.rates(spark)) < 10


@pytest.mark.parametrize("convert", [fx.fx_asof, fx.fx_forward_fill, fx.fx_exact])
def test_fact_has_one_row_per_line(spark, convert):
    lines = orders.dedup_orders(orders.clean_orders(samples.raw_orders(spark)))
    products = dims.dim_product(samples.raw_products(spark), dims.category_rollup(samples.raw_categories(spark)), 0)
    priced = fact.priced_orders(lines, products)
    rows = fact.fact_orders(priced, samples.rates(spark), convert).collect()
    assert len(rows) == lines.count()
    flags = {r.status: r.is_revenue_status for r in rows}
    assert flags == {"paid": True, "shipped": True, "created": False, "cancelled": False, None: False}
    if convert is not fx.fx_exact:
        revenue = {r.order_id: r.revenue_usd for r in rows}
        assert revenue["A-1234"] == pytest.approx(10 * 3 * 0.008)
        assert revenue["A-041"] is None and revenue["A-042"] is None
