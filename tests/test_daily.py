"""Metrics kept per day against the metrics of the whole fact."""

import datetime as dt
import random

from pyspark.sql import functions as F

from orderloom.operators import metrics
from orderloom.operators.load import conform, with_validity
from orderloom.schemas import DIM_CUSTOMER, DIM_PRODUCT, FACT_ORDERS, MART_FACT
from orderloom.sources.storage import kept, names, work_folder
from orderloom.streaming import daily

FIRST = dt.date(2024, 1, 1)


def _fact(spark, rows, seed):
    draw = random.Random(seed)

    def line(number):
        day = FIRST + dt.timedelta(draw.randrange(20))
        revenue = draw.choice([None, 0.0, round(draw.uniform(-5, 50), 4)])
        return (
            f"A-{draw.randrange(60):03d}", draw.choice(["C1", "C1", "C2", "C3", "C9", None]), draw.randrange(6), 1,
            draw.choice(["Sweet", "salt", None]), dt.datetime.combine(day, dt.time(9, number % 60)), day, float(number), "s",
            draw.choice([True, False, None]), "USD", 1.0, 1.0, revenue,
        )

    return kept(conform(spark.createDataFrame([line(i) for i in range(rows)], FACT_ORDERS), MART_FACT), "fact")


def _versions(spark, rows):
    full = [(f"{c}{d}", c, "US", region, "r", "1", True, FIRST + dt.timedelta(d), None, None) for c, d, region in rows]
    return kept(with_validity(spark.createDataFrame(full, DIM_CUSTOMER)), "versions")


def _products(spark):
    return spark.createDataFrame([(i, 1, f"p{i % 4}", 1.0, "USD", "c", "Sweet") for i in range(5)], DIM_PRODUCT)


def _same(spark, root, fact, versions):
    products = _products(spark)
    pairs = [
        (daily.dau_by_region(spark, root), metrics.dau_by_region(fact, versions)),
        (daily.category_conversion(spark, root), metrics.category_conversion(fact)),
        (daily.top_products_by_region(spark, root, products), metrics.top_products_by_region(fact, products, versions)),
        (daily.customer_lifetime_value(spark, root, versions), metrics.customer_lifetime_value(fact, versions)),
    ]
    for ours, whole in pairs:
        assert sorted(map(str, ours.collect())) == sorted(map(str, whole.collect()))


EARLY = [("C1", 0, "east"), ("C2", 5, "west")]
CORRECTED = [("C1", 0, "east"), ("C1", 8, "north"), ("C1", 12, None), ("C2", 3, "south"), ("C3", 0, "east")]


def test_late_lines_and_corrected_versions(spark):
    root = work_folder(spark, "test")
    old, new = _versions(spark, EARLY), _versions(spark, CORRECTED)
    parts = [_fact(spark, 150, seed) for seed in range(3)]
    daily.add_load(parts[0], old, root, "a")
    _same(spark, root, parts[0], old)
    daily.add_load(parts[1], new, root, "b")
    _same(spark, root, parts[0].unionByName(parts[1]), new)
    # Customers alone change back, versions go away as well.
    daily.add_load(parts[0].limit(0), old, root, "c")
    _same(spark, root, parts[0].unionByName(parts[1]), old)
    daily.add_load(parts[2], old, root, "d")
    _same(spark, root, parts[0].unionByName(parts[1]).unionByName(parts[2]), old)


def test_a_load_that_runs_again_replaces_its_own(spark):
    root = work_folder(spark, "test")
    old, new = _versions(spark, EARLY), _versions(spark, CORRECTED)
    parts = [_fact(spark, 80, seed) for seed in (7, 8)]
    daily.add_load(parts[0], old, root, "a")
    daily.add_load(parts[0], old, root, "a")
    _same(spark, root, parts[0], old)
    for _ in range(2):
        daily.add_load(parts[1], new, root, "b")
        _same(spark, root, parts[0].unionByName(parts[1]), new)
    # A retry that finds other versions than the first attempt did.
    daily.add_load(parts[1], old, root, "b")
    _same(spark, root, parts[0].unionByName(parts[1]), old)
    daily.add_load(parts[1].limit(0), new, root, "c")
    _same(spark, root, parts[0].unionByName(parts[1]), new)


def test_empty_tables_and_unchanged_versions(spark):
    root = work_folder(spark, "test")
    none, versions = _fact(spark, 1, 1).limit(0), _versions(spark, EARLY)
    assert daily.dau_by_region(spark, f"{root}/nothing").count() == 0
    daily.add_load(none, versions.limit(0), root, "a")
    _same(spark, root, none, versions.limit(0))
    daily.add_load(none, versions, root, "b")
    before = names(spark, f"{root}/versions")
    fact = _fact(spark, 60, 3)
    daily.add_load(fact, versions, root, "c")
    _same(spark, root, fact, versions)
    assert sorted(names(spark, f"{root}/versions")) == sorted(before)


def test_only_customers_of_changed_versions_are_asked(spark):
    old, new = _versions(spark, EARLY), _versions(spark, [*EARLY, ("C1", 8, "north")])
    pick = lambda df: conform(df, daily.VERSION_IN_USE)
    rows = daily.changed_versions(pick(old), pick(new)).collect()
    assert [(r.cust_id, r.first_day) for r in rows] == [("C1", FIRST)]
    assert daily.changed_versions(pick(old), pick(old)).isEmpty()
    ledger = work_folder(spark, "test")
    fact = _fact(spark, 100, 5)
    daily.add_load(fact, old, ledger, "a")
    daily.add_load(fact.limit(0), new, ledger, "b")
    moved = spark.read.parquet(f"{ledger}/credits/load_id=b")
    # West is the region of C2, whose versions stayed.
    assert moved.filter(F.col("region") == "west").isEmpty() and not moved.isEmpty()


def test_folders_follow_months_and_loads(spark):
    root = work_folder(spark, "test")
    versions = _versions(spark, EARLY)
    # Days of two months, and lines without a day.
    days = F.when(F.col("prod_id") == 1, F.date_add("order_day", 31)).when(F.col("prod_id") > 1, F.col("order_day"))
    parts = [_fact(spark, 150, seed).withColumn("order_day", days) for seed in (11, 12)]
    for load, part in zip("ab", parts):
        daily.add_load(part, versions, root, load)
    _same(spark, root, parts[0].unionByName(parts[1]), versions)
    folders = lambda table: sorted(n for n in names(spark, f"{root}/{table}") if "=" in n)
    assert folders("activity") == ["order_month=2024-01-01", "order_month=2024-02-01", "order_month=__HIVE_DEFAULT_PARTITION__"]
    assert folders("orders") == folders("credits") == ["load_id=a", "load_id=b"]
    assert not [n for n in names(spark, f"{root}/credits/load_id=a") if "=" in n]
