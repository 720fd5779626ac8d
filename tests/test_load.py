import datetime as dt
import os
import re

from collections import Counter

import samples
from pyspark.sql import functions as F

from orderloom.operators import dims, load, metrics, orders
from orderloom.operators.joins import one_per_key
from orderloom.plans import queries
from orderloom.schemas import DIM_CUSTOMER, MART_FACT, VERSION_KEY
from orderloom.sources import files
from orderloom.sources.storage import work_folder


def _lines(spark):
    return orders.dedup_orders(orders.clean_orders(samples.raw_orders(spark)))


def test_append_twice_is_append_once(spark):
    clean = orders.clean_orders(samples.raw_orders(spark))
    target = _lines(spark).limit(0)
    first = load.idempotent_append(clean, target)
    assert first.count() == _lines(spark).count()
    assert load.idempotent_append(clean, first).count() == 0


def test_append_matches_null_keys(spark):
    clean = orders.clean_orders(samples.raw_orders(spark)).filter(F.col("status").isNull())
    assert clean.count() == 1
    assert load.idempotent_append(clean, clean).count() == 0


def _dim(spark):
    return dims.scd2_customer(samples.raw_customers(spark))


def test_one_aggregate_finds_new_keys(spark):
    """The same rows as one per key followed by an anti join, copies, nulls and NaN among the keys."""
    nan = float("nan")
    schema = "a string, b double, c int, d string"
    delta = spark.createDataFrame([("x", 1.0, 2, "q"), ("x", 1.0, 1, "r"), (None, nan, 3, None), (None, nan, 3, "s"), ("y", None, 4, None), ("z", -0.0, 5, "t")], schema)
    target = spark.createDataFrame([("x", 2.0, 0, ""), (None, nan, 0, ""), ("y", None, 0, None), ("y", None, 0, None)], schema)
    for known in (target, target.limit(0), target.filter("a is null")):
        expected = load.not_in(one_per_key(delta, ["a", "b"]), known, ["a", "b"])
        assert Counter(map(str, load.one_new_per_key(delta, known, ["a", "b"]).collect())) == Counter(map(str, expected.collect()))
    assert load.one_new_per_key(delta.select("a"), target.select("a"), ["a"]).collect() == [("z",)]


def test_merge_twice_is_merge_once(spark):
    delta = _dim(spark)
    once = load.scd2_merge(spark.createDataFrame([], DIM_CUSTOMER), delta)
    twice = load.scd2_merge(once, delta)
    assert Counter(once.collect()) == Counter(delta.collect()) == Counter(twice.collect())


def test_merge_closes_and_updates(spark):
    target = _dim(spark)
    version = target.filter("cust_id = 'C2'")
    moved = version.withColumns(
        {"valid_from": F.lit(dt.date(2024, 6, 1)), "region": F.lit("north"), "customer_sk": F.lit("new")}
    )
    changed = version.withColumns({"zip": F.lit(None).cast("string"), "customer_sk": F.lit("other")})
    rows = {(r.cust_id, r.valid_from): r for r in load.scd2_merge(target, moved.union(changed)).collect()}
    old, new = rows["C2", dt.date(2024, 1, 1)], rows["C2", dt.date(2024, 6, 1)]
    assert (old.valid_to, old.is_current, old.zip) == (dt.date(2024, 5, 31), False, None)
    assert old.customer_sk == version.first().customer_sk
    assert (new.is_current, new.region, new.customer_sk) == (True, "north", "new")


def test_merge_takes_newest(spark):
    target = _dim(spark).filter("cust_id = 'C2'")
    delta = target.withColumns({"sent": F.lit(1), "zip": F.lit("z")}).union(
        target.withColumns({"sent": F.lit(2), "zip": F.lit("a")})
    )
    assert load.scd2_merge(target, delta, newest="sent").first().zip == "a"
    assert load.scd2_merge(target, delta).first().zip == "z"


def test_validity_is_disjoint_and_gap_free(spark):
    rows = _dim(spark).orderBy(*VERSION_KEY).collect()
    for a, b in zip(rows, rows[1:]):
        if a.cust_id == b.cust_id:
            assert a.valid_to + dt.timedelta(1) == b.valid_from
    assert Counter(r.cust_id for r in rows if r.is_current) == Counter({r.cust_id for r in rows})


def test_table_round_trip_and_daywise_rerun(spark):
    path = f"{work_folder(spark, 'test')}/t"
    lines = _lines(spark)
    load.write_table(lines, path, "order_day", ("cust_id",))
    assert any(name.startswith("order_day=") for name in os.listdir(path))
    assert Counter(files.scan_table(spark, path).select(*lines.columns).collect()) == Counter(lines.collect())
    early = lines.filter("order_day = date'2023-12-31'").limit(1)
    load.write_table(early, path, "order_day", only_touched=True)
    assert files.scan_table(spark, path).count() == lines.count() - 1
    plan = files.scan_table(spark, path).filter("order_day = date'2023-12-31'")
    assert "PartitionFilters: [isnotnull(order_day" in plan._jdf.queryExecution().executedPlan().toString()


def test_compaction(spark):
    root = work_folder(spark, "test")
    lines = _lines(spark)
    for i in range(3):
        lines.repartition(4).write.mode("append").partitionBy("order_day").parquet(f"{root}/small")
    load.compact_table(spark, f"{root}/small", f"{root}/compact")
    files_in = lambda p: sum(f.endswith(".parquet") for _, _, fs in os.walk(p) for f in fs)
    assert files_in(f"{root}/compact") == 2 < files_in(f"{root}/small")
    assert files.scan_table(spark, f"{root}/compact").count() == 3 * lines.count()


def test_conform_by_name(spark):
    cells = ", ".join(f"cast(null as {f.dataType.simpleString()}) {f.name.upper()}" for f in MART_FACT.fields[:-1])
    row = load.conform(spark.sql(f"select 1.00005D REVENUE_USD, {cells}"), MART_FACT)
    assert row.schema.names == MART_FACT.names
    assert str(row.first().revenue_usd) == "1.0001"


def test_lines_in_buckets_by_order_meet_without_an_exchange(spark):
    path = work_folder(spark, "test")
    rows = spark.range(500).select(
        F.concat(F.lit("A-"), F.col("id") % 40).alias("order_id"), F.lit("Sweet").alias("root_category"),
        (F.col("id") % 3 == 0).alias("is_revenue_status"), F.col("id").cast("double").alias("revenue_usd"), F.lit(1.0).alias("quantity"),
    )
    table = load.write_buckets(rows, f"t_{path.rsplit('-', 1)[1]}", path, ["order_id"], 4)
    found = metrics.category_conversion(table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "hashpartitioning" in metrics.category_conversion(rows)._jdf.queryExecution().executedPlan().toString()
    assert found.collect() == metrics.category_conversion(rows).collect()
