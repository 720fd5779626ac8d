import base64
import datetime as dt
import json
import os
import time
from collections import Counter

import pytest
import samples
from pyspark.sql import functions as F, types as T

from orderloom import __main__
from orderloom.functions import rules
from orderloom.operators import dims, fact, orders
from orderloom.operators.load import compact_table, conform
from orderloom.plans.pipeline import unified_orders
from orderloom.schemas import DIM_CUSTOMER, LINE_KEY, MART_FACT, RAW_ORDERS, STREAM_ORDERS
from orderloom.sources.files import stream_table
from orderloom.sources.storage import work_folder
from orderloom.streaming import sink, validate
from orderloom.streaming.dedup import stream_dedup
from orderloom.streaming.sink import land_once
from orderloom.streaming.load import stream_incremental_load
from orderloom.streaming.upsert import read_buckets, stream_customer_merge

DATA = T.StructType([T.StructField("data", T.StringType())])


def _encode(text):
    return base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()


def _event(row):
    return _encode(json.dumps({k: v for k, v in zip(RAW_ORDERS.names, row) if v is not None}))


BROKEN = [
    "%%%",
    _encode("nope"),
    _encode('[{"order_id": "A-1"}]'),
    _encode("5"),
    _encode('{"order_id": "A-1"} x'),
    _encode('{"order_id": "A-1"}{"order_id": "A-2"}'),
    _encode(""),
    _encode(b'{"order_id": "\xff"}'),
    None,
]


def test_decode_failures(spark):
    frame = spark.createDataFrame([(d,) for d in BROKEN], DATA)
    flagged = validate.validate_events(frame)
    assert [r.dq_reason for r in flagged.collect()] == ["decode"] * len(BROKEN)
    assert validate.dead_letters(flagged).filter("data = '%%%'").first().copies == 1


def test_json_numbers_and_extra_fields(spark):
    text = '{"order_id": " A-5 ", "cust_id": "C1", "order_date": "01/05/2024 09:05", "prod_id": 7, "quantity": 2.0, "status": " PAID", "x": [1]}'
    good = validate.routed_events(validate.validate_events(spark.createDataFrame([(_encode(text),)], DATA))).filter("dq_reason is null").select(*STREAM_ORDERS.names)
    assert good.schema.names == STREAM_ORDERS.names
    assert tuple(good.first()) == ("A-005", "C1", "1/5/2024 09:05", 7, 2, "paid")


def test_same_verdicts_as_batch(spark):
    rows = [row for row, _ in samples.ORDERS]
    frame = spark.createDataFrame([(_event(row),) for row in rows], DATA)
    got = Counter(r.dq_reason for r in validate.validate_events(frame).collect())
    assert got == Counter(reason for _, reason in samples.ORDERS)
    counts = validate.event_counts(validate.validate_events(frame)).first()
    assert counts.good == got[None] and counts.bad == len(rows) - got[None]


@pytest.fixture()
def event_folder(spark):
    """The sample orders and broken events as three parquet files."""
    root = work_folder(spark, "test")
    data = [_event(row) for row, _ in samples.ORDERS] + BROKEN
    for i in range(3):
        part = spark.createDataFrame([(d,) for d in data[i::3]], DATA).coalesce(1)
        part.write.mode("append").parquet(f"{root}/in")
    return root


def _route(spark, root, checkpoint):
    events = stream_table(spark, f"{root}/in", DATA, files_per_trigger=1, origin=tuple(validate.SOURCE))
    out = [f"{root}/{name}" for name in ("good", "bad", "deliveries", checkpoint)]
    query = validate.stream_validate(events, *out)
    query.awaitTermination()
    return query


def _routed(spark, root):
    good = spark.read.schema(STREAM_ORDERS).json(f"{root}/good")
    bad = spark.read.json(f"{root}/bad").agg(F.sum("copies")).first()[0]
    counts = spark.read.parquet(f"{root}/deliveries").agg(F.sum("good"), F.sum("bad")).first()
    assert tuple(counts) == (good.count(), bad)
    return good, bad


def test_stream_equals_batch_and_replay_adds_nothing(spark, event_folder):
    root = event_folder
    query = _route(spark, root, "first")
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    good, bad = _routed(spark, root)
    lines = lambda raw: Counter(orders.dedup_orders(orders.clean_orders(raw)).collect())
    batch = samples.raw_orders(spark)
    empty = batch.limit(0)
    assert lines(unified_orders(empty, good)) == lines(batch)
    assert lines(unified_orders(batch, good)) == lines(batch)
    rejected = sum(reason is not None for _, reason in samples.ORDERS) + len(BROKEN)
    assert (good.count(), bad) == (len(samples.ORDERS) + len(BROKEN) - rejected, rejected)
    before = good.count(), bad
    _route(spark, root, "replay")
    good, bad = _routed(spark, root)
    assert (good.count(), bad) == before


def test_equal_events_of_later_batches_stay(spark):
    """One good and one bad event, each sent in two files, are four events."""
    root = work_folder(spark, "test")
    good = next(row for row, reason in samples.ORDERS if reason is None)
    for _ in range(2):
        rows = spark.createDataFrame([(_event(good),), ("%%%",)], DATA).coalesce(1)
        rows.write.mode("append").parquet(f"{root}/in")
        _route(spark, root, "first")
    kept, bad = _routed(spark, root)
    assert (kept.count(), bad) == (2, 2)
    _route(spark, root, "replay")
    kept, bad = _routed(spark, root)
    assert (kept.count(), bad) == (2, 2)


def _fact(spark):
    lines = orders.dedup_orders(orders.clean_orders(samples.raw_orders(spark)))
    products = dims.dim_product(samples.raw_products(spark), dims.category_rollup(samples.raw_categories(spark)), 0)
    return fact.fact_orders(fact.priced_orders(lines, products), samples.rates(spark))


def test_incremental_load(spark):
    root = work_folder(spark, "test")
    rows = _fact(spark)
    # Column names in another case and a file delivered twice.
    shouting = rows.toDF(*[c.upper() for c in rows.columns])
    shouting.coalesce(1).write.parquet(f"{root}/in")
    shouting.coalesce(1).write.mode("append").parquet(f"{root}/in")
    for attempt in ("first", "replay"):
        source = stream_table(spark, f"{root}/in", rows.schema, files_per_trigger=1)
        stream_incremental_load(source, f"{root}/mart", f"{root}/{attempt}").awaitTermination()
    mart = spark.read.parquet(f"{root}/mart")
    assert any(d.startswith("order_day=") for _, ds, _ in os.walk(f"{root}/mart") for d in ds)
    expected = Counter(conform(rows, MART_FACT).collect())
    assert Counter(mart.select(*MART_FACT.names).collect()) == expected
    assert mart.dropDuplicates(LINE_KEY).count() == mart.count()


def test_retried_batch_replaces_its_own_files(spark):
    root = work_folder(spark, "test")
    rows = conform(_fact(spark), MART_FACT)
    land_once(rows.limit(1), f"{root}/t", "q-0", LINE_KEY, "order_day")
    land_once(rows, f"{root}/t", "q-0", LINE_KEY, "order_day")
    land_once(rows, f"{root}/t", "q-1", LINE_KEY, "order_day")
    assert spark.read.parquet(f"{root}/t").count() == rows.count()


def test_load_goes_on_after_compaction(spark):
    root = work_folder(spark, "test")
    rows = conform(_fact(spark), MART_FACT)
    first = rows.filter(F.col("order_id") == rows.first().order_id)
    land_once(first, f"{root}/t", "q-0", LINE_KEY, "order_day")
    compact_table(spark, f"{root}/t", f"{root}/new")
    land_once(first, f"{root}/new", "r-0", LINE_KEY, "order_day")
    assert spark.read.parquet(f"{root}/new").count() == first.count()
    land_once(rows, f"{root}/new", "r-1", LINE_KEY, "order_day")
    assert Counter(spark.read.parquet(f"{root}/new").select(*MART_FACT.names).collect()) == Counter(rows.collect())


def test_customer_merge(spark):
    root = work_folder(spark, "test")
    dim = dims.scd2_customer(samples.raw_customers(spark))
    dim.coalesce(1).write.parquet(f"{root}/in")
    for attempt in ("first", "replay"):
        source = stream_table(spark, f"{root}/in", DIM_CUSTOMER)
        stream_customer_merge(source, f"{root}/dim", f"{root}/{attempt}").awaitTermination()
    merged = read_buckets(spark, f"{root}/dim", DIM_CUSTOMER)
    assert Counter(merged.collect()) == Counter(dim.collect())


def test_dedup_within_watermark(spark):
    root = work_folder(spark, "test")
    rows = spark.sql("select id % 50 event_id, timestamp_ntz'2024-01-01 00:00:00' ts from range(100)")
    rows.coalesce(1).write.parquet(f"{root}/in")
    query = (
        stream_dedup(stream_table(spark, f"{root}/in", rows.schema), ["event_id"], "ts")
        .writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 50


def test_trigger_picks_up_later_files(spark):
    """The service's trigger, with a shorter interval, loads what lands while it runs."""
    root = work_folder(spark, "test")
    fact = spark.createDataFrame([], MART_FACT)
    row = {"order_id": "A-001", "cust_id": "C1", "prod_id": 1, "order_ts": "2024-01-05 09:05:00", "order_day": "2024-01-05", "status": "paid"}
    one = lambda n: spark.createDataFrame([{**row, "order_id": f"A-{n}"}])
    typed = lambda df: conform(df.withColumns({c: F.lit(None).cast("string") for c in fact.columns if c not in df.columns}), MART_FACT)
    typed(one(1)).write.parquet(f"{root}/in")
    query = stream_incremental_load(stream_table(spark, f"{root}/in", MART_FACT), f"{root}/mart", f"{root}/c", trigger={"processingTime": "1 second"})
    assert __main__.EVERY_MINUTE == {"processingTime": "1 minute"}

    def loaded(n):
        deadline = time.monotonic() + 60
        while time.monotonic() < deadline:
            query.processAllAvailable()
            if spark.read.parquet(f"{root}/mart").count() == n:
                return True
        return False

    try:
        assert loaded(1)
        typed(one(2)).write.mode("append").parquet(f"{root}/in")
        assert loaded(2)
    finally:
        query.stop()


def test_only_days_that_may_hold_a_key_are_read(spark):
    root = work_folder(spark, "test")
    days = spark.range(1000).selectExpr("cast(id as string) key", "date_add(date'2024-01-01', cast(id % 50 as int)) day")
    early, late = days.filter("cast(key as int) < 900"), days.filter("cast(key as int) >= 900")
    sink.land_once(early, f"{root}/t", "one-0", ["key"], "day")
    assert sink._known_days(late, f"{root}/t", "two-0", ["key"], "day") == []
    again = late.unionByName(days.filter("key = '7'"))
    assert [str(d) for d in sink._known_days(again, f"{root}/t", "two-0", ["key"], "day")] == ["2024-01-08"]
    sink.land_once(again, f"{root}/t", "two-0", ["key"], "day")
    sink.land_once(days, f"{root}/t", "three-0", ["key"], "day")
    assert sorted(r.key for r in spark.read.parquet(f"{root}/t").collect()) == sorted(str(i) for i in range(1000))


def test_a_batch_is_computed_once_for_its_files(spark):
    """What a stream does before a batch runs for no question without a record, and once if all its files are known."""
    root = work_folder(spark, "sent")
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    schema = "data string, source string, source_day date"
    rows = spark.createDataFrame([("x", f, dt.date(2024, 1, 1)) for f in ("a", "a", "b")], schema).coalesce(1)
    batch = rows.mapInPandas(counted, schema)
    assert sink.not_delivered(batch, f"{root}/d", "one").count() == 3 and runs.value == 1
    record = spark.createDataFrame([("a", 2, 0, dt.date(2024, 1, 1))], "source string, good long, bad long, source_day date")
    sink.write_load(record, f"{root}/d", "one", "source_day")
    assert [r.source for r in sink.not_delivered(batch, f"{root}/d", "two").collect()] == ["b"]
    assert sink.not_delivered(batch, f"{root}/d", "one").count() == 3
    sink.write_load(record.withColumn("source", F.lit("b")), f"{root}/d", "more", "source_day")
    before = runs.value
    assert sink.not_delivered(batch, f"{root}/d", "two").count() == 0 and runs.value == before + 1


def test_order_date_text(spark):
    rows = spark.sql("SELECT explode(array(timestamp_ntz'2024-01-05 09:05:07', timestamp_ntz'0031-12-25 23:59:00', timestamp_ntz'+12024-01-05 09:05:00', null)) AS ts")
    old = F.regexp_replace(F.col("ts").cast("string"), r"^(\d{4})-0?(\d+)-0?(\d+) (\d\d:\d\d):.*$", "$2/$3/$1 $4")
    found = rows.select(rules.order_date_text("ts").alias("new"), old.alias("old")).collect()
    assert found[0].new == "1/5/2024 09:05" and all(r.new == r.old for r in found)


def test_a_replay_records_no_key_again(spark):
    """Hashes that a load has recorded are not written by another; new keys beside them are, and once."""
    root = work_folder(spark, "test")
    days = spark.range(100).selectExpr("cast(id as string) key", "date_add(date'2024-01-01', cast(id % 50 as int)) day")
    hashes = lambda: spark.read.parquet(f"{root}/t_keys")
    sink.land_once(days.filter("key < '5'"), f"{root}/t", "one-0", ["key"], "day")
    before = hashes().count()
    sink.land_once(days.filter("key < '5'"), f"{root}/t", "two-0", ["key"], "day")
    assert hashes().count() == before
    sink.land_once(days, f"{root}/t", "three-0", ["key"], "day")
    sink.land_once(days, f"{root}/t", "three-0", ["key"], "day")
    assert hashes().count() == hashes().select("key_hash").distinct().count() == spark.read.parquet(f"{root}/t").count() == 100
