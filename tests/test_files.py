import json
from collections import Counter

import samples

from orderloom.operators import rejects
from orderloom.plans import pipeline
from orderloom.plans.star import Raw
from orderloom.schemas import DATASETS, RAW_CUSTOMER, RAW_ORDERS, RAW_PRODUCT, STREAM_ORDERS
from orderloom.sources import files, landing
from orderloom.sources.storage import work_folder


def _put(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content)


def test_csv_binds_by_position_and_keeps_bad_rows(spark, tmp_path):
    _put(tmp_path, "o/a.csv", b"order_id,cust_id,order date,prod_id,quantity,status\nA-1,C1,1/5/2024 9:05,1,0.1,paid\nA-2,C1\n")
    rows = files.scan_csv(spark, str(tmp_path / "o"), RAW_ORDERS).orderBy("order_id").collect()
    assert rows[0].order_date == "1/5/2024 9:05" and rows[0]._corrupt_record is None
    assert rows[1].status is None and rows[1]._corrupt_record == "A-2,C1"
    _put(tmp_path, "p/a.csv", b"prod_id,cat_id,prod_name,price,currency\n1,2,bar,9.5,Yen\nx,2,bar,cheap,Yen\n")
    rows = files.scan_csv(spark, str(tmp_path / "p"), RAW_PRODUCT).orderBy("prod_id").collect()
    assert (rows[0].prod_id, rows[0].price, rows[0]._corrupt_record) == (None, None, "x,2,bar,cheap,Yen")
    assert rows[1].price == 9.5


def test_rates(spark, tmp_path):
    _put(
        tmp_path,
        "r.json",
        b'[\n {"date": "2024-01-01",\n  "currency": " yen", "conversion": 0.007},\n'
        b' {"date": "2024-01-02", "currency": "EUR", "conversion": "1.1"},\n {"date": "soon", "currency": "EUR", "conversion": "x"}]',
    )
    rows = [tuple(r) for r in files.scan_rates(spark, str(tmp_path)).collect()]
    assert [(str(d), c, v) for d, c, v, *_ in rows] == [
        ("2024-01-01", "YEN", 0.007), ("2024-01-02", "EUR", 1.1), ("None", "EUR", None)
    ]


def test_landing_rules(spark, tmp_path):
    put = lambda p, c: _put(tmp_path, f"bronze/raw/{p}", c)
    put("orders/d1/good.csv", b"a,b\n1,2\n")
    put("orders/d1/deep/er/good.csv", b"a,b\n")
    put("orders/d1/_SUCCESS", b"")
    put("orders/d1/empty.csv", b"")
    put("orders/d1/plain.csv", b"no header\n1,2\n")
    put("orders/d1/late.csv", b"x" * 20_000 + b",")
    put("orders/d1/edge.csv", b"x" * 20_000 + b"\n1,2")
    put("currency_conversion/d1/rates.json", b"[]")
    put("currency_conversion/d1/empty.json", b"")
    put("other/d1/a.csv", b"a,b\n")
    _put(tmp_path, "top.csv", b"a,b\n")
    manifest = landing.landing_manifest(landing.with_heads(landing.list_landed(spark, str(tmp_path))))
    got = {r.key.removeprefix("bronze/raw/"): (r.status, r.reason, r.dataset) for r in manifest.collect()}
    bad, ok = "rejected", ("accepted", None)
    header = "missing_or_malformed_header"
    assert got == {
        "orders/d1/good.csv": (*ok, "orders"),
        "orders/d1/deep/er/good.csv": (*ok, "orders"),
        "orders/d1/empty.csv": (bad, "empty_file", "orders"),
        "orders/d1/plain.csv": (bad, header, "orders"),
        "orders/d1/_SUCCESS": (bad, "hidden_name", "orders"),
        "orders/d1/late.csv": (*ok, "orders"),
        "orders/d1/edge.csv": (bad, header, "orders"),
        "currency_conversion/d1/rates.json": (*ok, "currency_conversion"),
        "currency_conversion/d1/empty.json": (bad, "empty_file", "currency_conversion"),
        "other/d1/a.csv": (bad, "unexpected_dataset:other", "other"),
        "top.csv": (bad, "unexpected_dataset:", ""),
    }
    summary = {(r.dataset, r.status): r.files for r in landing.landing_summary(manifest).collect()}
    assert summary["orders", "accepted"] == 3 and summary["unknown", "rejected"] == 1


def test_notification_keys(spark):
    keys = spark.createDataFrame([("bronze/raw/orders/d+1/a%20b.csv", 5)], "key string, size bigint")
    assert landing.landed_keys(keys).first().key == "bronze/raw/orders/d 1/a b.csv"


def test_pipeline_from_files_to_gold(spark):
    root = work_folder(spark, "test")
    raw = Raw(
        samples.raw_orders(spark),
        samples.raw_customers(spark),
        samples.raw_products(spark),
        samples.raw_categories(spark),
        samples.rates(spark).filter("fx_date is not null"),
    )
    pipeline.write_bronze(raw, f"{root}/bronze/raw")
    landed = landing.landing_manifest(landing.with_heads(landing.list_landed(spark, root)))
    assert {r.dataset for r in landed.filter("status = 'accepted'").collect()} == set(DATASETS)
    counts = pipeline.bronze_to_silver(spark, pipeline.read_bronze(spark, f"{root}/bronze/raw"), f"{root}/silver", 0.9)
    found = {r.stage: r.rows for r in counts.collect()}
    good = Counter(row for row, reason in samples.ORDERS if reason is None)
    assert found["fact_orders"] == len(good)
    assert found["orders_quarantine"] == sum(reason is not None for _, reason in samples.ORDERS)
    assert (found["dim_customer"], found["customer_quarantine"], found["dim_product"]) == (4, 3, 3)
    pipeline.silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    gold = pipeline.served(spark, f"{root}/gold", "fact_orders")
    assert gold.count() == len(good) and gold.columns == files.scan_table(spark, f"{root}/silver/fact_orders").drop("load_id").columns
    assert pipeline.served(spark, f"{root}/gold", "dim_date").count() == 6
    assert pipeline.served(spark, f"{root}/gold", "orders_quarantine").count() == found["orders_quarantine"]
    pipeline.gold_metrics(spark, f"{root}/gold", f"{root}/metrics")
    metric = lambda name: files.scan_table(spark, f"{root}/metrics/{name}")
    assert metric("category_conversion").count() == 1
    assert metric("duplicate_orders").count() == 0
    assert metric("customer_lifetime_value").count() == gold.select("cust_id").distinct().count()
    rejected = Counter({r.dq_reason: r.faulty_count for r in metric("dq_reason_counts").collect()})
    assert rejected == Counter(reason for _, reason in samples.ORDERS if reason is not None)


def test_rows_of_rejected_files_are_not_read_on(spark, tmp_path):
    put = lambda p, c: _put(tmp_path, f"bronze/raw/{p}", c)
    head = b"order_id,cust_id,order date,prod_id,quantity,status\n"
    put("orders/d 1+2/good.csv", head + b"A-1,C1,1/5/2024 9:05,1,2,paid\n")
    put("orders/d 1+2/plain.csv", b"no header\nA-2,C1,1/5/2024 9:05,1,2,paid\n")
    put("orders/d%20/plain.csv", b"no header\nA-3,C1,1/5/2024 9:05,1,2,paid\n")
    for name in ("customer", "product", "prod_cat_tree"):
        put(f"{name}/d/a.csv", b"a,b\n")
    put("currency_conversion/d/a.json", b"[]")
    manifest = landing.landing_manifest(landing.with_heads(landing.list_landed(spark, str(tmp_path)))).cache()
    raw = pipeline.read_bronze(spark, f"{tmp_path}/bronze/raw", manifest, str(tmp_path))
    assert [r.order_id for r in raw.orders.collect()] == ["A-1"]
    assert raw.customers.count() == 0 and raw.rates.count() == 0
    whole = pipeline.read_bronze(spark, f"{tmp_path}/bronze/raw")
    assert sorted(r.order_id for r in whole.orders.collect()) == ["A-1", "A-2", "A-3"]


def test_rejects_of_all_inputs(spark, tmp_path):
    put = lambda p, c: _put(tmp_path, f"bronze/raw/{p}", c)
    put("orders/d/a.csv", b"order_id,cust_id,order date,prod_id,quantity,status\nA-1,C1\nA-1,C1\nA-2,C1,1/5/2024 9:05,1,2,paid\n")
    put("customer/d/a.csv", b"id,at,country,region,type,zip,active\nC1,1/1/2024,US,e,r,1,n\nC1,1/1/2024,US,e,r,1,y\n ,1/1/2024,US,e,r,1,y\nC2,x,US,e,r,1,y\n")
    put("product/d/a.csv", b"p,c,n,price,cur\n1,2,bar,9.5,Yen\n1,2,bar,9.5,Yen\n1,2,bar,8.5,Yen\nx,2,bar,cheap,Yen\n")
    put("prod_cat_tree/d/a.csv", b"i,c,p\n1,bar,Sweet\n1,bar,Sweet\n2,chip,all\n")
    put("currency_conversion/d/a.json", b'[{"date":"2024-01-01","currency":"EUR","conversion":2},{"date":"2024-01-01","currency":"eur","conversion":1},{"date":"soon","currency":"EUR","conversion":1}]')
    raw = pipeline.read_bronze(spark, f"{tmp_path}/bronze/raw")
    found = rejects.input_rejects(raw).collect()
    assert all(r.source.endswith((f"/{r.dataset}/d/a.csv", f"/{r.dataset}/d/a.json")) for r in found)
    text = lambda r: r.record if r.reason == "corrupt_record" else json.loads(r.record)
    got = sorted((r.dataset, r.reason, r.copies, str(text(r))) for r in found)
    product = {"prod_id": 1, "cat_id": 2, "prod_name": "bar", "price": 9.5, "currency": "Yen"}
    assert got == sorted([
        ("orders", "corrupt_record", 2, "A-1,C1"), ("product", "corrupt_record", 1, "x,2,bar,cheap,Yen"),
        ("product", "duplicate_product", 2, str(product)), ("prod_cat_tree", "duplicate_category", 1, str({"cat_id": 1, "child": "bar", "parent": "Sweet"})),
        ("customer", "blank_customer", 1, str(dict(zip(RAW_CUSTOMER.names, [" ", "1/1/2024", "US", "e", "r", "1", "y"])))),
        ("customer", "bad_created_at", 1, str(dict(zip(RAW_CUSTOMER.names, ["C2", "x", "US", "e", "r", "1", "y"])))),
        ("customer", "superseded_version", 1, str(dict(zip(RAW_CUSTOMER.names, ["C1", "1/1/2024", "US", "e", "r", "1", "n"])))),
        ("currency_conversion", "duplicate_rate", 1, str({"date": "2024-01-01", "currency": "eur", "conversion": "1"})),
        ("currency_conversion", "unusable_rate", 1, str({"date": "soon", "currency": "EUR", "conversion": "1"})),
    ])


def test_streamed_slices_join_the_silver_fact_once(spark, tmp_path):
    root = work_folder(spark, "test")
    raw = Raw(samples.raw_orders(spark), samples.raw_customers(spark), samples.raw_products(spark), samples.raw_categories(spark), samples.rates(spark).filter("fx_date is not null"))
    pipeline.bronze_to_silver(spark, raw, f"{root}/silver")
    before = files.scan_table(spark, f"{root}/silver/fact_orders").count()
    known = files.scan_table(spark, f"{root}/silver/fact_orders").limit(1).selectExpr(
        "order_id", "cust_id", "date_format(order_ts, 'M/d/yyyy H:mm') order_date", "prod_id", "cast(quantity as bigint) quantity", "status")
    new = [("A-901", "C1", "1/5/2024 9:05", 1, 2, "paid"), ("A-901", "C1", "1/5/2024 9:05", 1, 2, "paid"), ("A-902", "", "1/5/2024 9:05", 1, 2, "paid")]
    known.unionByName(spark.createDataFrame(new, STREAM_ORDERS)).write.json(f"{root}/good")
    for attempt in ("first", "replay"):
        landed = files.stream_table(spark, f"{root}/good", STREAM_ORDERS, format="json")
        pipeline.stream_to_silver(landed, f"{root}/silver", f"{root}/{attempt}").awaitTermination()
    after = files.scan_table(spark, f"{root}/silver/fact_orders")
    assert after.count() == before + 1
    added = after.filter("order_id = 'A-901'").first()
    assert added.revenue_usd is None or added.revenue_usd > 0
    assert {r.dq_reason for r in files.scan_table(spark, f"{root}/silver/stream_quarantine").collect()} == {"orphan_customer"}
    # The next batch run reads the same events among the orders and gives the same fact.
    again = Raw(pipeline.unified_orders(raw.orders, files.scan_events(spark, f"{root}/good")), raw.customers, raw.products, raw.categories, raw.rates)
    pipeline.bronze_to_silver(spark, again, f"{root}/silver2")
    names = [c for c in after.columns if c != "load_id"]
    assert Counter(files.scan_table(spark, f"{root}/silver2/fact_orders").select(*names).collect()) == Counter(after.select(*names).collect())


def test_raw_customers_are_computed_once(spark):
    """The dimension, its quarantine and the rejects share one computation of what customers are read from."""
    root = work_folder(spark, "test")
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    customers = samples.raw_customers(spark).coalesce(1)
    customers = customers.mapInPandas(counted, customers.schema)
    raw = Raw(samples.raw_orders(spark), customers, samples.raw_products(spark), samples.raw_categories(spark), samples.rates(spark).filter("fx_date is not null"))
    pipeline.bronze_to_silver(spark, raw, f"{root}/silver")
    assert runs.value == 1


def test_hot_products_of_a_slice_are_counted_before_it_is_deduplicated(spark, monkeypatch):
    """With products too many to broadcast, and to the same fact."""
    root = work_folder(spark, "test")
    raw = Raw(samples.raw_orders(spark), samples.raw_customers(spark), samples.raw_products(spark), samples.raw_categories(spark), samples.rates(spark).filter("fx_date is not null"))
    new = [("A-901", "C1", "1/5/2024 9:05", 1, 2, "paid"), ("A-901", "C1", "1/5/2024 9:05", 1, 2, "paid"), ("A-902", "C2", "1/5/2024 9:05", 1, 2, "paid")]
    spark.createDataFrame(new, STREAM_ORDERS).write.json(f"{root}/good")
    facts, counted, hot_keys = [], [], pipeline.joins.hot_keys
    for size in (0, 1 << 40):
        pipeline.bronze_to_silver(spark, raw, f"{root}/silver{size}")
        monkeypatch.setattr(pipeline.joins, "measured_bytes", lambda df, size=size: size)
        monkeypatch.setattr(pipeline.joins, "hot_keys", lambda df, *keys, **options: counted.append(df) or hot_keys(df, *keys, **options))
        landed = files.stream_table(spark, f"{root}/good", STREAM_ORDERS, format="json")
        pipeline.stream_to_silver(landed, f"{root}/silver{size}", f"{root}/c{size}").awaitTermination()
        monkeypatch.undo()
        facts.append(Counter(files.scan_table(spark, f"{root}/silver{size}/fact_orders").drop("load_id").collect()))
    assert facts[0] == facts[1] and [r.order_id for r in facts[0].elements()].count("A-901") == 1
    assert counted and not any("Aggregate" in df._jdf.queryExecution().optimizedPlan().toString() for df in counted)
