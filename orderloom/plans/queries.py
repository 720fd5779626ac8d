"""One query per operator, over the driver's tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderloom.operators import fx, joins, load, metrics, orders, quality, rejects
from orderloom.operators.dims import quarantine_customers
from orderloom.plans import pipeline
from orderloom.plans.star import Raw, Star
from orderloom.schemas import (
    CHECKED_ORDERS,
    DATASETS,
    DELIVERY,
    DIM_CUSTOMER,
    FACT_ORDERS,
    MART_FACT,
    MART_QUARANTINE,
    RAW_ORDERS,
    STREAM_ORDERS,
)
from orderloom.sources import bridge, files, landing
from orderloom.sources.storage import kept, work_folder
from orderloom.streaming import daily, dedup, upsert, validate
from orderloom.streaming.load import stream_incremental_load as start_load, stream_rejects_load
from orderloom.streaming.sink import SOURCE

Query = Callable[[SparkSession, str], DataFrame]

# Root category the conversion query reports on; the tables have regions as roots.
BRIDGE_CATEGORY = "ASIA"
FIRST_LATE_DAY = "1999-01-01"
GATE_LIMIT = 0.25
# Buckets of the fact by order in `order_buckets`; raise them with the table.
ORDER_BUCKETS = 32
# Files of a month before a compaction, and months written by tasks of their own.
SMALL_FILES, MONTHS_APART = 4, 96


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(bridge.BridgedRaw(spark, sf_dir))


# Sources


def scan_csv(spark, sf_dir):
    path = f"{work_folder(spark, 'scan_csv')}/orders"
    pipeline.write_csv(bridge.raw_orders(spark, sf_dir), path)
    return files.scan_csv(spark, path, RAW_ORDERS).select(*RAW_ORDERS.names)


def scan_rates(spark, sf_dir):
    path = f"{work_folder(spark, 'scan_rates')}/currency_conversion"
    pipeline.write_rates(bridge.raw_rates(spark, sf_dir), path)
    return files.scan_rates(spark, path).select("fx_date", "currency", "conversion")


def scan_table(spark, sf_dir):
    path = f"{work_folder(spark, 'scan_table')}/dim_customer"
    load.write_table(star(spark, sf_dir).dim_customer, path)
    return files.scan_table(spark, path)


def landing_scan(spark, sf_dir):
    """Customers of each nation as a file per nation and dataset, some without a header, then listed and judged.

    One row per folder, as names of files differ from run to run; Spark's own hidden files are left out.
    """
    root = work_folder(spark, "landing")
    for number, name in enumerate([*DATASETS, "surprise"]):
        # A nation's lines either all have a comma or none has.
        comma = F.when((F.col("c_nationkey") + number) % 7 == 0, " ").otherwise(",")
        lines = bridge.table(spark, sf_dir, "customer").select("c_nationkey", F.concat("c_custkey", comma, "c_name").alias("value"))
        lines.repartition("c_nationkey").write.partitionBy("c_nationkey").text(f"{root}/bronze/raw/{name}")
    found = landing.landing_manifest(landing.with_heads(landing.list_landed(spark, root)))
    folder = F.element_at(F.split("key", "/"), 4)
    return (
        found.filter(~F.col("key").rlike("/[._][^/]*$"))
        .groupBy("dataset", folder.alias("folder"), "status", "reason")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
    )


def landing_manifest(spark, sf_dir):
    """Notified files, one per part, with encoded keys and faults of every kind."""
    return landing.landing_manifest(landing.landed_keys(bridge.notifications(spark, sf_dir)))


def landing_summary(spark, sf_dir):
    return landing.landing_summary(landing_manifest(spark, sf_dir))


# Tables and loads


def write_table(spark, sf_dir):
    """The fact as one folder per day, sorted by customer within, and read back."""
    path = f"{work_folder(spark, 'write_table')}/fact_orders"
    load.write_table(star(spark, sf_dir).fact, path, "order_day", ("cust_id",))
    return files.scan_table(spark, path)


def order_buckets(spark, sf_dir):
    """Conversion from the fact in buckets by order, whose lines meet without an exchange."""
    path = work_folder(spark, "order_buckets")
    name = f"fact_by_order_{path.rsplit('-', 1)[1]}"
    sold = load.write_buckets(star(spark, sf_dir).fact, name, path, ["order_id"], ORDER_BUCKETS)
    return metrics.category_conversion(sold, BRIDGE_CATEGORY)


def compact_table(spark, sf_dir):
    """Four small files for each order month rewritten as one."""
    root = work_folder(spark, "compact_table")
    lines = star(spark, sf_dir).lines.withColumn("order_month", F.date_format("order_day", "yyyy-MM"))
    # A part of a month goes to a task of its own among many; parts of one month never meet in a task.
    part = F.pmod(F.xxhash64("order_id"), F.lit(SMALL_FILES))
    month = F.pmod(F.year("order_day") * 12 + F.month("order_day"), F.lit(MONTHS_APART))
    dealt = lines.repartitionById(SMALL_FILES * MONTHS_APART, (month * SMALL_FILES + part).cast("int"))
    dealt.write.partitionBy("order_month").parquet(f"{root}/small")
    load.compact_table(spark, f"{root}/small", f"{root}/compact", "order_month")
    return files.scan_table(spark, f"{root}/compact").drop("order_month")


def _late():
    return F.col("order_day") >= FIRST_LATE_DAY


def idempotent_append(spark, sf_dir):
    """All lines delivered again, duplicates included, to a target that holds the early ones."""
    s = star(spark, sf_dir)
    return load.idempotent_append(s.clean, s.lines.filter(~_late()))


def _version_deliveries(versions):
    """Early versions, then later ones together with corrections of early ones."""
    early = F.col("valid_from") < FIRST_LATE_DAY
    resent = (F.length("zip") == 5) & F.col("zip").endswith("7")
    delta = versions.filter(~early | resent).withColumn("zip", F.concat("zip", F.lit("-0")))
    return versions.filter(early), delta


def scd2_merge(spark, sf_dir):
    """Later versions, and earlier ones of some customers again, merged into the early dimension."""
    early, delta = _version_deliveries(star(spark, sf_dir).dim_customer)
    return load.scd2_merge(load.with_validity(early), delta)


# Streams


def events(spark, sf_dir, where="true"):
    """Order lines as a stream of base64 JSON events, some of them broken; only orders for which `where` holds."""
    static = bridge.table(spark, sf_dir, "lineitem")
    lines = files.stream_table(spark, f"{sf_dir}/lineitem.parquet", static.schema, origin=tuple(SOURCE))
    raw = bridge.order_lines(
        bridge.spread(lines.select(*bridge.LINE_COLUMNS, *SOURCE), f"{sf_dir}/lineitem.parquet", "l_orderkey", "l_linenumber"),
        bridge.table(spark, sf_dir, "orders").filter(where),
        lambda: joins.hot_keys(static, "l_orderkey"),
        keep=tuple(SOURCE),
    )
    text = F.to_json(F.struct(*RAW_ORDERS.names))
    broken = F.coalesce(F.col("prod_id").endswith("99"), F.lit(False))
    data = F.base64(F.when(broken, F.concat(text, F.lit(" x"))).otherwise(text))
    return raw.select(data.alias("data"), *SOURCE)


def _validated(spark, sf_dir, where="true"):
    """Good events, dead letters and delivery counters after the whole stream was delivered twice."""
    root = work_folder(spark, "stream_validate")
    out = [f"{root}/{name}" for name in ("good", "bad", "deliveries")]
    for attempt in ("first", "replay"):
        validate.stream_validate(events(spark, sf_dir, where), *out, f"{root}/{attempt}").awaitTermination()
    return out


def stream_validate(spark, sf_dir):
    """Every good event once, equal ones included."""
    good, _, _ = _validated(spark, sf_dir)
    return spark.read.schema(STREAM_ORDERS).json(good).select(*STREAM_ORDERS.names)


def stream_dead_letters(spark, sf_dir):
    """Dead letters and rejected events by reason."""
    _, bad, _ = _validated(spark, sf_dir)
    schema = T.StructType.fromDDL("data string, raw string, copies bigint, dq_reason string")
    letters = spark.read.schema(schema).json(bad)
    return letters.groupBy("dq_reason").agg(
        F.count(F.lit(1)).alias("dead_letters"), F.sum("copies").alias("events")
    )


def stream_counts(spark, sf_dir):
    """Good and bad events of all deliveries."""
    _, _, deliveries = _validated(spark, sf_dir)
    return spark.read.schema(DELIVERY).parquet(deliveries).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def unified_orders(spark, sf_dir):
    """Early lines from batch files; late ones as a stream, added twice to the fact that the batch run has written."""
    root = work_folder(spark, "unified_orders")
    late = f"o_orderdate >= '{FIRST_LATE_DAY}'"
    raw = bridge.BridgedRaw(spark, sf_dir)
    pipeline.write_csv(bridge.raw_orders(spark, sf_dir, f"not ({late})"), f"{root}/csv")
    batch = files.scan_csv(spark, f"{root}/csv", RAW_ORDERS)
    pipeline.bronze_to_silver(spark, Raw(batch, raw.customers, raw.products, raw.categories, raw.rates), f"{root}/silver")
    good, _, _ = _validated(spark, sf_dir, late)
    for attempt in ("first", "replay"):
        landed = files.stream_table(spark, good, STREAM_ORDERS, format="json")
        pipeline.stream_to_silver(landed, f"{root}/silver", f"{root}/{attempt}").awaitTermination()
    return files.scan_table(spark, f"{root}/silver/fact_orders").select("order_id", "cust_id", "prod_id", "order_ts", "order_day", "quantity", "status")


def _landed_files(spark, sf_dir):
    """The five raw inputs as landed files with faulty ones among them, read by their manifest."""
    bucket = work_folder(spark, "landed_files")
    root, raw = f"{bucket}/bronze/raw", bridge.BridgedRaw(spark, sf_dir)
    # Two sets of files hold the lines.
    lines = kept(raw.orders, "lines")
    pipeline.write_bronze(Raw(lines, raw.customers, raw.products, raw.categories, raw.rates), root)
    # Every second line would be a good one, of an order nobody placed.
    line = F.concat_ws(",", F.concat("order_id", F.lit("77")), "cust_id", "order_date", "prod_id", "quantity", "status")
    lines.select(F.concat(F.lit("no header\n"), line).alias("value")).write.text(f"{root}/orders/headless")
    pipeline.write_csv(raw.products.filter("prod_id % 17 = 0").withColumn("price", F.col("price") + 1), f"{root}/product/again")
    short = raw.products.filter("prod_id % 23 = 0").select(F.concat("prod_id", F.lit("x")).alias("prod_id"), "cat_id")
    pipeline.write_csv(short, f"{root}/product/short")
    pipeline.write_csv(raw.categories.filter("cat_id % 5 = 0"), f"{root}/prod_cat_tree/again")
    pipeline.write_rates(raw.rates.filter("currency = 'EUR'").withColumn("conversion", F.lit(0.25)), f"{root}/currency_conversion/again")
    pipeline.write_rates(raw.rates.filter("currency = 'USD'").withColumn("fx_date", F.lit(None).cast("date")), f"{root}/currency_conversion/dayless")
    manifest = landing.landing_manifest(landing.with_heads(landing.list_landed(spark, bucket)))
    return pipeline.read_bronze(spark, root, kept(manifest, "manifest"), bucket)


def bronze_by_manifest(spark, sf_dir):
    """Lines of the accepted files; a headless file leaves none."""
    return orders.dedup_orders(orders.clean_orders(_landed_files(spark, sf_dir).orders))


def input_rejects(spark, sf_dir):
    """What the landed files hold beside the rows that tables take, by dataset and reason."""
    found = rejects.input_rejects(_landed_files(spark, sf_dir))
    return found.groupBy("dataset", "reason").agg(F.sum("copies").alias("copies"))


def stream_incremental_load(spark, sf_dir):
    """Fact files streamed into the mart by day, delivered a second time under a new checkpoint."""
    root = work_folder(spark, "incremental_load")
    landed = star(spark, sf_dir).fact
    load.write_table(landed, f"{root}/landed")
    for attempt in ("first", "replay"):
        source = files.stream_table(spark, f"{root}/landed", landed.schema)
        start_load(source, f"{root}/mart", f"{root}/{attempt}").awaitTermination()
    mart = spark.read.parquet(f"{root}/mart")
    money = ["quantity", "conversion", "price", "revenue_usd"]
    return mart.select(*MART_FACT.names).withColumns({c: F.col(c).cast("double") for c in money})


def _upserted(spark, name, deliveries, start, schema):
    """The table after deliveries streamed in one after the other, and all of them once more under a new checkpoint."""
    root = work_folder(spark, name)
    for number, delivery in enumerate(deliveries):
        delivery.write.mode("append").parquet(f"{root}/landed")
        attempts = ["first"] if number < len(deliveries) - 1 else ["first", "replay"]
        for attempt in attempts:
            source = files.stream_table(spark, f"{root}/landed", delivery.schema, origin=("sent_at",))
            start(source, f"{root}/table", f"{root}/{attempt}").awaitTermination()
    return upsert.read_buckets(spark, f"{root}/table", schema)


def stream_merge(spark, sf_dir):
    """Early versions streamed into the dimension, then later ones and corrections, then all of them again."""
    deliveries = _version_deliveries(star(spark, sf_dir).customers)
    return _upserted(spark, "customer_merge", deliveries, upsert.stream_customer_merge, DIM_CUSTOMER)


def _type_1(spark, name, old, new):
    start = lambda source, table, checkpoint: upsert.stream_upsert(source, name, table, checkpoint)
    return _upserted(spark, name, [old, new], start, upsert.TYPE_1[name][0]).drop("sent_at")


def stream_product_upsert(spark, sf_dir):
    """Products of the mart: all at another price, then as they are."""
    new = star(spark, sf_dir).products
    old = new.withColumns({"price": F.col("price") + 1, "prod_name": F.lit("former")})
    return _type_1(spark, "dim_product", old, new).withColumn("price", F.col("price").cast("double"))


def stream_category_upsert(spark, sf_dir):
    """Categories of the mart: all under another root, then as they are."""
    new = star(spark, sf_dir).categories
    return _type_1(spark, "dim_category", new.withColumn("root_category", F.lit("former")), new)


def stream_date_upsert(spark, sf_dir):
    """The mart's calendar: the first half of the days with a wrong weekday, then all days."""
    new = kept(star(spark, sf_dir).dim_date, "dim_date")
    old = new.filter("day <= 15").withColumn("is_weekend", ~F.col("is_weekend"))
    return _type_1(spark, "dim_date", old, new)


def stream_quarantine_load(spark, sf_dir):
    """Rejected lines streamed into the mart, delivered a second time under a new checkpoint."""
    root = work_folder(spark, "quarantine_load")
    landed = star(spark, sf_dir).quarantine
    landed.write.parquet(f"{root}/landed")
    for attempt in ("first", "replay"):
        source = files.stream_table(spark, f"{root}/landed", landed.schema, origin=tuple(SOURCE))
        stream_rejects_load(source, f"{root}/mart", f"{root}/deliveries", f"{root}/{attempt}").awaitTermination()
    return spark.read.parquet(f"{root}/mart").select(*MART_QUARANTINE.names)


def stream_dedup(spark, sf_dir):
    """Events delivered in duplicate, dropped by id within the watermark."""
    root = work_folder(spark, "stream_dedup")
    schema = bridge.table(spark, sf_dir, "events").schema
    source = files.stream_table(spark, f"{sf_dir}/events.parquet", schema)
    twice = source.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    query = (
        dedup.stream_dedup(twice, ["event_id"], "ts")
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/out")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/out")


# Counts


def stage_counts(spark, sf_dir):
    """Counts over lines and fact written once each, as in the file-to-gold run."""
    path = f"{work_folder(spark, 'stage_counts')}/orders_checked"
    raw = bridge.BridgedRaw(spark, sf_dir)
    orders.write_checked(raw.orders, path)
    flagged = spark.read.schema(CHECKED_ORDERS).parquet(path)
    s = Star(raw, flagged, kept(Star(raw, flagged).lines, "lines")).built("product_size", "customers", "rates")
    return quality.stage_counts(
        {
            "orders_raw": s.flagged,
            "orders_quarantine": s.quarantine,
            "orders_deduped": s.lines,
            "fact_orders": kept(s.fact, "fact_orders"),
            "dim_customer": s.customers,
            "customer_quarantine": quarantine_customers(s.raw.customers),
            "dim_category": s.categories,
            "dim_product": s.products,
            "unknown_customers": quality.unknown_keys(s.lines, s.customers, "cust_id"),
            "unknown_products": quality.unknown_keys(s.lines, s.products, "prod_id"),
        }
    )


def salted_join(spark, sf_dir):
    """Lines priced through the salted path, hot products by `HOT_ROWS`, so that few are broadcast."""
    s = star(spark, sf_dir)
    hot = joins.hot_keys(s.lines, "prod_id")
    prices = s.products.select("prod_id", "price", "currency")
    return joins.salted_join(s.lines, prices, ["prod_id"], hot=hot)


# Of each metric what names a row of it, and its figures.
METRICS = {
    "dau_by_region": (["order_day", "region"], ["daily_active_users"]),
    "category_conversion": ([], ["revenue_usd", "realized_orders", "total_orders", "conversion_rate", "quantity_sold"]),
    "top_products_by_region": (["region", "prod_name"], ["revenue_usd", "rnk"]),
    "customer_lifetime_value": (["cust_id"], ["currently_active", "lifetime_value_usd", "realized_orders"]),
    "duplicate_orders": (["order_id"], ["dup_count"]),
    "dq_reason_counts": (["dq_reason"], ["faulty_count"]),
}


def _figures(name, metric):
    """A metric as one row per figure."""
    keys, numbers = METRICS[name]
    pairs = [F.struct(F.lit(n).alias("figure"), F.col(n).cast("double").alias("value")) for n in numbers]
    item = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    return metric.select(F.lit(name).alias("metric"), item.alias("item"), F.inline(F.array(*pairs)))


def metrics_from_gold(spark, sf_dir):
    """All six metrics as the metrics job finds them in the published serving tables, a row per figure."""
    root = work_folder(spark, "metrics_from_gold")
    pipeline.bronze_to_silver(spark, bridge.BridgedRaw(spark, sf_dir), f"{root}/silver")
    pipeline.silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    pipeline.gold_metrics(spark, f"{root}/gold", f"{root}/metrics", BRIDGE_CATEGORY)

    return reduce(DataFrame.unionByName, [_figures(name, files.scan_table(spark, f"{root}/metrics/{name}")) for name in METRICS])


def metrics_kept_daily(spark, sf_dir):
    """Four metrics from partial results per day, after late lines, corrected customers and a second delivery.

    First come lines of early days, by versions of which the late ones lack and some
    have another region; then no lines but the corrected versions; then the
    other lines, late ones of early days among them; then all files again.
    """
    root = work_folder(spark, "metrics_kept_daily")
    s = star(spark, sf_dir)
    load.write_table(s.fact, f"{root}/lines")
    lines = spark.read.schema(FACT_ORDERS).parquet(f"{root}/lines")
    other = F.when(F.length("zip") == 5, F.concat("region", F.substring("zip", 5, 1))).otherwise(F.col("region"))
    early = s.customers.filter(F.col("valid_from") < FIRST_LATE_DAY).withColumn("region", other)
    former = kept(load.with_validity(early), "former")

    def deliver(attempt, customers):
        source = files.stream_table(spark, f"{root}/landed", FACT_ORDERS, origin=tuple(SOURCE))
        daily.stream_daily_metrics(source, lambda: customers, f"{root}/partial", f"{root}/{attempt}").awaitTermination()

    late = _late() | (F.col("prod_id") % 10 == 0)
    lines.filter(~late).write.parquet(f"{root}/landed")
    deliver("first", former)
    daily.add_load(spark.createDataFrame([], MART_FACT), s.customers, f"{root}/partial", "correction")
    lines.filter(late).write.mode("append").parquet(f"{root}/landed")
    deliver("first", s.customers)
    deliver("replay", s.customers)
    partial = f"{root}/partial"
    found = {
        "dau_by_region": daily.dau_by_region(spark, partial),
        "category_conversion": daily.category_conversion(spark, partial, BRIDGE_CATEGORY),
        "top_products_by_region": daily.top_products_by_region(spark, partial, s.products, product_size=s.product_size),
        "customer_lifetime_value": daily.customer_lifetime_value(spark, partial, s.customers, s.customer_size),
    }
    return reduce(DataFrame.unionByName, [_figures(name, metric) for name, metric in found.items()])


def top_products_by_region(spark, sf_dir):
    s = star(spark, sf_dir).built("product_size", "customer_size", "rates")
    return metrics.top_products_by_region(s.fact, s.products, s.customers, product_size=s.product_size)


def all_queries() -> dict[str, Query]:
    def on_star(build: Callable[[Star], DataFrame], *lookups: str) -> Query:
        return lambda spark, sf_dir: build(star(spark, sf_dir).built(*lookups) if lookups else star(spark, sf_dir))

    all_lookups = ("product_size", "customer_size", "rates")
    product_lookups = ("product_size", "rates")

    return {
        "dau_by_region": on_star(lambda s: metrics.dau_by_region(s.lines, s.customers)),
        "category_conversion": on_star(lambda s: metrics.category_conversion(s.fact, BRIDGE_CATEGORY)),
        "top_products_by_region": top_products_by_region,
        "customer_lifetime_value": on_star(lambda s: metrics.customer_lifetime_value(s.fact, s.customers, s.customer_size), *all_lookups),
        "metrics_from_gold": metrics_from_gold,
        "metrics_kept_daily": metrics_kept_daily,
        "duplicate_orders": on_star(lambda s: orders.duplicate_orders(s.clean)),
        "dq_reason_counts": on_star(lambda s: orders.dq_reason_counts(s.quarantine)),
        "clean_orders": on_star(lambda s: s.clean),
        "quarantine_orders": on_star(lambda s: s.quarantine),
        "dedup_orders": on_star(lambda s: s.lines),
        "scd2_customer": on_star(lambda s: s.dim_customer),
        "quarantine_customers": on_star(lambda s: quarantine_customers(s.raw.customers)),
        "category_rollup": on_star(lambda s: s.dim_category),
        "dim_product": on_star(lambda s: s.dim_product),
        "dim_date": on_star(lambda s: s.dim_date),
        "fx_exact": on_star(lambda s: fx.fx_exact(s.priced, s.rates, joins.measured_bytes(s.rates)), *product_lookups),
        "fx_asof": on_star(lambda s: fx.fx_asof(s.priced, s.rates), *product_lookups),
        "fx_forward_fill": on_star(lambda s: fx.fx_forward_fill(s.priced, s.rates), *product_lookups),
        "fact_orders": on_star(lambda s: s.fact),
        "salted_join": salted_join,
        "idempotent_append": idempotent_append,
        "scd2_merge": scd2_merge,
        "stage_counts": stage_counts,
        "dq_gate": on_star(lambda s: quality.dq_gate(s.flagged, GATE_LIMIT)),
        "scan_csv": scan_csv,
        "scan_rates": scan_rates,
        "scan_table": scan_table,
        "write_table": write_table,
        "order_buckets": order_buckets,
        "compact_table": compact_table,
        "landing_scan": landing_scan,
        "landing_manifest": landing_manifest,
        "landing_summary": landing_summary,
        "stream_validate": stream_validate,
        "stream_dead_letters": stream_dead_letters,
        "stream_counts": stream_counts,
        "unified_orders": unified_orders,
        "stream_incremental_load": stream_incremental_load,
        "bronze_by_manifest": bronze_by_manifest,
        "input_rejects": input_rejects,
        "stream_customer_merge": stream_merge,
        "stream_product_upsert": stream_product_upsert,
        "stream_category_upsert": stream_category_upsert,
        "stream_date_upsert": stream_date_upsert,
        "stream_quarantine_load": stream_quarantine_load,
        "stream_dedup": stream_dedup,
    }
