"""The whole run: raw files to conformed tables to serving tables.

Each table is written once and read back by what builds on it. That cuts the
lineage at durable storage, gives the optimizer true sizes for its join choice,
and means a lost executor never costs more than the table in work.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators import dims, fact, fx, joins, metrics, orders, quality, rejects
from orderloom.operators.load import LOAD, write_table
from orderloom.plans.star import Raw
from orderloom.schemas import CHECKED_ORDERS, LINE_KEY, RAW_CATEGORY, RAW_CUSTOMER, RAW_ORDERS, RAW_PRODUCT
from orderloom.sources import files, landing
from orderloom.sources.storage import kept, publish, published
from orderloom.streaming.sink import land_once, stream_id, write_keys, write_load


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV that keeps blanks and tells empty text from null."""
    (
        df.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_rates(rates: DataFrame, path: str) -> None:
    """One JSON array, and so one file, per year and currency."""
    entry = F.struct(F.col("fx_date").cast("string").alias("date"), "currency", "conversion")
    arrays = rates.groupBy(F.year("fx_date").alias("year"), "currency").agg(
        F.to_json(F.collect_list(entry)).alias("value")
    )
    arrays.select("value", "year", F.col("currency").alias("ccy")).write.partitionBy("year", "ccy").text(path)


def write_bronze(raw: Raw, root: str) -> None:
    """Raw inputs as files in the landing layout."""
    write_csv(raw.orders, f"{root}/orders/day")
    write_csv(raw.customers, f"{root}/customer/day")
    write_csv(raw.products, f"{root}/product/day")
    write_csv(raw.categories, f"{root}/prod_cat_tree/day")
    write_rates(raw.rates, f"{root}/currency_conversion/day")


def read_bronze(spark: SparkSession, root: str, manifest: DataFrame | None = None, bucket: str = "", events: str | None = None) -> Raw:
    """Landed files of the five datasets, and good events of the stream among the orders.

    With `manifest`, whose keys begin at `bucket`, no row of a rejected file is read on.
    """

    def taken(rows: DataFrame) -> DataFrame:
        return rows if manifest is None else landing.accepted_rows(rows, manifest, bucket)

    orders = taken(files.scan_csv(spark, f"{root}/orders", RAW_ORDERS))
    return Raw(
        orders=orders if events is None else unified_orders(orders, files.scan_events(spark, events)),
        customers=taken(files.scan_csv(spark, f"{root}/customer", RAW_CUSTOMER)),
        products=taken(files.scan_csv(spark, f"{root}/product", RAW_PRODUCT)),
        categories=taken(files.scan_csv(spark, f"{root}/prod_cat_tree", RAW_CATEGORY)),
        rates=taken(files.scan_rates(spark, f"{root}/currency_conversion")),
    )


def event_text(events: DataFrame) -> DataFrame:
    """Landed events in the raw layout of batch files, which the shared rules take."""
    text = {"prod_id": F.col("prod_id").cast("string"), "quantity": F.col("quantity").cast("string")}
    return events.withColumns(text).select(*RAW_ORDERS.names)


def unified_orders(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Batch files and landed events as one raw order frame; what only files have stays."""
    origin = [c for c in (files.CORRUPT, "source") if c in batch.columns]
    return batch.select(*RAW_ORDERS.names, *origin).unionByName(event_text(stream), allowMissingColumns=True)


def at_once(*steps: Callable[[], object]) -> None:
    """Run steps that need nothing of each other at the same time: each alone is a chain of jobs that leaves cores idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        list(pool.map(lambda step: step(), steps))


# The load of the silver fact that a batch run writes; streamed slices add loads of their own.
BATCH = "batch"


def bronze_to_silver(
    spark: SparkSession, raw: Raw, silver: str, reject_limit: float | None = None
) -> DataFrame:
    """Write the conformed tables and return their row counts.

    With `reject_limit` the run stops before the fact is built if a larger
    share of order lines was rejected; the quarantine is written by then.
    """
    at = lambda name: f"{silver}/{name}"
    read = lambda name: files.scan_table(spark, at(name))

    orders.write_checked(raw.orders.select(*RAW_ORDERS.names), at("orders_checked"))
    checked = spark.read.schema(CHECKED_ORDERS).parquet(at("orders_checked"))
    write_table(orders.rejected_lines(checked.filter("rejected")), at("orders_quarantine"))
    if reject_limit is not None:
        quality.enforce_gate(checked.select("dq_reason"), reject_limit)

    # Each is read by its table and by several rules of the rejects.
    raw = Raw(raw.orders, kept(raw.customers, "customers"), raw.products, raw.categories, kept(raw.rates, "rates"))

    def products() -> None:
        write_table(dims.category_rollup(raw.categories), at("dim_category"))
        write_table(dims.dim_product(raw.products, read("dim_category")), at("dim_product"))

    at_once(
        lambda: write_table(dims.scd2_customer(raw.customers), at("dim_customer")),
        lambda: write_table(dims.quarantine_customers(raw.customers), at("customer_quarantine")),
        products,
        lambda: write_table(fx.daily_rates(raw.rates), at("fx_rates")),
        lambda: write_table(rejects.input_rejects(raw), at("input_rejects"), "dataset"),
    )

    clean = orders.good_lines(checked.filter("not rejected"))
    priced = fact.priced_orders(
        orders.dedup_orders(clean),
        read("dim_product"),
        size=joins.measured_bytes(read("dim_product")),
        hot=lambda: joins.hot_keys(clean, "prod_id"),
    )
    sold = fact.fact_orders(priced, read("fx_rates")).withColumn(LOAD, F.lit(BATCH))
    write_table(sold, at("fact_orders"), ["order_day", LOAD], ("cust_id",))
    # Its folders, one for each day, are listed once.
    written = read("fact_orders")
    write_keys(written, at("fact_orders"), BATCH, LINE_KEY, "order_day", replace=True)
    names = ["orders_quarantine", "dim_customer", "customer_quarantine", "dim_category", "dim_product", "input_rejects"]
    return quality.stage_counts({"fact_orders": written} | {name: read(name) for name in names})


def stream_to_silver(landed: DataFrame, silver: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start adding landed good events to the silver fact between two batch runs.

    A slice is cleaned by the batch's rules, priced from the tables of the
    last run and held against the fact's days it touches alone, so a line that
    a batch or another slice has brought is not added. Lines that break a rule go to
    `stream_quarantine`. The next batch run reads the same events from the landing.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        load = f"{stream_id(spark, checkpoint)}-{batch_id}"
        flagged = orders.checked_orders(event_text(batch)).persist()
        try:
            products, rates = files.scan_table(spark, f"{silver}/dim_product"), files.scan_table(spark, f"{silver}/fx_rates")
            clean = orders.good_lines(flagged)
            # Counted once from cached lines; of the deduplicated ones each mention would be computed anew.
            priced = fact.priced_orders(
                orders.dedup_orders(clean),
                products,
                size=joins.measured_bytes(products),
                hot=lambda: kept(joins.hot_keys(clean, "prod_id"), "hot_products"),
            )
            write_load(orders.rejected_lines(flagged), f"{silver}/stream_quarantine", load, "dq_reason")
            # Lines are one per key by now, and a line meets one product and one rate at most.
            land_once(kept(fact.fact_orders(priced, rates), "slice"), f"{silver}/fact_orders", load, LINE_KEY, "order_day", unique=True)
        finally:
            flagged.unpersist()

    return (
        landed.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# Serving tables that are those of the silver layer.
SERVED = ("fact_orders", "dim_customer", "dim_product", "dim_category", "orders_quarantine", "input_rejects")


def silver_to_gold(spark: SparkSession, silver: str, gold: str) -> None:
    """Publish the star schema for serving and add the calendar.

    Tables that serving reads as they are are published by reference, so the
    fact is neither copied nor stale between runs.
    """
    for name in SERVED:
        publish(spark, f"{gold}/{name}", f"{silver}/{name}")
    write_table(dims.dim_date(served(spark, gold, "fact_orders")), f"{gold}/dim_date")


def served(spark: SparkSession, gold: str, name: str) -> DataFrame:
    """A serving table, wherever it is kept; loads are no column of it."""
    return files.scan_table(spark, published(spark, f"{gold}/{name}")).drop(LOAD)


def gold_metrics(spark: SparkSession, gold: str, out: str, category: str = "Sweet") -> None:
    """Write the business metrics of the serving tables, one table each.

    `duplicate_orders` is a control: the fact holds a line once, so it has no row.
    """
    read = lambda name: served(spark, gold, name)
    sold, customers, products = read("fact_orders"), read("dim_customer"), read("dim_product")
    found = {
        "dau_by_region": lambda: metrics.dau_by_region(sold, customers),
        "category_conversion": lambda: metrics.category_conversion(sold, category),
        "top_products_by_region": lambda: metrics.top_products_by_region(
            sold, products, customers, product_size=joins.measured_bytes(products)
        ),
        "customer_lifetime_value": lambda: metrics.customer_lifetime_value(sold, customers, joins.measured_bytes(customers)),
        "duplicate_orders": lambda: orders.duplicate_orders(sold),
        "dq_reason_counts": lambda: orders.dq_reason_counts(read("orders_quarantine")),
    }
    at_once(*[lambda name=name, metric=metric: write_table(metric(), f"{out}/{name}") for name, metric in found.items()])
