"""Metrics kept up to date: partial results per order day, to which every load of facts adds.

Below a root are `activity` (customer, day and product) and `orders` (order, customer
and category of a day), to which a load adds its own rows, `credits` (what a
load adds to users and revenue of a day, region and product) and `versions`, the
customer versions by which all credits so far were given. Where a version has
been corrected, a load withdraws what its customers were credited under the old
one and credits it under the new one. Facts that came before are not read again: of their
activity only the months of the load and the customers of changed versions are.

Rows are per day, folders are not: activity has one per month and load, sorted by day, as
parts of it are asked for; the rest is read whole and has one per load.

Figures are fixed-point, so a withdrawal takes back exactly what was credited.
Loads run one after another; a load that is run again replaces its own rows.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators import metrics
from orderloom.operators.joins import versions_by_day
from orderloom.operators.load import LOAD, conform, not_in, write_table
from orderloom.schemas import DAY_ACTIVITY, DAY_CREDITS, DAY_ORDERS, MART_FACT, VERSION_IN_USE
from orderloom.sources import storage
from orderloom.streaming.sink import SOURCE, not_delivered, other_loads, read_folders, stream_id, write_load

CUSTOMER_DAY = ["cust_id", "order_day"]
CREDIT = ["order_day", "region", "prod_id"]
AMOUNTS = ["revenue_usd", "priced", "sold", "users"]
# The folder level of activity: the first day of the month.
MONTH = "order_month"
MONTH_ACTIVITY = T.StructType([*DAY_ACTIVITY.fields, T.StructField(MONTH, T.DateType())])


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    return spark.read.schema(full).parquet(path) if storage.exists(spark, path) else spark.createDataFrame([], full)


def day_activity(fact: DataFrame) -> DataFrame:
    """Realised revenue, lines with revenue and realised lines per customer, day and product; others count as activity."""
    earned = F.when(F.col("is_revenue_status"), F.col("revenue_usd"))
    found = fact.groupBy(*CUSTOMER_DAY, "prod_id").agg(
        F.sum(earned).alias("revenue_usd"), F.count(earned).alias("priced"), F.count_if("is_revenue_status").alias("sold")
    )
    return conform(found, DAY_ACTIVITY)


def day_orders(fact: DataFrame) -> DataFrame:
    """The lines of an order, customer, category, day and status flag as one; the metrics read it as they read lines."""
    found = fact.groupBy("order_id", "cust_id", "root_category", "order_day", "is_revenue_status").agg(
        F.sum("revenue_usd").alias("revenue_usd"), F.sum("quantity").alias("quantity")
    )
    return conform(found, DAY_ORDERS)


def _credits(activity: DataFrame, versions: DataFrame, sign: int, fresh: DataFrame | None = None) -> DataFrame:
    """Revenue and users of `activity` by the region in force, times `sign`; only customers and days of `fresh` count as users."""
    placed = versions_by_day(activity.select(*CUSTOMER_DAY).distinct(), versions, ["region"])
    sales = activity.filter("sold > 0").join(placed, CUSTOMER_DAY).withColumn("users", F.lit(0))
    seen = placed if fresh is None else placed.join(fresh, CUSTOMER_DAY, "left_semi")
    users = seen.groupBy("order_day", "region").agg(F.count(F.lit(1)).alias("users"))
    both = sales.select(*CREDIT, *AMOUNTS).unionByName(users, allowMissingColumns=True)
    return both.groupBy(*CREDIT).agg(*[(F.sum(c) * sign).alias(c) for c in AMOUNTS])


def changed_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Customers with a version that only one side has, with the first and last day of such versions."""
    signed = old.withColumn("side", F.lit(-1)).unionByName(new.withColumn("side", F.lit(1)))
    odd = signed.groupBy(*VERSION_IN_USE.names).agg(F.sum("side").alias("side")).filter("side <> 0")
    return odd.groupBy("cust_id").agg(F.min("valid_from").alias("first_day"), F.max("valid_to").alias("last_day"))


def _moved(activity: DataFrame, changed: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame | None:
    """Credits that take the activity of changed customers from their old regions to their new ones, None if nothing changed."""
    first, last = changed.agg(F.min("first_day"), F.max("last_day")).first()
    if first is None:
        return None
    # The span prunes the folders of months and the days within them, the join the customers.
    months = F.col(MONTH).between(first.replace(day=1), last.replace(day=1))
    within = activity.filter(months & F.col("order_day").between(first, last)).join(changed, "cust_id")
    asked = within.filter(F.col("order_day").between(F.col("first_day"), F.col("last_day"))).select(*DAY_ACTIVITY.names)
    of_changed = lambda versions: versions.join(changed.select("cust_id"), "cust_id", "left_semi")
    return _credits(asked, of_changed(old), -1).unionByName(_credits(asked, of_changed(new), 1))


def add_load(fact: DataFrame, dim_customer: DataFrame, root: str, load: str) -> None:
    """Add fact rows, which no other load has, to the partial results at `root`, and correct these to `dim_customer`.

    `fact` may be empty where only customers changed. The driver sees the months
    of the load and the spans of its days and of those of changed versions alone.
    """
    spark = fact.sparkSession
    new = conform(dim_customer, VERSION_IN_USE)
    storage.make_directory(spark, f"{root}/versions")
    written = [n for n in sorted(storage.names(spark, f"{root}/versions")) if storage.exists(spark, f"{root}/versions/{n}/_SUCCESS")]
    before = [n for n in written if not n.endswith(f"-{load}")]
    # A former attempt may have had other versions than this one has.
    for name in written[len(before):]:
        storage.delete(spark, f"{root}/versions/{name}")
    old = spark.read.schema(VERSION_IN_USE).parquet(f"{root}/versions/{before[-1]}") if before else None

    month = F.trunc("order_day", "month").alias(MONTH)
    write_load(day_activity(fact).select("*", month), f"{root}/activity", load, MONTH, "order_day")
    write_table(day_orders(fact), f"{root}/orders/{LOAD}={load}")
    spans = fact.groupBy(month).agg(F.min("order_day").alias("first"), F.max("order_day").alias("last")).collect()
    there = read_folders(spark, f"{root}/activity", MONTH_ACTIVITY, MONTH, [r[0] for r in spans])
    own = there.filter(F.col(LOAD) == load).select(*DAY_ACTIVITY.names)
    fresh, days = own.select(*CUSTOMER_DAY).distinct(), [d for r in spans for d in r[1:] if d is not None]
    if days:
        others = other_loads(there, load).filter(F.col("order_day").between(min(days), max(days)))
        fresh = not_in(fresh, others, CUSTOMER_DAY)
    credits, moved = _credits(own, new, 1, fresh), None
    if old is not None:
        changed = storage.kept(changed_versions(old, new), "changed_versions")
        moved = _moved(other_loads(_table(spark, f"{root}/activity", MONTH_ACTIVITY), load), changed, old, new)
    if moved is not None:
        both = credits.unionByName(moved).groupBy(*CREDIT).agg(*[F.sum(c).alias(c) for c in AMOUNTS])
        credits = both.filter(" or ".join(f"{c} <> 0" for c in AMOUNTS))
    write_table(conform(credits, DAY_CREDITS), f"{root}/credits/{LOAD}={load}")
    if old is None or moved is not None:
        number = int(before[-1].split("-")[0]) + 1 if before else 1
        write_table(new, f"{root}/versions/{number:012d}-{load}")
        for name in before[:-1]:
            storage.delete(spark, f"{root}/versions/{name}")


def stream_daily_metrics(
    landed: DataFrame, dim_customer: Callable[[], DataFrame], root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start adding landed fact rows (with `source` and `source_day`) to the partial results, each file once.

    `dim_customer` reads the dimension as it is at the time of a batch.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        load = f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id}"
        rows = not_delivered(batch, f"{root}/deliveries", load).persist()
        try:
            add_load(conform(rows, MART_FACT), dim_customer(), root, load)
            counts = rows.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("good"), F.lit(0).cast("bigint").alias("bad"))
            write_load(counts, f"{root}/deliveries", load, "source_day")
        finally:
            rows.unpersist()

    return (
        landed.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def dau_by_region(spark: SparkSession, root: str) -> DataFrame:
    users = _table(spark, f"{root}/credits", DAY_CREDITS).groupBy("order_day", "region").agg(F.sum("users").alias("daily_active_users"))
    return users.filter("daily_active_users > 0").orderBy("order_day", "region")


def top_products_by_region(spark: SparkSession, root: str, dim_product: DataFrame, top: int = 3, product_size: int | None = None) -> DataFrame:
    sums = _table(spark, f"{root}/credits", DAY_CREDITS).groupBy("region", "prod_id").agg(*[F.sum(c).alias(c) for c in AMOUNTS[:3]])
    by_id = sums.filter("sold > 0").select("region", "prod_id", F.when(F.col("priced") > 0, F.col("revenue_usd")).alias("revenue_usd"))
    return metrics.ranked_products(by_id, dim_product, top, product_size)


def category_conversion(spark: SparkSession, root: str, category: str = "Sweet") -> DataFrame:
    return metrics.category_conversion(_table(spark, f"{root}/orders", DAY_ORDERS), category)


def customer_lifetime_value(spark: SparkSession, root: str, dim_customer: DataFrame, size: int | None = None) -> DataFrame:
    return metrics.customer_lifetime_value(_table(spark, f"{root}/orders", DAY_ORDERS), dim_customer, size)
