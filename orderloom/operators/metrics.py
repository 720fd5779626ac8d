"""The business questions asked of the star schema.

Each one reduces the fact on its own keys first and joins dimensions to the
reduced rows, so a customer or product behind a third of all lines is already
collapsed when it meets a join.
"""

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.operators.joins import lookup_join, version_in_force, versions_by_day
from orderloom.sources.storage import kept


def dau_by_region(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Distinct customers per order day and region of the version then in force."""
    active = fact.select("cust_id", "order_day").distinct()
    return (
        versions_by_day(active, dim_customer, ["region"])
        .groupBy("order_day", "region")
        .agg(F.count(F.lit(1)).alias("daily_active_users"))
        .orderBy("order_day", "region")
    )


def category_conversion(fact: DataFrame, category: str = "Sweet") -> DataFrame:
    """Realised revenue, orders, conversion rate and units of one root category.

    Lines reduce to one row per order first, so both distinct counts become
    plain counts and no line is expanded once per distinct.
    """
    realised = F.col("is_revenue_status")
    orders = (
        fact.filter(F.col("root_category") == category)
        .groupBy("order_id")
        .agg(
            F.sum(F.when(realised, F.col("revenue_usd"))).alias("revenue_usd"),
            F.max(F.coalesce(realised, F.lit(False))).alias("realised"),
            F.sum(F.when(realised, F.col("quantity"))).alias("quantity"),
        )
    )
    totals = orders.agg(
        F.sum("revenue_usd").alias("revenue_usd"),
        F.count_if("realised").alias("realized_orders"),
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("quantity_sold"),
    )
    return totals.select(
        F.round("revenue_usd", 4).alias("revenue_usd"),
        "realized_orders",
        "total_orders",
        F.round(F.try_divide("realized_orders", "total_orders"), 4).alias("conversion_rate"),
        "quantity_sold",
    )


def top_products_by_region(
    fact: DataFrame, dim_product: DataFrame, dim_customer: DataFrame, top: int = 3, product_size: int | None = None
) -> DataFrame:
    """Products ranked by realised revenue within each region, ties kept.

    Revenue is summed per customer, day and product first, so a customer's lines
    are few when they meet its region of the day, then per region and
    product id before the name is looked up, then per name, the reported grain.
    """
    sold = fact.filter("is_revenue_status").groupBy("cust_id", "order_day", "prod_id").agg(F.sum("revenue_usd").alias("revenue_usd"))
    # Read twice below, so the lines are summed before.
    placed = version_in_force(kept(sold, "sold"), dim_customer, ["region"], reduced=True)
    by_id = placed.groupBy("region", "prod_id").agg(F.sum("revenue_usd").alias("revenue_usd"))
    return ranked_products(by_id, dim_product, top, product_size)


def ranked_products(by_id: DataFrame, dim_product: DataFrame, top: int = 3, product_size: int | None = None) -> DataFrame:
    """The best products by name within each region, from one revenue per region and product id."""
    names = dim_product.select("prod_id", "prod_name")
    by_name = (
        lookup_join(by_id, names, ["prod_id"], "inner", size=product_size, reduced=True)
        .groupBy("region", "prod_name")
        .agg(F.round(F.sum("revenue_usd"), 4).alias("revenue_usd"))
    )
    best_first = Window.partitionBy("region").orderBy(F.desc_nulls_last("revenue_usd"))
    return (
        by_name.withColumn("rnk", F.rank().over(best_first))
        .filter(F.col("rnk") <= top)
        .select("region", "prod_name", "revenue_usd", "rnk")
        .orderBy("region", "rnk")
    )


def customer_lifetime_value(fact: DataFrame, dim_customer: DataFrame, size: int | None = None) -> DataFrame:
    """Realised revenue and orders per customer with the active flag of the current version.

    The fact is reduced per order, then per customer, before one current
    version is attached, so versions cannot multiply revenue.
    """
    realised = F.col("is_revenue_status")
    orders = fact.groupBy("cust_id", "order_id").agg(
        F.sum(F.when(realised, F.col("revenue_usd"))).alias("revenue_usd"),
        F.max(realised).alias("realised"),
    )
    customers = orders.groupBy("cust_id").agg(
        F.round(F.sum("revenue_usd"), 4).alias("lifetime_value_usd"),
        F.count_if("realised").alias("realized_orders"),
    )
    current = dim_customer.filter("is_current").select(
        "cust_id", F.col("is_active").alias("currently_active")
    )
    return (
        lookup_join(customers, current, ["cust_id"], size=size, reduced=True)
        .select("cust_id", "currently_active", "lifetime_value_usd", "realized_orders")
        .orderBy(F.desc_nulls_last("lifetime_value_usd"))
    )
