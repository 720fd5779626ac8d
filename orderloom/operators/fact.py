"""The order fact: priced, converted, flagged lines."""

from pyspark.sql import DataFrame, functions as F

from orderloom.operators.fx import fx_forward_fill
from orderloom.operators.joins import lookup_join
from orderloom.schemas import FACT_ORDERS, REVENUE_STATUSES


def priced_orders(lines: DataFrame, products: DataFrame, size: int | None = None, **salting) -> DataFrame:
    """Deduplicated lines with price, currency, category and root of their product."""
    priced = products.select("prod_id", "cat_id", "root_category", "currency", "price")
    return lookup_join(lines, priced, ["prod_id"], size=size, **salting)


def fact_orders(priced: DataFrame, rates: DataFrame, convert=fx_forward_fill, **options) -> DataFrame:
    """One fact row per priced line, revenue in USD by the rate `convert` finds."""
    converted = convert(priced, rates, **options)
    return converted.withColumns(
        {
            "revenue_usd": F.col("price") * F.col("quantity") * F.col("conversion"),
            "is_revenue_status": F.coalesce(F.col("status").isin(REVENUE_STATUSES), F.lit(False)),
        }
    ).select(*FACT_ORDERS.names)
