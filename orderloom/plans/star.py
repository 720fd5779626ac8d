"""The star schema as lazy frames: raw inputs in, dimensions and fact out."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from orderloom.operators import dims, fact, fx, joins, orders
from orderloom.operators.load import write_table
from orderloom.sources.storage import work_folder


@dataclass(frozen=True)
class Raw:
    """The five raw inputs."""

    orders: DataFrame
    customers: DataFrame
    products: DataFrame
    categories: DataFrame
    rates: DataFrame


class Star:
    """Frames of the star schema over one set of raw inputs.

    Lines are computed when they are written or collected, and a consumer of a
    few columns makes Spark skip the rest of the chain. The lookups that lines
    are joined to (`categories`, `customers`, `products`, `rates`) are written on first use.
    """

    def __init__(self, raw: Raw, flagged: DataFrame | None = None, lines: DataFrame | None = None):
        """`flagged` and `lines` are the written forms of the flagged and the deduplicated lines, where there are such."""
        self.raw = raw
        self.written = flagged
        self.written_lines = lines

    @cached_property
    def flagged(self) -> DataFrame:
        return orders.flagged_orders(self.raw.orders) if self.written is None else self.written

    @cached_property
    def clean(self) -> DataFrame:
        return orders.good_lines(self.flagged)

    @cached_property
    def quarantine(self) -> DataFrame:
        return orders.rejected_lines(self.flagged)

    @cached_property
    def lines(self) -> DataFrame:
        return orders.dedup_orders(self.clean) if self.written_lines is None else self.written_lines

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.scd2_customer(self.raw.customers)

    @cached_property
    def dim_category(self) -> DataFrame:
        return dims.category_rollup(self.raw.categories)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.raw.products, self.categories, joins.measured_bytes(self.categories))

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        """A lookup written once and read back: its size can then be measured, and plans on it are short."""
        path = f"{work_folder(df.sparkSession, 'star')}/{name}"
        return df.sparkSession.read.schema(df.schema).parquet(write_table(df, path))

    @cached_property
    def categories(self) -> DataFrame:
        return self._kept(self.dim_category, "dim_category")

    @cached_property
    def customers(self) -> DataFrame:
        return self._kept(self.dim_customer, "dim_customer")

    @cached_property
    def products(self) -> DataFrame:
        return self._kept(self.dim_product, "dim_product")

    @cached_property
    def rates(self) -> DataFrame:
        return self._kept(fx.daily_rates(self.raw.rates), "fx_rates")

    @cached_property
    def customer_size(self) -> int:
        return joins.measured_bytes(self.customers)

    @cached_property
    def product_size(self) -> int:
        return joins.measured_bytes(self.products)

    def built(self, *names: str) -> "Star":
        """Lookups written and measured at the same time: each is a chain of small jobs that leaves most cores idle.

        Name no two that need the same lookup.
        """
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(lambda name: getattr(self, name), names))
        return self

    def hot_products(self) -> DataFrame:
        # Written lines are read faster than raw ones are made; either tells how to balance.
        lines = self.raw.orders if self.written_lines is None else self.written_lines
        return joins.hot_keys(lines.select(F.col("prod_id").try_cast("int").alias("prod_id")), "prod_id")

    @cached_property
    def priced(self) -> DataFrame:
        return fact.priced_orders(self.lines, self.products, size=self.product_size, hot=self.hot_products)

    @cached_property
    def fact(self) -> DataFrame:
        self.built("product_size", "rates")
        return fact.fact_orders(self.priced, self.rates)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.clean)
