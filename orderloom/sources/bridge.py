"""The driver's order tables reshaped into the raw inputs of the pipeline.

Faults are planted by key arithmetic so that every rule has rows to catch.
"""

from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from orderloom.operators.joins import hot_keys, lookup_join
from orderloom.schemas import DATASETS


@lru_cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the files once per session."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


@lru_cache
def _filled_parts(spark: SparkSession, path: str) -> int:
    """Scan partitions of a table that hold rows; a row group, the smallest unit of a scan, is never split."""
    return spark.read.parquet(path).select(F.spark_partition_id().alias("part")).distinct().count()


def spread(lines: DataFrame, path: str, *keys: str) -> DataFrame:
    """`lines` dealt to all cores if the table behind them has fewer filled scan partitions than there are cores.

    Parsing costs far more than reading, so a file of one row group must not
    be parsed by one task. Tables of many row groups are not shuffled.
    """
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines if _filled_parts(lines.sparkSession, path) >= cores else lines.repartition(cores, *keys)


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _slashed(day: str) -> Column:
    return F.concat_ws("/", F.month(day), F.dayofmonth(day), F.year(day))


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"]


def order_lines(
    lineitem: DataFrame, orders: DataFrame, hot: Callable[[], DataFrame] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Raw order lines from a join of the two tables; one key in 41 is sent twice. Columns `keep` of the lines stay."""
    key = "l_orderkey"
    orders = orders.select(F.col("o_orderkey").alias(key), "o_custkey", "o_orderstatus", "o_orderdate")
    status = F.when(F.col("o_orderstatus") == "F", " Paid").when(F.col("o_orderstatus") == "O", "created")
    copies = F.when(_every(key, 41), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    lines = lookup_join(lineitem, orders, [key], "inner", hot=hot).select(
        F.when(_every(key, 97), "bad id").otherwise(F.concat(F.lit("A-"), key)).alias("order_id"),
        F.when(_every(key, 53), "").when(~_every(key, 59), F.col("o_custkey").cast("string")).alias("cust_id"),
        F.when(_every(key, 61), "n/a")
        .otherwise(F.concat(_slashed("o_orderdate"), F.lit(" "), "l_linenumber", F.lit(":05")))
        .alias("order_date"),
        F.when(_every(key, 83), "x").otherwise(F.col("l_partkey").cast("string")).alias("prod_id"),
        F.when(_every(key, 67), "0.1")
        .when(_every(key, 71), "-1")
        .when(_every(key, 73), "x")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        status.otherwise("SHIPPED").alias("status"),
        *keep,
        F.explode(copies).alias("copy"),
    )
    return lines.drop("copy")


def raw_orders(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Raw order lines, of the orders for which `where` holds."""
    lineitem = table(spark, sf_dir, "lineitem").select(LINE_COLUMNS)
    orders = table(spark, sf_dir, "orders").filter(where)
    dealt = spread(lineitem, f"{sf_dir}/lineitem.parquet", "l_orderkey", "l_linenumber")
    return order_lines(dealt, orders, lambda: hot_keys(lineitem, "l_orderkey"))


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notified file per part: encoded key, size and head, with faults of every kind."""
    key = "p_partkey"
    folders = F.array(*[F.lit(name) for name in (*DATASETS, "surprise")])
    folder = F.element_at(folders, (F.col(key) % 6 + 1).cast("int"))
    name = F.concat(F.when(_every(key, 13), "_").otherwise(""), F.url_encode("p_name"), F.lit("-"), key)
    suffix = F.when(_every(key, 5), ".json").otherwise(".csv")
    head = F.when(_every(key, 7), "no header\n1,2").otherwise("a,b\n1,2")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("bronze%2Fraw%2F"), folder, F.lit("%2Fday+1%2F"), name, suffix).alias("key"),
        F.when(_every(key, 11), 0).otherwise(F.col(key) * 10).cast("bigint").alias("size"),
        head.alias("head"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "p_partkey"
    return table(spark, sf_dir, "part").select(
        F.col(key).cast("int").alias("prod_id"),
        (F.col(key) % 25).cast("int").alias("cat_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_retailprice").alias("price"),
        F.when(_every(key, 3), "USD").when(F.col(key) % 3 == 1, "Yen").otherwise(" eur").alias("currency"),
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations below regions below `all`; one region has no parent row."""
    region = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.select(
        F.col("n_nationkey").cast("int").alias("cat_id"),
        F.col("n_name").alias("child"),
        F.col("r_name").alias("parent"),
    ).union(
        region.filter(F.col("r_name") != "MIDDLE EAST").select(
            (F.col("r_regionkey") + 100).cast("int"), "r_name", F.lit("all")
        )
    )


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse rates in three currencies, one per week, counted from all orders."""
    key = "o_orderkey"
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.to_date(F.date_trunc("week", "o_orderdate")).alias("fx_date"),
            F.when(_every(key, 3), "USD").when(F.col(key) % 3 == 1, "YEN").otherwise("EUR").alias("currency"),
        )
        .agg((F.count(F.lit(1)) * 0.5 + 1.0).alias("conversion"))
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version per customer and order year, some sent twice, some with an unreadable day."""
    key = "o_custkey"
    version = (
        table(spark, sf_dir, "orders")
        .groupBy(key, F.year("o_orderdate").alias("y"))
        .agg(F.to_date(F.min("o_orderdate")).alias("since"))
    )
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    copies = F.when(_every(key, 37), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = (
        version.join(table(spark, sf_dir, "customer"), F.col(key) == F.col("c_custkey"))
        .join(nation, (F.col("c_nationkey") + F.col("y")) % 25 == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("copy", F.explode(copies))
    )
    return placed.select(
        F.when(_every(key, 103), " ").otherwise(F.concat(key, F.lit(" "))).alias("cust_id"),
        F.when((F.col(key) + F.col("y")) % 29 == 0, "n/a").otherwise(_slashed("since")).alias("created_at"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("type"),
        (F.col(key) % 90000 + 10000).cast("string").alias("zip"),
        F.when((F.col("y") + F.col("copy")) % 2 == 0, "Y").otherwise("n").alias("active"),
    )


class BridgedRaw:
    """The five raw inputs over one table folder, each opened only when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.source = spark, sf_dir

    @cached_property
    def orders(self) -> DataFrame:
        return raw_orders(*self.source)

    @cached_property
    def customers(self) -> DataFrame:
        return raw_customers(*self.source)

    @cached_property
    def products(self) -> DataFrame:
        return raw_products(*self.source)

    @cached_property
    def categories(self) -> DataFrame:
        return raw_categories(*self.source)

    @cached_property
    def rates(self) -> DataFrame:
        return raw_rates(*self.source)
