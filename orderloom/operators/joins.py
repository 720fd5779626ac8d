"""Joins that stay balanced: checked broadcast, hot-key salting, point in time."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# A lookup is broadcast only up to this size in memory.
BROADCAST_LIMIT = 32 * 1024 * 1024

# Files hold a table compressed; in memory it is taken to be this much larger.
EXPANSION = 8

# A key with more rows than this is split into parts of about as many.
HOT_ROWS = 1_000_000

# Buckets of key hashes in which rows are counted before keys are.
HASH_BUCKETS = 1 << 16


def estimated_bytes(df: DataFrame) -> int:
    """Size in memory of a frame by the optimizer's estimate, without running anything.

    Fair for a plain scan; over joins the estimate multiplies and only errs upwards.
    """
    return EXPANSION * int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(df: DataFrame) -> int:
    """Size of a written table in memory, from one pass: its texts, and 32 bytes a row and 8 a cell besides."""
    texts = [F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)) for f in df.schema.fields if f.dataType == T.StringType()]
    return sum(df.agg(F.count(F.lit(1)) * (32 + 8 * len(df.columns)), *texts).first())


def hot_keys(df: DataFrame, *keys: str, rows: int = HOT_ROWS) -> DataFrame:
    """Hash and number of parts of every key behind more than `rows` rows.

    Counts over the key columns alone: first of `HASH_BUCKETS` hash buckets, which are few
    wherever the rows are, then of the keys in buckets with more than `rows` rows. If
    there is no such bucket, the second pass does not run. There are
    at most total/`rows` hot keys: a million, or 16 MB, for 10^12 rows.
    """
    bucket = F.pmod("_key", F.lit(HASH_BUCKETS))
    hashed = df.select(F.xxhash64(*keys).alias("_key")).withColumn("_bucket", bucket)
    crowded = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows).select("_bucket")
    counts = hashed.join(F.broadcast(crowded), "_bucket", "left_semi").groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > rows).select("_key", F.ceil(F.col("n") / rows).cast("int").alias("_parts"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    hot: DataFrame | None = None,
    within: Column | None = None,
    spread: list[str] | None = None,
) -> DataFrame:
    """Equi join that splits hot keys of `left` over several tasks; the result is exact.

    Rows of a hot key get a salt from a hash of their `spread` columns (all
    others by default), and only the `right` rows of hot keys are repeated, once
    per part. A hash rather than a random number keeps retried tasks in step.
    `hot` holds key hashes and parts as `hot_keys` gives them and only steers
    the balance: any such frame gives the same rows. Nothing runs before the
    join itself does. `within` is an extra join condition.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"only inner and left joins can be salted, not {how!r}")
    hot = F.broadcast(hot_keys(left, *on) if hot is None else hot)
    spread = spread or [c for c in left.columns if c not in on] or on
    parts = F.coalesce("_parts", F.lit(1))

    def marked(df, salt):
        keyed = df.withColumn("_key", F.xxhash64(*on)).join(hot, "_key", "left")
        return keyed.withColumn("_salt", salt).drop("_key", "_parts")

    left = marked(left, F.pmod(F.xxhash64(*spread), parts).cast("int"))
    right = marked(right, F.explode(F.sequence(F.lit(0), parts - 1)))
    return _equi(left, right, [*on, "_salt"], how, within).drop("_salt")


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    size: int | None = None,
    limit: int = BROADCAST_LIMIT,
    within: Column | None = None,
    reduced: bool = False,
    hot: Callable[[], DataFrame] | None = None,
    **salting,
) -> DataFrame:
    """Join a large frame to a lookup: broadcast up to `limit` bytes, salted beyond it.

    `size` is the measured size of the lookup where the caller has one; the
    optimizer's estimate of the lookup is used otherwise. A left side already
    `reduced` to few rows per key has no hot keys and is joined without salt.
    `hot` finds the hot keys more cheaply than from `left`, for instance in the
    raw input; it is called only when salting may be needed.
    """
    size = estimated_bytes(lookup) if size is None else size
    if size <= limit:
        return _equi(left, F.broadcast(lookup), on, how, within)
    if reduced:
        return _equi(left, lookup, on, how, within)
    return salted_join(left, lookup, on, how, hot() if hot else None, within, **salting)


def _equi(left, right, on, how, within):
    if within is None:
        return left.join(right, on, how)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    match = within
    for c in on:
        match = (F.col(c) == F.col(f"_r_{c}")) & match
    return left.join(renamed, match, how).drop(*[f"_r_{c}" for c in on])


def versions_by_day(days: DataFrame, dim_customer: DataFrame, columns: list[str], day: str = "order_day") -> DataFrame:
    """`columns` of the customer version in force on each (cust_id, day) of `days`, which are distinct.

    Days and version starts are merged in one order per customer and the last
    start is carried forward, so no day meets a version but its own. A customer
    has a row per calendar day and version at most, however many lines it has.
    """
    version = F.struct("valid_to", *columns)
    starts = dim_customer.filter(F.col("cust_id").isNotNull()).select("cust_id", F.col("valid_from").alias("_day"), F.lit(0).alias("_asked"), version.alias("_version"))
    asked = days.filter(F.col("cust_id").isNotNull() & F.col(day).isNotNull()).select("cust_id", F.col(day).alias("_day"), F.lit(1).alias("_asked"))
    order = Window.partitionBy("cust_id").orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    merged = starts.unionByName(asked, allowMissingColumns=True)
    carried = merged.withColumn("_version", F.last("_version", ignorenulls=True).over(order))
    found = carried.filter((F.col("_asked") == 1) & (F.col("_day") <= F.col("_version.valid_to")))
    return found.select("cust_id", F.col("_day").alias(day), *[f"_version.{c}" for c in columns])


def version_in_force(
    left: DataFrame, dim_customer: DataFrame, columns: list[str], day: str = "order_day", **options
) -> DataFrame:
    """Inner join to the customer version valid on `day`.

    Versions are found once per customer and day, then looked up by both, so
    the rows of a busy customer with many versions are not paired with all of them.
    """
    placed = versions_by_day(left.select("cust_id", day).distinct(), dim_customer, columns, day)
    return lookup_join(left, placed, ["cust_id", day], "inner", **options)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the smallest by value, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
