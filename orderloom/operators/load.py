"""Writing tables and loading increments into them."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderloom.operators.dims import with_validity
from orderloom.operators.joins import one_per_key
from orderloom.schemas import DIM_CUSTOMER, LINE_KEY, VERSION_KEY
from orderloom.sources import storage

# The folder level that tells the loads of a table apart.
LOAD = "load_id"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` picked by name, whatever the case, and cast to its types; null where a type cannot hold a value."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    sort_by: tuple[str, ...] = (),
    only_touched: bool = False,
) -> str:
    """Create or replace a Parquet table, optionally one folder per `partition_by` value.

    The rebalance gathers each folder's rows into well-sized files and splits a
    folder that holds much of the data over several tasks; sorting inside a
    task tightens the row-group statistics. With `only_touched`, folders
    absent from `df` keep their content, which makes day-wise reruns safe.
    """
    folders = [partition_by] if isinstance(partition_by, str) else partition_by or []
    if folders:
        df = df.hint("rebalance", *folders).sortWithinPartitions(*folders, *sort_by)
    writer = df.write.mode("overwrite")
    if folders:
        writer = writer.partitionBy(*folders)
        writer = writer.option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    writer.parquet(path)
    return path


def write_buckets(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Create or replace the catalog table `table`, kept at `path` in `buckets` by `keys`, and read it.

    Grouping and joining by `keys` then needs no exchange. A bucket is read by one
    task, so no value of `keys` may hold much of the table. Rows are gathered by
    bucket first, else every task would write a file for each.
    """
    gathered = df.repartition(buckets, *keys)
    gathered.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def compact_table(
    spark: SparkSession, path: str, new_path: str, partition_by: str = "order_day"
) -> str:
    """Rewrite a table of many small files to a new path; the caller then switches over.

    The loads of a streamed table become one load, in the same folder levels,
    so the stream goes on at the new path and still finds what it has landed,
    by the key hashes that move along.
    """
    rows = spark.read.parquet(path)
    if LOAD not in rows.columns:
        return write_table(rows, new_path, partition_by)
    if storage.exists(spark, f"{path}_keys"):
        hashes = spark.read.parquet(f"{path}_keys").withColumn(LOAD, F.lit("compacted"))
        write_table(hashes, f"{new_path}_keys", ["month", LOAD])
    return write_table(rows.withColumn(LOAD, F.lit("compacted")), new_path, [partition_by, LOAD])


def not_in(delta: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `delta` whose keys do not occur in `target`, nulls matching nulls."""
    known = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    return delta.join(known, match, "left_anti")


def one_new_per_key(delta: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of `delta` that does not occur in `target`, the smallest by value, nulls matching nulls.

    Both sides meet in one aggregate, so rows are shuffled once, copies collapsed before.
    """
    rest = [c for c in delta.columns if c not in keys]
    rows = delta.select(*keys, F.struct(*rest or [F.lit(0).alias("_none")]).alias("_row"), F.lit(False).alias("_held"))
    held = target.select(*keys, F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.lit(True).alias("_held"))
    merged = rows.unionByName(held).groupBy(*keys).agg(F.min("_row").alias("_row"), F.max("_held").alias("_held"))
    return merged.filter(~F.col("_held")).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in delta.columns])


def idempotent_append(delta: DataFrame, target: DataFrame, keys: list[str] = LINE_KEY) -> DataFrame:
    """Rows to append: one per new key of `delta`, so a second delivery adds nothing."""
    return not_in(one_per_key(delta, keys), target, keys)


def scd2_merge(
    target: DataFrame, delta: DataFrame, newest: str | None = None, rechain: bool = True
) -> DataFrame:
    """Customer versions after an upsert of `delta` on customer and start day.

    Rows are merged by one aggregate over both inputs: a delta row replaces the
    attributes of its version but not its surrogate key, and unmatched rows of
    either side stay. Among delta rows of one key the greatest by `newest` wins,
    then the greatest by value. `rechain` then closes the version before a
    newly inserted one even when the delta did not send it again.
    """
    attributes = [c for c in DIM_CUSTOMER.names if c not in VERSION_KEY and c != "customer_sk"]
    first = [newest] if newest else []
    # A matched key has to be told from a target row, so absent rows stay null structs.
    sent = F.struct(*first, *attributes, "customer_sk")
    kept = F.struct(*attributes, "customer_sk")
    null_kept = F.lit(None).cast(target.select(kept.alias("r")).schema["r"].dataType)
    null_sent = F.lit(None).cast(delta.select(sent.alias("r")).schema["r"].dataType)
    both = target.select(*VERSION_KEY, kept.alias("old"), null_sent.alias("new")).unionByName(
        delta.select(*VERSION_KEY, null_kept.alias("old"), sent.alias("new"))
    )
    merged = both.groupBy(*VERSION_KEY).agg(F.max("old").alias("old"), F.max("new").alias("new"))
    picked = merged.select(
        F.coalesce("old.customer_sk", "new.customer_sk").alias("customer_sk"),
        *VERSION_KEY,
        *[
            F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            for c in attributes
        ],
    )
    return (with_validity(picked) if rechain else picked).select(*DIM_CUSTOMER.names)
