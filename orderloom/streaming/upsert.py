"""Tables kept by key in buckets: a batch rewrites the buckets its keys fall into and no others.

A table is two folders. `rows/bucket=<b>/version=<v>` holds all rows of bucket b
as of version v; `versions/version=<v>` lists the version of every bucket. A batch
writes the merged buckets first and the list last, so a reader that takes the
newest complete list never sees half a batch, and a batch that fails in
between is written again under the same version. Lists beyond the last
`READABLE` and the bucket versions that only they name are deleted.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators.load import conform, scd2_merge, write_table
from orderloom.schemas import DIM_CATEGORY, DIM_CUSTOMER, DIM_DATE, MART_PRODUCT
from orderloom.sources import storage

# Buckets of a new table; choose them so that a bucket is about a file.
BUCKETS = 64

# Versions a reader may still hold.
READABLE = 2

# When a row was sent; the row sent last wins.
SENT = "sent_at"

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _complete(spark: SparkSession, table: str) -> list[str]:
    """Lists of bucket versions that were written to their end, oldest first."""
    storage.make_directory(spark, f"{table}/versions")
    return [n for n in sorted(storage.names(spark, f"{table}/versions")) if storage.exists(spark, f"{table}/versions/{n}/_SUCCESS")]


def _listed(spark: SparkSession, table: str, name: str) -> dict[int, int]:
    """Version of every bucket; there are no more rows than buckets."""
    rows = spark.read.schema("bucket int, version long").json(f"{table}/versions/{name}").collect()
    return {r.bucket: r.version for r in rows}


def _folder(table: str, bucket: int, version: int) -> str:
    return f"{table}/rows/bucket={bucket}/version={version}"


def _rows_of(spark: SparkSession, table: str, schema: T.StructType, listed: dict[int, int]) -> DataFrame:
    folders = [_folder(table, b, v) for b, v in listed.items()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_buckets(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Rows of the newest complete version of a table."""
    complete = _complete(spark, table)
    return _rows_of(spark, table, schema, _listed(spark, table, complete[-1]) if complete else {})


def merge_batch(delta: DataFrame, table: str, schema: T.StructType, keys: list[str], merge: Merge, buckets: int = BUCKETS) -> None:
    """Merge `delta` into the buckets that its keys fall into.

    `merge` gets all rows of those buckets and the batch, and has to give the
    same again if a batch is merged twice. Driver and listings see numbers of buckets alone.
    """
    spark = delta.sparkSession
    complete = _complete(spark, table)
    current = _listed(spark, table, complete[-1]) if complete else {}
    touched = [r[0] for r in delta.select(bucket_of(keys, buckets)).distinct().collect()]
    if not touched:
        return
    version = int(complete[-1].rsplit("=", 1)[1]) + 1 if complete else 1
    target = _rows_of(spark, table, schema, {b: current[b] for b in touched if b in current})
    merged = merge(target, delta).withColumns({"bucket": bucket_of(keys, buckets), "version": F.lit(version)})
    write_table(merged, f"{table}/rows", ["bucket", "version"], only_touched=True)
    listed = sorted((current | dict.fromkeys(touched, version)).items())
    rows = spark.createDataFrame(listed, "bucket int, version long").coalesce(1)
    rows.write.mode("overwrite").json(f"{table}/versions/version={version:012d}")
    _expire(spark, table)


def _expire(spark: SparkSession, table: str) -> None:
    complete = _complete(spark, table)
    old, readable = complete[:-READABLE], complete[-READABLE:]
    named = {pair for name in readable for pair in _listed(spark, table, name).items()}
    for name in old:
        for bucket, version in set(_listed(spark, table, name).items()) - named:
            storage.delete(spark, _folder(table, bucket, version))
        storage.delete(spark, f"{table}/versions/{name}")


def newest_by(keys: list[str]) -> Merge:
    """Merge that keeps the row sent last of every key, the greatest by value among several sent at once."""

    def merge(target: DataFrame, delta: DataFrame) -> DataFrame:
        rest = [SENT, *[c for c in target.columns if c not in (*keys, SENT)]]
        both = target.unionByName(delta.select(*target.columns))
        last = both.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
        return last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in target.columns])

    return merge


def _with_sent(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(SENT, T.TimestampType())])


# Type 1 dimensions of the mart: layout with the time sent, and key.
TYPE_1 = {
    "dim_product": (_with_sent(MART_PRODUCT), ["prod_id"]),
    "dim_category": (_with_sent(DIM_CATEGORY), ["cat_id"]),
    "dim_date": (_with_sent(DIM_DATE), ["date_key"]),
}


def _streamed(landed: DataFrame, each: Callable[[DataFrame], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            each(rows)
        finally:
            rows.unpersist()

    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_upsert(landed: DataFrame, name: str, table: str, checkpoint: str, trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Start merging landed rows, with `sent_at`, into the Type 1 dimension `name`.

    The time a row was sent is kept with it, so a file that arrives late does
    not undo a newer one, and a second delivery changes nothing.
    """
    schema, keys = TYPE_1[name]
    return _streamed(landed, lambda batch: merge_batch(conform(batch, schema), table, schema, keys, newest_by(keys), buckets), checkpoint, trigger)


def stream_customer_merge(landed: DataFrame, table: str, checkpoint: str, trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Start merging landed customer versions into the dimension, bucketed by customer.

    All versions of a customer are in one bucket, so their chain of validity is
    closed within it. Where `landed` has `sent_at`, the row sent last wins among
    several of one version in a batch.
    """

    def merge(batch: DataFrame) -> None:
        newest = SENT if SENT in batch.columns else None
        schema = T.StructType([*DIM_CUSTOMER.fields, *[batch.schema[c] for c in [newest] if c]])
        merge_batch(conform(batch, schema), table, DIM_CUSTOMER, ["cust_id"], lambda target, delta: scd2_merge(target, delta, newest), buckets)

    return _streamed(landed, merge, checkpoint, trigger)
