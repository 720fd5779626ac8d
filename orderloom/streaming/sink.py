"""Replay-safe landing of micro-batches as plain files."""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderloom.operators.joins import one_per_key
from orderloom.operators.load import LOAD, not_in, one_new_per_key, write_table
from orderloom.schemas import DELIVERY
from orderloom.sources import storage

# What tells the deliveries of events apart.
SOURCE = ["source", "source_day"]

# Fixed value: the folder name Spark gives to a null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the streaming query that owns a checkpoint; new with each checkpoint."""
    text = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return json.loads(text)["id"]


def read_folders(spark: SparkSession, path: str, schema: T.StructType, column: str, values: list) -> DataFrame:
    """Rows of the folders `column`=value of a table, with their load.

    One listing of the top level finds the folders that exist; only those are
    opened, so the cost follows the values asked for and not the table.
    """
    storage.make_directory(spark, path)
    wanted = {f"{column}={NO_VALUE if v is None else v}" for v in values}
    found = [f"{path}/{name}" for name in storage.names(spark, path) if name in wanted]
    full = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    if not found:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*found)


def write_load(rows: DataFrame, path: str, load: str, column: str, *sort_by: str) -> None:
    """Rows of one load at `path`/<column>=.../load_id=<load>; a retry replaces its own folders only."""
    write_table(rows.withColumn(LOAD, F.lit(load)), path, [column, LOAD], sort_by, only_touched=True)


def other_loads(rows: DataFrame, load: str) -> DataFrame:
    return rows.filter(~F.col(LOAD).eqNullSafe(load))


def key_hashes(rows: DataFrame, keys: list[str], day: str, *also: str) -> DataFrame:
    """Month and 64-bit hash of every natural key, and columns `also`."""
    return rows.select(*also, F.date_format(day, "yyyy-MM").alias("month"), F.xxhash64(*keys).alias("key_hash"))


def write_hashes(hashes: DataFrame, path: str, load: str, replace: bool = False) -> None:
    """Months and key hashes of one load beside the table at `path`, by month; `replace` drops those of other loads."""
    rows = hashes.select("month", "key_hash").withColumn(LOAD, F.lit(load))
    write_table(rows, f"{path}_keys", ["month", LOAD], only_touched=not replace)


def write_keys(rows: DataFrame, path: str, load: str, keys: list[str], day: str, replace: bool = False) -> None:
    """Key hashes of the rows of one load beside the table at `path`."""
    write_hashes(key_hashes(rows, keys, day), path, load, replace)


def marked_hashes(batch: DataFrame, path: str, load: str, keys: list[str], day: str) -> DataFrame:
    """Day, month and key hash of the rows of a batch, `held` where another load has recorded the hash and null elsewhere."""
    own = key_hashes(batch, keys, day, day)
    if not storage.exists(batch.sparkSession, f"{path}_keys"):
        return own.withColumn("held", F.lit(None).cast("boolean"))
    months = [r[0] for r in own.select("month").distinct().collect()]
    schema = T.StructType([T.StructField("month", T.StringType()), T.StructField("key_hash", T.LongType())])
    held = other_loads(read_folders(batch.sparkSession, f"{path}_keys", schema, "month", months), load)
    return own.join(held.select("key_hash", F.lit(True).alias("held")), "key_hash", "left")


def _known_days(batch: DataFrame, path: str, load: str, keys: list[str], day: str, marked: DataFrame | None = None) -> list:
    """Days of the batch on which another load may hold one of its keys.

    All days where the table has no key hashes. Equal hashes only ask for a
    closer look at the day; the list is bounded by the calendar.
    """
    if not storage.exists(batch.sparkSession, f"{path}_keys"):
        return [r[0] for r in batch.select(day).distinct().collect()]
    marked = marked_hashes(batch, path, load, keys, day) if marked is None else marked
    return [r[0] for r in marked.filter("held").select(day).distinct().collect()]


def land_once(batch: DataFrame, path: str, load: str, keys: list[str], partition_by: str, unique: bool = False) -> None:
    """Write one row per key of a batch, without the keys that another load holds.

    A retried batch overwrites its own folders; a replay under a new checkpoint
    has another load id and is caught by the comparison of keys, as are keys that a
    compaction has moved. Hashes of the keys landed so far, kept by month
    beside the table, tell which of the batch's days may hold one of its keys;
    only those days are read for it. The hashes of a load are written before
    its rows, so rows without a hash do not exist; a hash that another load has recorded
    is not recorded again. `unique` says that the batch has no key twice.

    Only the last step needs more of the batch than its keys and day, so a batch that is
    read from files is better not cached.
    """
    spark = batch.sparkSession
    if not storage.exists(spark, path):
        # No load has brought a row yet.
        known, marked = [], marked_hashes(batch, path, load, keys, partition_by)
        write_hashes(marked, path, load)
    else:
        marked = marked_hashes(batch, path, load, keys, partition_by).persist()
        try:
            known = _known_days(batch, path, load, keys, partition_by, marked)
            write_hashes(marked.filter("held is null"), path, load)
        finally:
            marked.unpersist()
    if known:
        target = other_loads(read_folders(spark, path, batch.schema, partition_by, known), load)
        fresh = not_in(batch, target, keys) if unique else one_new_per_key(batch, target, keys)
    else:
        fresh = batch if unique else one_per_key(batch, keys)
    write_load(fresh, path, load, partition_by)


def not_delivered(batch: DataFrame, deliveries: str, load: str) -> DataFrame:
    """Events of a batch whose source file no other load has delivered.

    A file source hands a file over whole in one batch, so the file is the
    identity of its events: equal events stay, a replayed file goes. Only the
    records of the days these files were written on are read.

    Every question to a batch computes all that the stream does before it, so its
    files are found in one pass and kept; without any record none is needed.
    """
    storage.make_directory(batch.sparkSession, deliveries)
    if not any(n.startswith("source_day=") for n in storage.names(batch.sparkSession, deliveries)):
        return batch
    sent = storage.kept(batch.select(*SOURCE).distinct(), "sent_files")
    days = [r[0] for r in sent.select("source_day").distinct().collect()]
    known = other_loads(read_folders(batch.sparkSession, deliveries, DELIVERY, "source_day", days), load)
    replayed = known.select("source").join(sent.select("source"), "source", "left_semi").distinct()
    if replayed.isEmpty():
        return batch
    # An empty batch is landed too, so that a retry leaves nothing of a former attempt.
    fresh = sent.join(replayed, "source", "left_anti")
    return batch.limit(0) if fresh.isEmpty() else batch.join(replayed, "source", "left_anti")
