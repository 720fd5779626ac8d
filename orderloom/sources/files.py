"""Scans of raw files and written tables, static and streaming."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderloom.schemas import RAW_RATES, STREAM_ORDERS
from orderloom.sources import storage

CORRUPT = "_corrupt_record"

# Where a row came from: its file, the UTC day that file was written on, and when.
ORIGIN = {
    "source": "_metadata.file_path",
    "source_day": "date_from_unix_date(cast(floor(unix_seconds(_metadata.file_modification_time) / 86400) AS int))",
    "sent_at": "_metadata.file_modification_time",
}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with a fixed schema; bad values become null and the row is kept.

    Columns bind by position, and folders below `path` are no columns. The raw
    text of rows that do not fit the schema appears in `_corrupt_record`, their
    file in `source`.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .csv(path)
    )
    return rows.select("*", F.expr(ORIGIN["source"]).alias("source"))


def scan_rates(spark: SparkSession, path: str) -> DataFrame:
    """Daily rates from multi-line JSON files, one task per file, with their text and file."""
    raw = spark.read.schema(RAW_RATES).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return raw.select(
        F.col("date").try_cast("date").alias("fx_date"),
        F.upper(F.trim("currency")).alias("currency"),
        F.col("conversion").try_cast("double").alias("conversion"),
        F.to_json(F.struct(*RAW_RATES.names)).alias("record"),
        F.expr(ORIGIN["source"]).alias("source"),
    )


def scan_events(spark: SparkSession, path: str) -> DataFrame:
    """Good events as `stream_validate` landed them, a folder per load and month."""
    return spark.read.schema(STREAM_ORDERS).option("recursiveFileLookup", True).json(path)


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by this library; partition columns are restored from its folders."""
    return spark.read.parquet(path)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int | None = None,
    origin: tuple[str, ...] = (),
    format: str = "parquet",
) -> DataFrame:
    """Files of a table as a stream, columns matched by name whatever the case.

    `path` is a folder or a single file; each file is read once per checkpoint.
    `origin` names columns of `ORIGIN` to add.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if not storage.is_directory(spark, path):
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    return reader.format(format).load(path).select("*", *[F.expr(ORIGIN[c]).alias(c) for c in origin])
