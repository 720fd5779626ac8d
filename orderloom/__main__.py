"""Command line of the jobs: spark-submit orderloom/__main__.py <job> ... or python -m orderloom."""

import argparse

from pyspark.sql import SparkSession, types as T

from orderloom.operators.load import compact_table
from orderloom.plans import pipeline
from orderloom.schemas import DIM_CATEGORY, DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, FACT_ORDERS, MART_QUARANTINE, STREAM_ORDERS
from orderloom.sources import files, landing
from orderloom.streaming import daily, upsert
from orderloom.streaming.load import stream_incremental_load, stream_rejects_load
from orderloom.streaming.validate import stream_validate

EVERY_MINUTE = {"processingTime": "1 minute"}


def session(app: str) -> SparkSession:
    """A session in UTC; cluster size, shuffle partitions and checkpoint folder are the submitter's."""
    return SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def bronze_to_silver(spark, args):
    """With --manifest, of check-landing over --bucket, rejected files are left out; --events adds landed good events."""
    manifest = files.scan_table(spark, args.manifest) if args.manifest else None
    raw = pipeline.read_bronze(spark, args.bronze, manifest, args.bucket, args.events)
    pipeline.bronze_to_silver(spark, raw, args.silver, args.reject_limit).show(truncate=False)


def stream_to_silver(spark, args):
    landed = files.stream_table(spark, args.events, STREAM_ORDERS, args.files_per_trigger, format="json")
    pipeline.stream_to_silver(landed, args.silver, args.checkpoint, EVERY_MINUTE).awaitTermination()


def silver_to_gold(spark, args):
    pipeline.silver_to_gold(spark, args.silver, args.gold)


def metrics(spark, args):
    pipeline.gold_metrics(spark, args.gold, args.out, args.category)


def check_landing(spark, args):
    manifest = landing.landing_manifest(landing.with_heads(landing.list_landed(spark, args.root)))
    manifest.write.mode("overwrite").partitionBy("status").parquet(args.manifest)
    landing.landing_summary(spark.read.parquet(args.manifest)).show(truncate=False)


def validate_stream(spark, args):
    """Events are Parquet files with one base64 payload per row in `data`."""
    data = T.StructType([T.StructField("data", T.StringType())])
    events = files.stream_table(spark, args.events, data, args.files_per_trigger, ("source", "source_day"))
    stream_validate(events, args.good, args.bad, args.deliveries, args.checkpoint, EVERY_MINUTE).awaitTermination()


def load_facts(spark, args):
    landed = files.stream_table(spark, args.landed, FACT_ORDERS, args.files_per_trigger)
    stream_incremental_load(landed, args.mart, args.checkpoint, trigger=EVERY_MINUTE).awaitTermination()


def update_metrics(spark, args):
    """Partial metrics at `partial`, kept up to date with landed fact files and the dimension table at `customers`."""
    landed = files.stream_table(spark, args.landed, FACT_ORDERS, args.files_per_trigger, ("source", "source_day"))
    customers = lambda: upsert.read_buckets(spark, args.customers, DIM_CUSTOMER)
    daily.stream_daily_metrics(landed, customers, args.partial, args.checkpoint, EVERY_MINUTE).awaitTermination()


def load_customers(spark, args):
    landed = files.stream_table(spark, args.landed, DIM_CUSTOMER, args.files_per_trigger, ("sent_at",))
    upsert.stream_customer_merge(landed, args.table, args.checkpoint, EVERY_MINUTE, args.buckets).awaitTermination()


def _load_type_1(name, schema):
    def load(spark, args):
        landed = files.stream_table(spark, args.landed, schema, args.files_per_trigger, ("sent_at",))
        upsert.stream_upsert(landed, name, args.table, args.checkpoint, EVERY_MINUTE, args.buckets).awaitTermination()

    return load


def load_quarantine(spark, args):
    landed = files.stream_table(spark, args.landed, MART_QUARANTINE, args.files_per_trigger, ("source", "source_day"))
    stream_rejects_load(landed, args.mart, args.deliveries, args.checkpoint, EVERY_MINUTE).awaitTermination()


def compact(spark, args):
    compact_table(spark, args.table, args.new_table, args.partition_by)


def main() -> None:
    parser = argparse.ArgumentParser(prog="orderloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(run, *names, name=None):
        sub = jobs.add_parser(name or run.__name__.replace("_", "-"))
        for argument in names:
            sub.add_argument(argument)
        sub.set_defaults(run=run)
        return sub

    sub = job(bronze_to_silver, "bronze", "silver")
    sub.add_argument("--reject-limit", type=float)
    sub.add_argument("--manifest")
    sub.add_argument("--bucket", default="")
    sub.add_argument("--events")
    job(silver_to_gold, "silver", "gold")
    job(metrics, "gold", "out").add_argument("--category", default="Sweet")
    job(check_landing, "root", "manifest")
    for run, names in (
        (validate_stream, ("events", "good", "bad", "deliveries", "checkpoint")),
        (stream_to_silver, ("events", "silver", "checkpoint")),
        (load_facts, ("landed", "mart", "checkpoint")),
        (update_metrics, ("landed", "customers", "partial", "checkpoint")),
        (load_quarantine, ("landed", "mart", "deliveries", "checkpoint")),
    ):
        job(run, *names).add_argument("--files-per-trigger", type=int)
    dimensions = {
        "load-customers": load_customers,
        "load-products": _load_type_1("dim_product", DIM_PRODUCT),
        "load-categories": _load_type_1("dim_category", DIM_CATEGORY),
        "load-dates": _load_type_1("dim_date", DIM_DATE),
    }
    for name, run in dimensions.items():
        sub = job(run, "landed", "table", "checkpoint", name=name)
        sub.add_argument("--files-per-trigger", type=int)
        sub.add_argument("--buckets", type=int, default=upsert.BUCKETS)
    sub = job(compact, "table", "new_table")
    sub.add_argument("--partition-by", default="order_day")
    args = parser.parse_args()
    args.run(session(f"orderloom-{args.job}"), args)


if __name__ == "__main__":
    main()
