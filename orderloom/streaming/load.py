"""Incremental appends: new fact files and new rejects into the mart."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators.load import conform
from orderloom.schemas import LINE_KEY, MART_FACT, MART_QUARANTINE
from orderloom.streaming.sink import SOURCE, land_once, not_delivered, stream_id, write_load


def stream_incremental_load(
    landed: DataFrame,
    target: str,
    checkpoint: str,
    partition_by: str = "order_day",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start appending landed fact rows to the mart table, each natural key once.

    Delivery is at least once; keys within a batch are made unique, keys of
    earlier loads are left out, and a retried batch overwrites
    its own folder. `trigger` is one minute in service, available-now in tests.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        load = f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id}"
        land_once(conform(batch, MART_FACT), target, load, LINE_KEY, partition_by)

    return (
        landed.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_rejects_load(landed: DataFrame, target: str, deliveries: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start appending landed reject rows (with `source` and `source_day`) to the mart's quarantine, each file once.

    Rejects have no key and equal ones count, so the file is what tells a second delivery.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        load = f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id}"
        rows = not_delivered(batch, deliveries, load).persist()
        try:
            write_load(conform(rows, MART_QUARANTINE), target, load, "dq_reason")
            counts = rows.groupBy(*SOURCE).agg(F.lit(0).cast("bigint").alias("good"), F.count(F.lit(1)).alias("bad"))
            write_load(counts, deliveries, load, "source_day")
        finally:
            rows.unpersist()

    return (
        landed.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
