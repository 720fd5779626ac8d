"""Redelivered events within a bounded time, dropped while the stream runs."""

from pyspark.sql import DataFrame, functions as F


def stream_dedup(events: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """First event per key, remembered only until the watermark passes `delay`.

    The state holds keys of the last `delay` and not of all time. Copies
    further apart are left to the anti join of the load.
    """
    return (
        events.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, delay)
        .dropDuplicatesWithinWatermark(keys)
    )
