"""Order events: decode, validate by the batch rules, route good rows and dead letters."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions import rules
from orderloom.operators.orders import flagged_orders
from orderloom.schemas import EVENT, STREAM_ORDERS
from orderloom.streaming.sink import LOAD, SOURCE, not_delivered, stream_id, write_load


def decode_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Events with their text and fields; `event` is null where decoding failed.

    `data` is base64 of one JSON object. Parsing it as the only element of a
    list is what makes trailing text, a second object or a bare array an error.
    """
    text = F.try_validate_utf8(F.try_to_binary("data", F.lit("base64")).cast("string"))
    boxed = F.from_json(F.concat(F.lit("["), "raw", F.lit("]")), f"array<{EVENT.simpleString()}>")
    keep = ["data", *(keep or [])]
    events = rules.computed_once(events, keep, {"raw": text})
    events = rules.computed_once(events, [*keep, "raw"], {"boxed": boxed})
    only = F.when(F.size("boxed") == 1, F.try_element_at("boxed", F.lit(1)))
    return events.select(*keep, "raw", only.alias("event"))


def validate_events(events: DataFrame) -> DataFrame:
    """Decoded events flagged by the same rules as batch lines, `decode` coming first; other columns stay."""
    other = [c for c in events.columns if c != "data"]
    fields = decode_events(events, other).select(
        "data", *other, "raw", *[F.col(f"event.{c}").alias(c) for c in EVENT.names], F.col("event").isNull().alias("_broken")
    )
    reason = F.when(F.col("_broken"), "decode").otherwise(F.col("dq_reason"))
    return flagged_orders(fields).withColumn("dq_reason", reason).drop("_broken")


def good_columns() -> dict[str, Column]:
    """Fields of an accepted event in the raw order layout, normalised."""
    return {
        "order_id": F.col("order_id_norm"),
        "cust_id": F.col("cust_id"),
        "order_date": rules.order_date_text("order_ts"),
        "prod_id": F.col("prod_num"),
        "quantity": F.col("quantity_num").cast("bigint"),
        "status": F.col("status"),
    }


def routed_events(flagged: DataFrame) -> DataFrame:
    """What both sinks need of a batch and no more: good fields, or the event as it arrived.

    This is the frame worth keeping in memory between the sinks. Rejects are
    few and their fields are read again from `data`.
    """
    good = F.col("dq_reason").isNull()
    fields = good_columns()
    return flagged.select(
        "dq_reason",
        *[c for c in SOURCE if c in flagged.columns],
        F.when(~good, F.col("data")).alias("data"),
        *[F.when(good, column).alias(name) for name, column in fields.items()],
    )


def dead_letters(letters: DataFrame) -> DataFrame:
    """Distinct rejects of a batch with their fields and the number of equal ones."""
    counted = letters.groupBy("data", "dq_reason").agg(F.count(F.lit(1)).alias("copies"))
    events = decode_events(counted, ["dq_reason", "copies"])
    fields = [F.col(f"event.{c}").alias(c) for c in EVENT.names]
    return events.select("data", "raw", *fields, "dq_reason", "copies")


def event_counts(flagged: DataFrame, *by: str) -> DataFrame:
    """Good and bad events, one row for each value of `by`."""
    good = F.col("dq_reason").isNull()
    return flagged.groupBy(*by).agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))


def order_month(order_date: str):
    """Year and month of a raw order date, the folder level of landed events."""
    return F.date_format(F.try_to_date(order_date, rules.ORDER_TS_FORMAT), "yyyy-MM")


def _land(rows: DataFrame, path: str, load: str, column: str) -> None:
    sized = rows.hint("rebalance", column)
    sized.write.mode("overwrite").partitionBy(column).json(f"{path}/{LOAD}={load}")


def stream_validate(
    events: DataFrame,
    good_path: str,
    bad_path: str,
    deliveries: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start routing a stream of events (columns `data`, `source`, `source_day`) to two sinks.

    Every good event lands as a JSON line by month, equal ones included; dead
    letters land by reason with the number of equal events in their batch. Then
    `deliveries` gets the good and bad events of each source file: the counters
    of the batch, and the record that keeps a replayed file out. A batch that
    fails before that record runs again under its checkpoint and overwrites
    its own folders.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        load = f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id}"
        routed = routed_events(validate_events(not_delivered(batch, deliveries, load))).persist()
        try:
            good = routed.filter(F.col("dq_reason").isNull()).select(*STREAM_ORDERS.names)
            _land(good.withColumn("order_month", order_month("order_date")), good_path, load, "order_month")
            _land(dead_letters(routed.filter(F.col("dq_reason").isNotNull())), bad_path, load, "dq_reason")
            write_load(event_counts(routed, *SOURCE), deliveries, load, "source_day")
        finally:
            routed.unpersist()

    return (
        events.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
