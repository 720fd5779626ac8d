"""Order lines: cleaning, reject split and exact duplicate removal."""

from pyspark.sql import DataFrame, functions as F

from orderloom.functions import rules
from orderloom.schemas import LINE_KEY


def typed_orders(raw: DataFrame) -> DataFrame:
    """Raw text columns plus their typed and normalised forms, each parsed once."""
    typed = {
        "cust_id": rules.strip("cust_id"),
        "status": F.lower(rules.strip("status")),
        "order_ts": rules.order_timestamp("order_date"),
        "quantity_num": rules.number("quantity"),
        "prod_num": F.col("prod_id").try_cast("int"),
        "order_id_norm": rules.normal_order_id(F.col("order_id")),
    }
    return rules.computed_once(raw, [c for c in raw.columns if c not in typed], typed)


def flagged_orders(raw: DataFrame) -> DataFrame:
    """Typed lines with the first broken rule in `dq_reason`, null for good lines."""
    return typed_orders(raw).withColumn("dq_reason", rules.dq_reason())


def good_lines(flagged: DataFrame) -> DataFrame:
    """Lines that broke no rule, in the shape of the fact's own columns."""
    return flagged.filter(F.col("dq_reason").isNull()).select(
        F.col("order_id_norm").alias("order_id"),
        "cust_id",
        F.col("prod_num").alias("prod_id"),
        "order_ts",
        F.to_date("order_ts").alias("order_day"),
        F.col("quantity_num").alias("quantity"),
        "status",
    )


def rejected_lines(flagged: DataFrame) -> DataFrame:
    """Lines that broke a rule, with their raw text and the reason."""
    return flagged.filter(F.col("dq_reason").isNotNull()).select(
        "order_id",
        "cust_id",
        F.col("prod_num").alias("prod_id"),
        "status",
        "dq_reason",
        "quantity",
        "order_date",
        F.col("prod_id").alias("prod_id_text"),
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    return good_lines(flagged_orders(raw))


def quarantine_orders(raw: DataFrame) -> DataFrame:
    return rejected_lines(flagged_orders(raw))


def checked_orders(raw: DataFrame) -> DataFrame:
    """Flagged lines that keep their raw text only if they are rejected."""
    rejected = F.col("dq_reason").isNotNull()
    text = {c: F.when(rejected, F.col(c)) for c in ("order_id", "order_date", "prod_id", "quantity")}
    return flagged_orders(raw).withColumns({**text, "rejected": rejected})


def write_checked(raw: DataFrame, path: str) -> None:
    """Parse and flag raw lines once and keep them, good and rejected in folders of their own.

    Everything later reads this table, so raw text is parsed a single time.
    Good lines keep no raw text.
    """
    checked_orders(raw).write.mode("overwrite").partitionBy("rejected").parquet(path)


def dedup_orders(clean: DataFrame) -> DataFrame:
    """One line per natural key; of copies with different customers the smallest id stays.

    The day follows from the timestamp and the customer is the only other
    column, so this is a single aggregate that already collapses copies before
    the shuffle: one line repeated a billion times sends one row per task. A
    minimum of text sorts its input; a hash aggregate of whole lines before it
    was measured to cost more than it saves (1.2 against 0.7 s for 600,000 lines).
    """
    lines = clean.groupBy(*LINE_KEY).agg(F.min("cust_id").alias("cust_id"))
    return lines.withColumn("order_day", F.to_date("order_ts")).select(*clean.columns)


def duplicate_orders(clean: DataFrame) -> DataFrame:
    """Natural keys seen more than once, most repeated first."""
    return (
        clean.groupBy(*LINE_KEY)
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .filter(F.col("dup_count") > 1)
        .orderBy(F.desc_nulls_last("dup_count"))
    )


def dq_reason_counts(quarantine: DataFrame) -> DataFrame:
    """Rejected lines by reason, most frequent first."""
    return (
        quarantine.groupBy("dq_reason")
        .agg(F.count(F.lit(1)).alias("faulty_count"))
        .orderBy(F.desc_nulls_last("faulty_count"))
    )
