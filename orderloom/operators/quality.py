"""Row counts per stage and the gate on the share of rejects."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per named stage.

    Over written tables the counts come from the file footers. They are counted
    rather than observed while writing, as a metric gathered by tasks counts a
    stage twice when a lost executor makes it run again.
    """
    counts = [df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows")) for name, df in stages.items()]
    return reduce(DataFrame.unionByName, counts)


def unknown_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values of the facts that the dimension does not know, with their row counts."""
    used = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key).distinct(), key, "left_anti")


def dq_gate(flagged: DataFrame, limit: float) -> DataFrame:
    """Totals, reject share and whether it is within `limit`; one row even for no input."""
    counts = flagged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("dq_reason").isNotNull()).alias("rejected_rows"),
    )
    share = F.coalesce(F.try_divide("rejected_rows", "total_rows"), F.lit(0.0))
    return counts.withColumn("reject_share", F.round(share, 6)).withColumn("passed", share <= limit)


class GateFailed(Exception):
    """More rejects than the gate allows."""


def enforce_gate(flagged: DataFrame, limit: float) -> None:
    """Raise if the reject share is above `limit`."""
    row = dq_gate(flagged, limit).first()
    if not row.passed:
        raise GateFailed(
            f"{row.rejected_rows} of {row.total_rows} lines rejected, share {row.reject_share} > {limit}"
        )
