"""Exchange rates: exact-day lookup and nearest-prior lookup of order lines.

Every function keeps each line exactly once. Lines need `currency` and
`order_day`; the result gains `conversion`, null where no rate applies.
"""

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.operators.joins import BROADCAST_LIMIT, lookup_join

# In-memory size of one rate row in a hash table, generously rounded up.
ROW_BYTES = 128


def daily_rates(rates: DataFrame) -> DataFrame:
    """One usable rate per currency and day; the largest if a day has several."""
    usable = rates.filter(
        F.col("fx_date").isNotNull() & F.col("currency").isNotNull() & F.col("conversion").isNotNull()
    )
    return usable.groupBy("currency", "fx_date").agg(F.max("conversion").alias("conversion"))


def fx_exact(lines: DataFrame, rates: DataFrame, size: int | None = None, **salting) -> DataFrame:
    """Rate of the very day of the order."""
    exact = daily_rates(rates).withColumnRenamed("fx_date", "order_day")
    return lookup_join(lines, exact, ["currency", "order_day"], size=size, **salting)


def rate_spans(rates: DataFrame) -> DataFrame:
    """Each rate with the day of the currency's next one, null for the latest.

    The window holds one row per day of a currency, so it stays small.
    """
    by_day = Window.partitionBy("currency").orderBy("fx_date")
    return daily_rates(rates).withColumn("next_date", F.lead("fx_date").over(by_day))


def forward_filled(spans: DataFrame) -> DataFrame:
    """A rate for every day from a currency's first to its last known day."""
    last = F.greatest(F.col("fx_date"), F.coalesce(F.date_sub("next_date", 1), F.col("fx_date")))
    return spans.select(
        "currency",
        F.explode(F.sequence("fx_date", last, F.expr("interval 1 day"))).alias("order_day"),
        "conversion",
    )


def latest_rates(spans: DataFrame) -> DataFrame:
    """The open-ended last rate of each currency: one row per currency."""
    return spans.filter(F.col("next_date").isNull()).select(
        "currency", F.col("fx_date").alias("last_day"), F.col("conversion").alias("last_conversion")
    )


def filled_days(rates: DataFrame) -> int:
    """Exact row count of the forward-filled table, from one pass over the rates."""
    usable = rates.filter(F.col("conversion").isNotNull())
    spans = usable.groupBy("currency").agg(
        (F.datediff(F.max("fx_date"), F.min("fx_date")) + 1).cast("bigint").alias("days")
    )
    return spans.agg(F.coalesce(F.sum("days"), F.lit(0))).first()[0]


def _with_latest(joined: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    """Give lines after the last known day their currency's latest rate.

    Currencies are no more than filled days; only where those are too many to
    broadcast are the currencies counted for themselves.
    """
    if size > BROADCAST_LIMIT:
        size = latest_rates(spans).count() * ROW_BYTES
    late = F.when(F.col("order_day") > F.col("last_day"), F.col("last_conversion"))
    return (
        lookup_join(joined, latest_rates(spans), ["currency"], size=size)
        .withColumn("conversion", F.coalesce("conversion", late))
        .drop("last_day", "last_conversion")
    )


def fx_forward_fill(
    lines: DataFrame, rates: DataFrame, size: int | None = None, limit: int = BROADCAST_LIMIT, **salting
) -> DataFrame:
    """Nearest-prior rate through a gap-free daily table and two plain equi joins.

    Days after a currency's last rate come from its latest rate instead of from
    more filled days, so one order dated far ahead cannot inflate the table.
    The filled table is broadcast only if its counted size is within `limit`.
    """
    size = filled_days(rates) * ROW_BYTES if size is None else size
    spans = rate_spans(rates)
    filled = lookup_join(
        lines, forward_filled(spans), ["currency", "order_day"], size=size, limit=limit, **salting
    )
    return _with_latest(filled, spans, size).select(*lines.columns, "conversion")


def fx_asof(
    lines: DataFrame, rates: DataFrame, size: int | None = None, limit: int = BROADCAST_LIMIT, **salting
) -> DataFrame:
    """Nearest-prior rate through rate intervals cut at month ends.

    The hash key is currency and month, the interval a residual test, so a line
    meets at most the rates of one currency in one month and matches one. For
    sparse rates this needs far fewer lookup rows than filling every day.
    """
    size = filled_days(rates) * ROW_BYTES if size is None else size
    spans = rate_spans(rates)
    month_step = F.expr("interval 1 month")
    closed = spans.withColumn("until", F.coalesce(F.date_sub("next_date", 1), F.col("fx_date")))
    pieces = closed.select(
        "currency",
        F.col("fx_date").alias("since"),
        "until",
        "conversion",
        F.explode(F.sequence(F.trunc("fx_date", "month"), F.trunc("until", "month"), month_step)).alias(
            "month"
        ),
    )
    within = F.col("order_day").between(F.col("since"), F.col("until"))
    joined = lookup_join(
        lines.withColumn("month", F.trunc("order_day", "month")),
        pieces,
        ["currency", "month"],
        size=size,
        limit=limit,
        within=within,
        **salting,
    )
    return _with_latest(joined.drop("month", "since", "until"), spans, size).select(
        *lines.columns, "conversion"
    )
