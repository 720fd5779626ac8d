"""Column rules for order lines, shared by the batch and the stream path.

Everything here is a built-in Column expression, so the same rules run inside
whole-stage codegen on a static frame and on a streaming one.
"""

from pyspark.sql import Column, DataFrame, functions as F

# What counts as surrounding blanks, and the accepted text formats.
BLANKS = " \t\n\r\x0b\x0c"
ORDER_TS_FORMAT = "M/d/yyyy H:mm"
CUSTOMER_DAY_FORMAT = "M/d/yyyy"


def computed_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """Columns `keep` plus new ones that are evaluated exactly once per row.

    A filter on a projected column is pushed below the projection, which
    repeats its expression for every mention in the filter, inside a join
    condition even without generated code. Predicates stay above a generator
    of their columns, so parsing costs are paid once (6x on the cleaning step).
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


# What the mart's decimal(18,2) and the stream's whole number can hold; no cast of a good line can fail.
QUANTITY_LIMIT = 1e16


def strip(text) -> Column:
    """Drop surrounding blanks of every kind, not only spaces."""
    return F.btrim(text, F.lit(BLANKS))


def normal_order_id(text) -> Column:
    """Letters, dash, number padded to three digits and never cut; null if malformed.

    Blanks around it are dropped first, and a digit is demanded before any zero
    is added: `A-` has no number to pad. A number of three digits or more that begins
    with no zero stays as it is.
    """
    bare = strip(text)
    normal = bare.rlike(r"^[A-Za-z]+-[1-9][0-9]{2,}$")
    widened = F.replace(bare, F.lit("-"), F.lit("-000"))
    padded = F.regexp_replace(widened, r"^([A-Za-z]+)-0*([0-9]{3,})$", "$1-$2")
    return F.when(normal, bare).when(bare.rlike(r"^[A-Za-z]+-[0-9]+$"), padded)


def order_timestamp(text: str) -> Column:
    """Wall-clock order time, null if unparseable, whatever the session time zone.

    Parsing as UTC and counting seconds from the epoch keeps the hour that does
    not exist, or exists twice, in zones with daylight saving.
    """
    return F.expr(
        "timestamp_ntz'1970-01-01 00:00:00' + interval '1' second * "
        f"unix_seconds(try_to_timestamp(concat(`{text}`, ' Z'), '{ORDER_TS_FORMAT} X'))"
    )


def number(text: str) -> Column:
    """Decimal text as double; null for words and for suffixes such as 1d."""
    return F.when(F.col(text).rlike(r"^[\s0-9+.eE-]+$"), F.col(text).try_cast("double"))


def dq_reason() -> Column:
    """First rule an order line breaks, or null for a good line.

    Expects the columns of `typed_orders`.
    """
    q = F.col("quantity_num")
    return (
        F.when(F.col("cust_id").isNull() | (F.col("cust_id") == ""), "orphan_customer")
        .when(q.isNull() | (F.abs(q) >= QUANTITY_LIMIT), "bad_quantity")
        .when(q <= 0, "non_positive_quantity")
        .when(q != F.rint(q), "fractional_quantity")
        .when(F.col("order_ts").isNull(), "bad_timestamp")
        .when(F.col("order_id_norm").isNull(), "bad_order_id")
        .when(F.col("prod_num").isNull(), "missing_product")
    )


def order_date_text(ts: str) -> Column:
    """A timestamp back in the raw text format, month and day unpadded; years of other than four digits stay as they are."""
    text = F.col(ts).cast("string")
    day = F.concat_ws("/", F.month(ts), F.dayofmonth(ts), F.substring(text, 1, 4))
    return F.when(F.year(ts).between(0, 9999), F.concat(day, F.lit(" "), F.substring(text, 12, 5))).otherwise(text)
