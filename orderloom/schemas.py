"""Fixed column layouts: raw inputs, the star schema and the mart types."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "amount": T.DecimalType(18, 2),
    "money": T.DecimalType(18, 4),
    "rate": T.DecimalType(18, 8),
    "total": T.DecimalType(28, 4),
    "units": T.DecimalType(28, 2),
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name type" pairs; needs no session, so workers can import this."""
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw CSV inputs. Columns bind by position, so header spelling does not matter.
RAW_CUSTOMER = _struct(
    "cust_id string, created_at string, country string, region string, "
    "type string, zip string, active string"
)
RAW_ORDERS = _struct(
    "order_id string, cust_id string, order_date string, prod_id string, "
    "quantity string, status string"
)
RAW_PRODUCT = _struct("prod_id int, cat_id int, prod_name string, price double, currency string")
RAW_CATEGORY = _struct("cat_id int, child string, parent string")

# Raw JSON rates. `conversion` is text so that 0.007 and "0.007" both parse.
RAW_RATES = _struct("date string, currency string, conversion string")

# One order event; every field is text so that 2 and "2" are treated alike.
EVENT = RAW_ORDERS

# Parsed and flagged order lines as kept between cleaning and the fact.
CHECKED_ORDERS = _struct(
    "order_id string, order_date string, prod_id string, quantity string, cust_id string, status string, "
    "order_ts timestamp_ntz, quantity_num double, prod_num int, order_id_norm string, dq_reason string, "
    "rejected boolean"
)

# Columns of a good event as it lands beside the batch order files.
STREAM_ORDERS = _struct(
    "order_id string, cust_id string, order_date string, prod_id int, quantity bigint, status string"
)

# What was delivered of a stream: each source file with its good and bad events.
DELIVERY = _struct("source string, good bigint, bad bigint, source_day date")

DIM_CUSTOMER = _struct(
    "customer_sk string, cust_id string, country string, region string, type string, "
    "zip string, is_active boolean, valid_from date, valid_to date, is_current boolean"
)
DIM_CATEGORY = _struct("cat_id int, category_name string, root_category string")
DIM_PRODUCT = _struct(
    "prod_id int, cat_id int, prod_name string, price double, currency string, "
    "category_name string, root_category string"
)
FACT_ORDERS = _struct(
    "order_id string, cust_id string, prod_id int, cat_id int, root_category string, "
    "order_ts timestamp_ntz, order_day date, quantity double, status string, "
    "is_revenue_status boolean, currency string, conversion double, price double, revenue_usd double"
)
DIM_DATE = _struct(
    "date_key date, year int, quarter int, month int, day int, day_of_week int, is_weekend boolean"
)

# Serving types of the mart: money and quantities become fixed-point on load.
MART_FACT = _struct(
    "order_id string, cust_id string, prod_id int, cat_id int, root_category string, "
    "order_ts timestamp_ntz, order_day date, quantity amount, status string, "
    "is_revenue_status boolean, currency string, conversion rate, "
    "price amount, revenue_usd money"
)
MART_PRODUCT = _struct(
    "prod_id int, cat_id int, prod_name string, price amount, currency string, "
    "category_name string, root_category string"
)

MART_QUARANTINE = _struct(
    "order_id string, cust_id string, prod_id int, status string, dq_reason string, "
    "quantity string, order_date string, prod_id_text string"
)

# Partial results of the metrics: amounts of a day, and the versions they are credited by.
DAY_ACTIVITY = _struct("cust_id string, order_day date, prod_id int, revenue_usd total, priced bigint, sold bigint")
DAY_ORDERS = _struct(
    "order_id string, cust_id string, root_category string, order_day date, is_revenue_status boolean, "
    "revenue_usd total, quantity units"
)
DAY_CREDITS = _struct(
    "order_day date, region string, prod_id int, revenue_usd total, priced bigint, sold bigint, users bigint"
)
VERSION_IN_USE = _struct("cust_id string, region string, valid_from date, valid_to date")

# Rows of raw inputs that no table takes, or takes with nulls: where they came from and why.
INPUT_REJECTS = _struct("dataset string, source string, reason string, record string, copies bigint")

# Natural grain of an order line, used by dedup, the append and the duplicate report.
LINE_KEY = ["order_id", "prod_id", "order_ts", "quantity", "status"]
VERSION_KEY = ["cust_id", "valid_from"]

# Landing datasets, realised statuses, open end of a version.
DATASETS = ["customer", "orders", "product", "prod_cat_tree", "currency_conversion"]
REVENUE_STATUSES = ["paid", "shipped"]
OPEN_END = "9999-12-31"
