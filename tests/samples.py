"""Hand rows that exercise every rule."""

from orderloom.schemas import RAW_CATEGORY, RAW_CUSTOMER, RAW_ORDERS, RAW_PRODUCT

DAY = "1/5/2024 9:05"

# (raw order row, expected reason)
ORDERS = [
    (("A-005", "C1", DAY, "1", "2", "paid"), None),
    (("A-005", "C1", DAY, "1", "2", "paid"), None),
    (("A-005", "C1", DAY, "1", "2", "paid"), None),
    (("A-005", "C1", DAY, "2", "2", "paid"), None),
    (("A-21", None, DAY, "1", "1", "paid"), "orphan_customer"),
    (("A-22", " \t", DAY, "1", "1", "paid"), "orphan_customer"),
    (("A-013", "C1", DAY, "1", "0.1", "paid"), "fractional_quantity"),
    (("A-30", "C1", DAY, "1", "abc", "paid"), "bad_quantity"),
    (("A-30", "C1", DAY, "1", "1d", "paid"), "bad_quantity"),
    (("A-30", "C1", DAY, "1", "NaN", "paid"), "bad_quantity"),
    (("A-30", "C1", DAY, "1", "1e999", "paid"), "bad_quantity"),
    (("A-30", "C1", DAY, "1", "-1e999", "paid"), "bad_quantity"),
    (("A-30", "C1", DAY, "1", "", "paid"), "bad_quantity"),
    (("A-30", "C1", DAY, "1", None, "paid"), "bad_quantity"),
    (("A-31", "C1", DAY, "1", "0", "paid"), "non_positive_quantity"),
    (("A-31", "C1", DAY, "1", "-1", "paid"), "non_positive_quantity"),
    (("A-32", "C1", "13/45/2024 9:05", "1", "1", "paid"), "bad_timestamp"),
    (("A-32", "C1", "2/30/2024 9:05", "1", "1", "paid"), "bad_timestamp"),
    (("A-32", "C1", "1/5/24 9:05", "1", "1", "paid"), "bad_timestamp"),
    (("A-32", "C1", None, "1", "1", "paid"), "bad_timestamp"),
    (("A-12B", "C1", DAY, "1", "1", "paid"), "bad_order_id"),
    (("bad id", "C1", DAY, "1", "1", "paid"), "bad_order_id"),
    (("A-", "C1", DAY, "1", "1", "paid"), "bad_order_id"),
    (("-021", "C1", DAY, "1", "1", "paid"), "bad_order_id"),
    ((None, "C1", DAY, "1", "1", "paid"), "bad_order_id"),
    (("A-33", "C1", DAY, None, "1", "paid"), "missing_product"),
    (("A-33", "C1", DAY, "x", "1", "paid"), "missing_product"),
    (("A-30", None, "bad", "1", "abc", "paid"), "orphan_customer"),
    (("A-7", " C1 ", "01/05/2024 09:05", "1", "1", " Shipped "), None),
    (("A-1234", "C1", DAY, "1", "3", "paid"), None),
    ((" A-00021 ", "C1", DAY, "1", " 4 ", "paid"), None),
    (("A-40", "C1", DAY, "1", "1", "created"), None),
    (("A-40", "C1", DAY, "1", "1", "cancelled"), None),
    (("A-41", "C1", "12/31/2023 9:05", "2", "1", "paid"), None),
    (("A-41", "C1", "12/31/2023 9:05", "2", "2", "paid"), None),
    (("A-42", "C9", DAY, "99", "1e2", None), None),
]

CUSTOMERS = [
    ("C1", "1/1/2024", "US", " East ", "Retail", "10001", "Y"),
    ("C1", "3/1/2024", "US", "West", "Retail", "10001", "N"),
    ("C2", "1/1/2024", "US", "East", None, "10002", None),
    ("C3", "1/1/2024", "US", "East", "Retail", "10003", "N"),
    ("C3", "1/1/2024", "US", "East", "Retail", "10003", " y"),
    ("C4", "not a date", "US", "East", "Retail", "10004", "Y"),
    (" ", "1/1/2024", "US", "East", "Retail", "10005", "Y"),
    (None, "1/1/2024", "US", "East", "Retail", "10006", "Y"),
]

CATEGORIES = [
    (1, "Sweet", "all"),
    (2, "chocolate", "Sweet"),
    (3, "candy", " chocolate "),
    (4, "crisp", "salt"),
    (5, "chip", "salt"),
    (6, "alone", None),
    (8, "x", "y"),
    (9, "y", "x"),
]

PRODUCTS = [
    (1, 2, " bar ", 10.0, "Yen"),
    (2, 4, "crisps", 2.0, " usd"),
    (3, 77, "stray", 1.0, "YEN"),
    (1, 2, " bar ", 10.0, "Yen"),
]

RATES = [
    ("2024-01-01", "YEN", 0.0070),
    ("2024-01-03", "yen ", 0.0080),
    ("2024-01-03", "YEN", 0.0060),
    ("2024-01-02", "YEN", None),
    (None, "YEN", 9.0),
    ("2024-01-01", "USD", 1.0),
]


def raw_orders(spark):
    return spark.createDataFrame([row for row, _ in ORDERS], RAW_ORDERS)


def raw_customers(spark):
    return spark.createDataFrame(CUSTOMERS, RAW_CUSTOMER)


def raw_categories(spark):
    return spark.createDataFrame(CATEGORIES, RAW_CATEGORY)


def raw_products(spark):
    return spark.createDataFrame(PRODUCTS, RAW_PRODUCT)


def rates(spark):
    from pyspark.sql import functions as F

    text = spark.createDataFrame(RATES, "d string, c string, conversion double")
    return text.select(
        F.to_date("d").alias("fx_date"), F.upper(F.trim("c")).alias("currency"), "conversion"
    )
