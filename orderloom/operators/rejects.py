"""What the raw inputs hold beside the rows that tables take: where it came from and why.

Every reject is (dataset, source, reason, record, copies): `source` is the file,
null for inputs that are no files, `record` the row as text and `copies` how many
equal rows of that file it stands for.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.operators.dims import customer_faults
from orderloom.schemas import INPUT_REJECTS, RAW_CATEGORY, RAW_CUSTOMER, RAW_ORDERS, RAW_PRODUCT
from orderloom.sources.files import CORRUPT


def _source(raw: DataFrame) -> Column:
    return F.col("source") if "source" in raw.columns else F.lit(None).cast("string").alias("source")


def _counted(rows: DataFrame, dataset: str) -> DataFrame:
    """(source, reason, record) rows of a dataset, equal ones together."""
    counts = rows.groupBy("source", "reason", "record").agg(F.count(F.lit(1)).alias("copies"))
    return counts.select(F.lit(dataset).alias("dataset"), "source", "reason", "record", "copies")


def corrupt_rows(raw: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    """Rows that did not fit their schema. They stay in their dataset, with nulls where a value could not be read."""
    # Whether a row fits is told of the columns that are read, so the record asks for all.
    record = F.coalesce(CORRUPT, F.to_json(F.struct(*columns)))
    found = raw.filter(F.col(CORRUPT).isNotNull())
    return _counted(found.select(_source(raw), F.lit("corrupt_record").alias("reason"), record.alias("record")), dataset)


def surplus_rows(raw: DataFrame, dataset: str, reason: str, keys: list[str], order: list[Column], record: Column) -> DataFrame:
    """Rows with a key that a row earlier by `order` has taken; rows without a key are none.

    Equal rows are counted first, so only different rows of a key are ordered.
    """
    keyed = raw.select(*keys, *[c.alias(f"_{i}") for i, c in enumerate(order)], record.alias("record"), _source(raw))
    keyed = keyed.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    groups = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[f"_{i}" for i in range(len(order))], "record", "source"))
    copies = F.col("n") - F.when(place == 1, 1).otherwise(0)
    left = groups.withColumn("copies", copies).filter("copies > 0")
    # The order may tell rows apart that are equal as text.
    counts = left.groupBy("source", "record").agg(F.sum("copies").alias("copies"))
    return counts.select(F.lit(dataset).alias("dataset"), "source", F.lit(reason).alias("reason"), "record", "copies")


def _text(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def input_rejects(raw) -> DataFrame:
    """Rejects of all five raw inputs but for order lines that broke a rule, which have a quarantine of their own.

    Corrupt rows; products, categories, customer versions and rates beyond the
    one that its key keeps; customers without an id or a readable day; rates
    without a day, currency or number.
    """
    layouts = {"orders": RAW_ORDERS, "customer": RAW_CUSTOMER, "product": RAW_PRODUCT, "prod_cat_tree": RAW_CATEGORY}
    inputs = {"orders": raw.orders, "customer": raw.customers, "product": raw.products, "prod_cat_tree": raw.categories}
    found = [corrupt_rows(df, name, layouts[name].names) for name, df in inputs.items() if CORRUPT in df.columns]

    products = raw.products.select("*", F.trim("prod_name").alias("_name"), F.upper(F.trim("currency")).alias("_currency"))
    found.append(surplus_rows(products, "product", "duplicate_product", ["prod_id"], [F.col(c) for c in ("cat_id", "_name", "price", "_currency")], _text(RAW_PRODUCT.names)))
    found.append(surplus_rows(raw.categories, "prod_cat_tree", "duplicate_category", ["cat_id"], [F.trim("child"), F.nullif(F.trim("parent"), F.lit(""))], _text(RAW_CATEGORY.names)))

    customers = customer_faults(raw.customers)
    bad = customers.filter(F.col("reason").isNotNull()).select(_source(customers), "reason", _text(RAW_CUSTOMER.names).alias("record"))
    found.append(_counted(bad, "customer"))
    versions = customers.filter(F.col("reason").isNull())
    rank = [~F.coalesce("_active", F.lit(False)), *[F.col(c) for c in ("country", "_region", "_type", "zip")]]
    found.append(surplus_rows(versions, "customer", "superseded_version", ["_cust_id", "_valid_from"], rank, _text(RAW_CUSTOMER.names)))

    usable = F.col("fx_date").isNotNull() & F.col("currency").isNotNull() & F.col("conversion").isNotNull()
    text = F.col("record") if "record" in raw.rates.columns else _text(["fx_date", "currency", "conversion"])
    rates = raw.rates.withColumn("record", text)
    found.append(_counted(rates.filter(~usable).select(_source(rates), F.lit("unusable_rate").alias("reason"), "record"), "currency_conversion"))
    found.append(surplus_rows(rates.filter(usable), "currency_conversion", "duplicate_rate", ["currency", "fx_date"], [-F.col("conversion")], F.col("record")))
    return reduce(DataFrame.unionByName, found).select(*INPUT_REJECTS.names)
