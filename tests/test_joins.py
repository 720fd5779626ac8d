from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.operators import joins
from orderloom.plans.star import Raw, Star


def _left(spark):
    """One key with a third of the rows, and some null keys."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )


def _right(spark):
    return spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_equals_plain(spark, how):
    left, right = _left(spark), _right(spark)
    plain = Counter(left.join(right, "k", how).select("k", "v", "w").collect())
    for hot in (None, joins.hot_keys(left, "k", rows=1), joins.hot_keys(left, "k", rows=200)):
        salted = joins.salted_join(left, right, ["k"], how, hot=hot)
        assert Counter(salted.select("k", "v", "w").collect()) == plain
    by_lookup = joins.lookup_join(left, right, ["k"], how, limit=0, hot=lambda: joins.hot_keys(left, "k", rows=99))
    assert Counter(by_lookup.select("k", "v", "w").collect()) == plain


def test_salted_with_range(spark):
    left, right = _left(spark), _right(spark)
    spans = right.unionAll(right.withColumn("w", F.col("w") + 10)).withColumn("hi", F.col("w") + 5)
    within = F.col("v").between(F.col("w"), F.col("hi"))
    hot = joins.hot_keys(left, "k", rows=100)
    got = joins.salted_join(left, spans, ["k"], "inner", hot, within)
    l, r = left.alias("l"), spans.alias("r")
    expected = l.join(r, (F.col("l.k") == F.col("r.k")) & F.col("v").between(F.col("w"), F.col("hi")))
    assert Counter(got.select("k", "v", "w").collect()) == Counter(expected.select("l.k", "v", "w").collect())


def test_hot_rows_spread(spark):
    """Parts follow the count of each key: the key 7 and the null key hold 1,000 rows or a few more."""
    left = _left(spark)
    hot = joins.hot_keys(left, "k", rows=125)
    parts = {r["_key"]: r["_parts"] for r in hot.collect()}
    assert sorted(parts.values()) == [8, 9]
    assert joins.salted_join(left, _right(spark), ["k"], hot=hot).count() == 3000


def test_every_large_key_is_hot(spark):
    assert joins.hot_keys(_left(spark).union(_left(spark)), "k", rows=1).count() == 1001
    assert joins.hot_keys(_left(spark), "k").isEmpty()


def test_measured_size_covers_texts(spark):
    assert joins.measured_bytes(spark.sql("select 'abc' t, 1 n union all select null, 2")) == 2 * 48 + 3
    assert joins.measured_bytes(spark.sql("select 1 n where false")) == 0


def test_broadcast_only_below_limit(spark):
    left, right = _left(spark), _right(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.lookup_join(left, right, ["k"])
        large = joins.lookup_join(left, right, ["k"], limit=10)
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(small)
        assert "SortMergeJoin" in plan(large) and "SortMergeJoin" not in plan(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_per_key(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", 2), (2, None, 3)], "k int, a string, b int")
    assert sorted(map(tuple, joins.one_per_key(df, ["k"]).collect())) == [(1, "a", 2), (2, None, 3)]


def test_registered_join_broadcasts_few_hot_keys(spark, monkeypatch):
    from orderloom.plans import queries

    asked, plain = [], joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda df, *keys, rows=joins.HOT_ROWS: asked.append(rows) or plain(df, *keys, rows=rows))
    queries.salted_join(spark, "/root/testdata/sf0.001")
    assert asked == [joins.HOT_ROWS]


def test_versions_are_met_once_per_customer_and_day(spark):
    """2,000 versions of one customer and 20,000 of its lines: no join pairs lines with versions."""
    versions = spark.range(2000).selectExpr(
        "'C' cust_id", "date_add(date'2010-01-01', cast(id as int)) valid_from",
        "if(id = 1999, date'9999-12-31', date_add(date'2010-01-01', cast(id as int))) valid_to", "cast(id as string) region")
    lines = spark.range(20_000).selectExpr("'C' cust_id", "date_add(date'2009-12-30', cast(id % 2500 as int)) order_day", "id line")
    placed = joins.version_in_force(lines, versions, ["region"])
    got = {r.line: r.region for r in placed.collect()}
    assert got == {n: str(min(n % 2500 - 2, 1999)) for n in range(20_000) if n % 2500 >= 2}
    # The only customer becomes a constant; the join is on the day alone, without a range.
    joined = [line for line in placed._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joined and all("order_day" in line and "<=" not in line and "valid_to" not in line for line in joined)


def test_hot_products_come_from_written_lines(spark):
    """Lines that are kept tell the hot products; the raw input is not made again."""
    lines = spark.range(30).selectExpr("cast(if(id < 20, 1, id) as int) AS prod_id")
    raw = Raw(orders=None, customers=None, products=None, categories=None, rates=None)
    assert Star(raw, lines=lines).hot_products().collect() == []
    found = joins.hot_keys(lines, "prod_id", rows=9).select("_parts").collect()
    assert [r[0] for r in found] == [3]
