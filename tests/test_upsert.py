"""Tables kept by key in buckets."""

import datetime as dt
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from orderloom.sources.files import stream_table
from orderloom.sources.storage import work_folder
from orderloom.streaming import upsert

SCHEMA, KEYS = upsert.TYPE_1["dim_category"]


def _rows(spark, ids, name, hour):
    sent = dt.datetime(2024, 1, 1, hour)
    return spark.createDataFrame([(i, name, name, sent) for i in ids], SCHEMA)


def _files(table):
    return {str(p): p.stat().st_mtime_ns for p in Path(table).glob("rows/*/*/*.parquet")}


def _merge(delta, table):
    upsert.merge_batch(delta, table, SCHEMA, KEYS, upsert.newest_by(KEYS), buckets=16)


def _names(spark, table):
    return {r.cat_id: r.category_name for r in upsert.read_buckets(spark, table, SCHEMA).collect()}


def test_only_touched_buckets_are_written(spark):
    table = f"{work_folder(spark, 'test')}/t"
    _merge(_rows(spark, range(200), "a", 1), table)
    before = _files(table)
    assert len({Path(p).parents[1] for p in before}) == 16
    _merge(_rows(spark, [5], "b", 2), table)
    after = _files(table)
    # The bucket of key 5 has one more version; nothing else was touched.
    assert {p: after[p] for p in before} == before and len({Path(p).parents[0] for p in after}) == 17
    assert _names(spark, table) == {i: "b" if i == 5 else "a" for i in range(200)}


def test_old_versions_go_and_readable_ones_stay(spark):
    table = f"{work_folder(spark, 'test')}/t"
    for hour in range(6):
        _merge(_rows(spark, range(hour, hour + 3), f"v{hour}", hour), table)
    folders = {(p.parents[1].name, p.parents[0].name) for p in map(Path, _files(table))}
    per_bucket = Counter(b for b, _ in folders)
    assert max(per_bucket.values()) <= upsert.READABLE + 1
    assert len(list(Path(table).glob("versions/version=*"))) == upsert.READABLE
    assert _names(spark, table) == {0: "v0", 1: "v1", 2: "v2", 3: "v3", 4: "v4", 5: "v5", 6: "v5", 7: "v5"}


def test_a_late_older_row_does_not_undo_a_newer_one(spark):
    table = f"{work_folder(spark, 'test')}/t"
    _merge(_rows(spark, [1, 2], "new", 5), table)
    _merge(_rows(spark, [1, 3], "old", 4), table)
    assert _names(spark, table) == {1: "new", 2: "new", 3: "old"}


def test_an_unfinished_batch_is_written_again(spark):
    table = f"{work_folder(spark, 'test')}/t"
    _merge(_rows(spark, range(20), "a", 1), table)
    _merge(_rows(spark, [1], "b", 2), table)
    newest = max(Path(table).glob("versions/version=*"))
    (newest / "_SUCCESS").unlink()
    assert _names(spark, table)[1] == "a"
    _merge(_rows(spark, [1], "b", 2), table)
    assert _names(spark, table)[1] == "b" and len(_names(spark, table)) == 20


def test_nulls_empty_batches_and_streams(spark):
    root = work_folder(spark, "test")
    assert upsert.read_buckets(spark, f"{root}/t", SCHEMA).count() == 0
    _merge(_rows(spark, [], "a", 1), f"{root}/t")
    _merge(_rows(spark, [None, 1, 1], "a", 1).withColumn("sent_at", F.lit(None).cast("timestamp")), f"{root}/t")
    assert _names(spark, f"{root}/t") == {None: "a", 1: "a"}
    _rows(spark, [1, 2], "b", 1).drop("sent_at").write.parquet(f"{root}/in")
    source = stream_table(spark, f"{root}/in", SCHEMA, origin=()).drop("sent_at").withColumn("sent_at", F.current_timestamp())
    upsert.stream_upsert(source, "dim_category", f"{root}/t", f"{root}/c", buckets=16).awaitTermination()
    assert _names(spark, f"{root}/t") == {None: "a", 1: "b", 2: "b"}
