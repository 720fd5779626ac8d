"""Small helpers that several operators of this package share."""

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orderloom.sources.storage import work_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_BREAK = r"[\x20\x09-\x0D]+"


# Digits, letters a-z after folding A-Z, and all that is not ASCII make words.
_KEPT = frozenset(range(0x30, 0x3A)) | frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
FOLD = bytes(b if b in _KEPT else 0x20 for b in bytes(range(256)).lower())


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8."""
    return text.encode().translate(FOLD).split() if text else []


def crc_fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def hashed_sample(rows: DataFrame, label: str, per_label: int) -> list:
    """About `per_label` rows of each label by a hash of doc_id, the only rows that reach the driver.

    Equal rows count once, and a label gives 1.5 * per_label rows at most, so a
    doc_id that repeats in many rows does not bring them all.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    share = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / (1 << 20)
    keep = F.lit(False)
    for value, n in counts.items():
        keep = F.when(F.col(label) == value, share < 1.2 * per_label / n).otherwise(keep)
    picked = rows.filter(keep).distinct().withColumn("_at", share)
    # A limit of ranks is applied by every task before the shuffle.
    place = F.row_number().over(Window.partitionBy(label).orderBy("_at", "doc_id", F.xxhash64(*rows.columns)))
    bounded = picked.withColumn("_place", place).filter(F.col("_place") <= per_label * 3 // 2).drop("_place")
    return bounded.orderBy("_at", "doc_id", label).collect()


def groups(texts: Iterable[str | None], rows: int, characters: int) -> Iterator[list[str | None]]:
    """Consecutive texts in groups of at most `rows` and `characters`; a longer text is a group of its own."""
    group, size = [], 0
    for text in texts:
        if group and (len(group) == rows or size + len(text or "") > characters):
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text or "")
    if group:
        yield group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """`df` written below the shared folder and read back: lineage ends at files every executor sees."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, also where `body` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def unwrapped(df: DataFrame) -> DataFrame:
    return df.select("_doc.*")
