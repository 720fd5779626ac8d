"""Landed files: listing, header check and accept or reject by rule.

Folders are listed and file heads read inside tasks, so neither the number of
files nor their size passes through the driver.
"""

import codecs
import itertools
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.operators.joins import lookup_join, measured_bytes
from orderloom.schemas import DATASETS
from orderloom.sources import storage

# Bytes read at a time from the head of a file, and rows per frame of a listing.
CHUNK = 4096
LISTED = 10_000

# Fixed value: what ends a line.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# What a URI has before the path or authority.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*:)?/*"

# Ship the task functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ENTRY = "path string, size bigint, is_dir boolean"


def _open(uri: str):
    """Filesystem and path behind a URI or a plain local path."""
    if uri.startswith(("s3a:", "s3n:")):
        uri = "s3" + uri[3:]
    return fs.FileSystem.from_uri(uri)


def _entries(uri: str) -> Iterator[tuple[str, int, bool]]:
    """Entries directly below a folder."""
    system, path = _open(uri)
    base, cut = uri.rstrip("/"), len(path.rstrip("/")) + 1
    for info in system.get_file_info(fs.FileSelector(path)):
        yield f"{base}/{info.path[cut:]}", info.size or 0, info.type == fs.FileType.Directory


def _below(uri: str) -> Iterator[tuple[str, int, bool]]:
    """All files below a folder; no more than one folder's entries and the names of folders to come are held."""
    waiting = [uri]
    while waiting:
        for path, size, is_dir in _entries(waiting.pop()):
            if is_dir:
                waiting.append(path)
            else:
                yield path, size, False


def _list_step(to_the_end: bool):
    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size, is_dir in batch.itertuples(index=False):
                rows = [(path, size, False)] if not is_dir else _below(path) if to_the_end else _entries(path)
                for some in itertools.batched(rows, LISTED):
                    yield pd.DataFrame(some, columns=["path", "size", "is_dir"])

    return step


def list_landed(spark: SparkSession, root: str) -> DataFrame:
    """Files below `root` as (path, key, size), key being the path after `root`.

    `root` is the bucket level: keys read bronze/raw/<dataset>/<partition>/file.
    One folder level at a time is fanned out; a task then walks each folder of
    the last one. Hidden names are listed too, so that the manifest can tell of them.
    """
    root = root.rstrip("/")
    # One row needs one task, and no Python workers beside its own.
    level = spark.createDataFrame([(root, 0, True)], _ENTRY).coalesce(1)
    for depth in range(5):
        level = level.mapInPandas(_list_step(to_the_end=depth == 4), _ENTRY)
        if depth in (2, 3):
            # A number keeps adaptive execution from merging the folders into one task.
            level = level.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    files = level.filter(~F.col("is_dir"))
    return files.select("path", F.substr("path", F.lit(len(root) + 2)).alias("key"), "size")


def landed_keys(notifications: DataFrame) -> DataFrame:
    """Decode the keys of object-created notifications (key, size)."""
    return notifications.withColumn("key", F.try_url_decode("key"))


def _head(system, name: str) -> str:
    """Start of a file up to its first comma or line end; a chunk with neither is not kept."""
    decode = codecs.getincrementaldecoder("utf-8")("ignore").decode
    with system.open_input_stream(name) as stream:
        while chunk := stream.read(CHUNK):
            text = decode(chunk)
            if "," in text or re.search(LINE_END, text):
                return text
    return ""


def _read_heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        heads = []
        for path, size, key in zip(batch["path"], batch["size"], batch["key"]):
            if size == 0 or key.endswith(".json"):
                heads.append(None)
                continue
            system, name = _open(path)
            heads.append(_head(system, name))
        yield batch.assign(head=heads)


def with_heads(files: DataFrame) -> DataFrame:
    """Add the head of every non-empty file that is not JSON, read in tasks."""
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInPandas(_read_heads, "path string, key string, size bigint, head string")


def landing_manifest(files: DataFrame, datasets: list[str] = DATASETS) -> DataFrame:
    """Each landed file with its dataset, accepted or rejected, and the reason.

    Needs `key`, `size` and `head`; the first rule that fails gives the reason.
    """
    dataset = F.coalesce(F.try_element_at(F.split("key", "/"), F.lit(3)), F.lit(""))
    first_line = F.element_at(F.split(F.coalesce("head", F.lit("")), LINE_END), 1)
    headless = ~F.col("key").endswith(".json") & ~first_line.contains(",")
    reason = (
        F.when(~F.col("dataset").isin(datasets), F.concat(F.lit("unexpected_dataset:"), "dataset"))
        .when(F.exists(F.split("key", "/"), lambda part: part.rlike("^[_.]")), "hidden_name")
        .when(F.col("size") == 0, "empty_file")
        .when(headless, "missing_or_malformed_header")
    )
    return (
        files.withColumn("dataset", dataset)
        .withColumn("reason", reason)
        .select(
            "key",
            "dataset",
            "size",
            F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("status"),
            "reason",
        )
    )


def accepted_rows(rows: DataFrame, manifest: DataFrame, root: str) -> DataFrame:
    """Rows of files that `manifest` does not reject; `source` is the URI of their file, `root` the folder its keys begin at.

    The manifest's rejected keys are looked up by file, so a list of files never
    passes through the driver. All rows of a file share its key, hence the checked
    broadcast, and salt beyond it.
    """
    rejected = manifest.filter(F.col("status") == "rejected").select(F.col("key").alias("_key"), F.lit(True).alias("_rejected")).distinct()
    # A URI has blanks and the like encoded, a key does not; a plus sign stands for itself in both.
    path = F.try_url_decode(F.replace("source", F.lit("+"), F.lit("%2B")))
    above = re.sub(SCHEME, "", storage.qualified(rows.sparkSession, root)).rstrip("/")
    key = F.substr(F.regexp_replace(path, SCHEME, ""), F.lit(len(above) + 2))
    joined = lookup_join(rows.withColumn("_key", key), rejected, ["_key"], size=measured_bytes(rejected))
    return joined.filter(F.col("_rejected").isNull()).drop("_key", "_rejected")


def landing_summary(manifest: DataFrame) -> DataFrame:
    """Accepted and rejected files and bytes per dataset."""
    return manifest.groupBy(
        F.when(F.col("dataset") == "", "unknown").otherwise(F.col("dataset")).alias("dataset"), "status"
    ).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
