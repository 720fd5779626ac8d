"""Where jobs put tables that must outlive an executor."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with the scheme and authority of its filesystem."""
    return _filesystem(spark, path).makeQualified(_path(spark, path)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).exists(_path(spark, path))


def is_directory(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).getFileStatus(_path(spark, path)).isDirectory()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder."""
    return [s.getPath().getName() for s in _filesystem(spark, path).listStatus(_path(spark, path))]


def make_directory(spark: SparkSession, path: str) -> None:
    _filesystem(spark, path).mkdirs(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _filesystem(spark, path).delete(_path(spark, path), True)


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local session without that setting may fall back to its own folder,
    because elsewhere such a folder would vanish with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="orderloom-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own for one run, below the shared folder."""
    return f"{shared_root(spark)}/orderloom/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written below the shared folder and read back, so that its lineage ends at files every executor sees."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# The file of a published table that names the folder it is kept in.
POINTER = "LOCATION"


def publish(spark: SparkSession, at: str, folder: str) -> None:
    """Make the table kept in `folder` readable at `at`; nothing is copied."""
    make_directory(spark, at)
    stream = _filesystem(spark, at).create(_path(spark, f"{at}/{POINTER}"), True)
    stream.write(bytearray(qualified(spark, folder).encode()))
    stream.close()


def published(spark: SparkSession, at: str) -> str:
    """The folder behind a published table, `at` itself if it is kept there."""
    if not exists(spark, f"{at}/{POINTER}"):
        return at
    return spark.read.text(f"{at}/{POINTER}").first()[0]
