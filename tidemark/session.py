"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_session(cores: str = "*", partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def work_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def materialise(
    df: DataFrame, label: str = "stage", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write a frame to the shared folder and read it back, so its plan runs once.

    Unlike a cached frame the written table outlives the executors that computed it.
    """
    path = work_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """A materialised frame whose table is deleted when the block ends."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: StructType | str) -> DataFrame:
    """A local relation from a few driver rows, by Arrow, so that its size is known."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    fields = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, fields, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), schema)
