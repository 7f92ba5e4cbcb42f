"""What several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_path

# A word is a run of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: str = "doc_id", text: str = "text", seed: str = "") -> Column:
    """16 bytes that depend on id and text only: the same in every run, spread evenly.

    Rows of equal id and text share a key. A null id or text differs from an empty one.
    """
    part = F.coalesce(F.concat(F.lit("t"), F.md5(F.col(text))), F.lit("null"))
    own = F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit("null"))
    return F.unhex(F.md5(F.concat_ws(":", F.lit(seed), own, part)))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Work:
    """Tables in the shared folder that are deleted together when the block ends.

    What a block returns must be in a table outside of it, or on the driver.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """Write a frame and read it back, as ``materialise`` does."""
        path = work_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            remove(self.spark, path)
