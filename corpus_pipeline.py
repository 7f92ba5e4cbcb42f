"""The corpus pipeline: documents in, packed documents out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import buckets, mixing, pii, setsketch, toxicity
from tidemark.llm.common import row_key, table
from tidemark.session import materialise


# Stages keep a document's columns in one struct, ``row``, so that no name of theirs meets another.


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5, by a model learned from the labels."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(F.struct("*").alias("row"), toxicity.score("text", model).alias("toxicity"))
    return scored.where(F.col("toxicity") < 0.5).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Of rows that repeat this id one stays. Documents without words are in no group.
    """
    found = setsketch.near_duplicates(docs.select("doc_id", "text"))
    alone = F.col("group").isNull()
    one = found.where("kept").groupBy("group", F.when(alone, F.col("row_key")).alias("own"))
    kept = one.agg(F.min("row_key").alias("key"), F.first(alone).alias("alone")).select("key", "alone")
    keyed = docs.select(F.struct("*").alias("row"), row_key().alias("key")).join(kept, "key")
    again = F.row_number().over(Window.partitionBy("key").orderBy("row.doc_id"))
    return keyed.withColumn("again", again).where(F.col("alone") | (F.col("again") == 1)).select("row.*")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    found = pii.find(docs.select(F.struct("*").alias("row"), "text"), pii.fit(docs))
    found = found.withColumn("text", pii.masked(F.col("text"), F.col("all_spans")))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Rows of equal id and text share the copies that they have together.
    """
    mixed = mixing.mix(docs).groupBy(F.col("row_key").alias("key"))
    mixed = mixed.agg(F.count("*").alias("rows"), F.sum("copies").cast("long").alias("copies"))
    keyed = docs.select(F.struct("*").alias("row"), row_key(seed=mixing.SEED).alias("key")).join(mixed, "key")
    place = F.row_number().over(Window.partitionBy("key").orderBy("row.doc_id"))
    own = F.floor(F.col("copies") / F.col("rows")) + (place <= F.col("copies") % F.col("rows")).cast("long")
    taken = keyed.withColumn("own", own).where("own > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("own")))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and position of every document of the mix."""
    return buckets.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("pii", mask_pii),
    ("mixing", mix_sources),
    ("packing", packing),
]

# The first stage decides by a trained model, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES):
            docs = materialise(docs, name)
    return docs
