"""Token counts through a cache of digests.

A count is stored under the digest of the content (the UTF-8 bytes of the text; null is
the empty text) and the digest of the tokenizer's file. Counting a table joins its
digests to the stored counts, encodes each missing content once however often it occurs,
appends the new counts to the cache and joins again. A changed tokenizer file has another
digest, so old counts are never used for it.

A cache is a folder of Parquet files. Two jobs that add the same content at once store it
twice with equal counts; the reader takes one. Copies of a text are merged on each task
before they are shuffled. An empty table adds nothing. Columns other than id and text are
not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import path_exists, work_path

LIMIT = 512
CACHE_SCHEMA = "content string, tokenizer string, n_bytes bigint, n_tokens bigint"

# Chunks of text whose counts a Python worker remembers, and characters per call of the library.
REMEMBERED = 400_000
CALL_CHARS = 1 << 20

# White space and what follows it up to the next white space.
_CHUNK = re.compile(r"\s*\S+|\s+")
# Characters that this module takes for white space and the tokenizers' pattern does not.
_UNLIKE = re.compile("[\x1c-\x1f]")


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


class TokenCounter:
    """Counts tokens as the tokenizer's library gives them, without special tokens added.

    A byte-level BPE tokenizer that splits before white space never joins a character that
    is not white space with white space behind it, so a text has as many tokens as its
    chunks together. Chunks repeat far more than texts; their counts are remembered up to a
    bound. With any other tokenizer the texts are encoded whole.
    """

    def __init__(self, path: str):
        self.chunked = False
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            pieces = SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: map(len, pieces.encode(texts, num_threads=1))
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            self.lengths = lambda texts: map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False))
            self.chunked = _splits_before_space(json.loads(Path(path).read_text(encoding="utf-8")))
        self.known: dict[str, int] = {}

    def _encode(self, texts: Iterable[str]) -> None:
        call, size = [], 0
        for text in texts:
            call.append(text)
            size += len(text) + 16
            if size >= CALL_CHARS:
                self._call(call)
                call, size = [], 0
        self._call(call)

    def _call(self, texts: list[str]) -> None:
        if texts:
            self.known.update(zip(texts, self.lengths(texts), strict=True))

    def count(self, texts: Iterable[str]) -> list[int]:
        if len(self.known) > REMEMBERED or not self.chunked:
            self.known.clear()
        chunks = [_CHUNK.findall(t) if self.chunked and not _UNLIKE.search(t) else [t] for t in texts]
        self._encode(set().union(*chunks) - self.known.keys())
        return [sum(map(self.known.__getitem__, own)) for own in chunks]


def _splits_before_space(settings: dict) -> bool:
    """Whether a tokenizer's file describes plain byte-level BPE with the usual pattern."""
    split = settings.get("pre_tokenizer") or {}
    return (
        settings.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and (settings.get("model") or {}).get("type", "BPE") == "BPE"
        and not any(t.get("lstrip") or t.get("rstrip") for t in settings.get("added_tokens", []))
    )


_COUNTERS: dict[str, TokenCounter] = {}


def _counter(path: str) -> TokenCounter:
    """One counter per Python worker and tokenizer."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer, one row per content."""
    if not path_exists(spark, cache):
        return spark.createDataFrame([], CACHE_SCHEMA)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == tokenizer)
    return stored.groupBy("content", "tokenizer").agg(
        F.min("n_bytes").alias("n_bytes"), F.min("n_tokens").alias("n_tokens")
    )


def add_missing(texts: DataFrame, cache: str, path: str) -> None:
    """Encode the contents (content, text) that the cache lacks and append their counts."""
    spark = texts.sparkSession
    digest = tokenizer_digest(path)
    if path_exists(spark, cache):
        # Only the digests meet the cache; texts are shuffled if any are missing from it.
        stored = read_cache(spark, cache, digest)
        missing = texts.select("content").distinct().join(stored, "content", "left_anti")
        texts = texts.join(missing, "content", "left_semi")
    once = texts.groupBy("content").agg(F.first("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            contents, own = batch.column(0), batch.column(1).to_pylist()
            for start in range(0, len(own), 256):
                part = own[start : start + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        contents.slice(start, len(part)).cast(pa.string()),
                        pa.array([digest] * len(part), pa.string()),
                        pa.array([len(t.encode()) for t in part], pa.int64()),
                        pa.array(counter.count(part), pa.int64()),
                    ],
                    names=["content", "tokenizer", "n_bytes", "n_tokens"],
                )

    once.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)


def count_tokens(
    docs: DataFrame,
    path: str,
    cache: str | None = None,
    limit: int = LIMIT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """n_bytes, n_tokens and over_limit of each row, by its id.

    Without ``cache`` a new one is begun in the shared folder.
    """
    spark = docs.sparkSession
    cache = cache or work_path(spark, "token-cache")
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias(doc_id), content.alias("text"))
    rows = rows.withColumn("content", F.sha2(F.col("text"), 256))
    add_missing(rows.select("content", "text"), cache, path)
    counts = read_cache(spark, cache, tokenizer_digest(path))
    return rows.select(F.col(doc_id), "content").join(counts, "content").select(
        doc_id, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
