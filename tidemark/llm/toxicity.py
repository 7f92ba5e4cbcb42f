"""Toxicity of texts after undoing disguises.

1. Character trigrams of all texts give the model by which disguised words are restored
   (see deobfuscation.py).
2. Features of a text are its distinct restored words and their first 4, 5 and 6 letters.
   In a bounded sample of labelled rows they are counted in toxic and in other documents;
   a feature's weight is the lower confidence bound of its log odds ratio, if positive.
3. A word weighs as its heaviest feature. A logistic regression on the four heaviest
   words of a document and its number of distinct tokens gives the score. It is fitted on
   weights that leave out the document they are applied to.

Labels of held-out rows are not read. A null or empty text is scored as one without words.
Labels for unknown or null ids are ignored, of several labels of an id the largest counts.
Without labels of both classes the score is the share of toxic labels, 0 without labels.
Repeated rows have equal scores. Only id and text are read of the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.llm.common import Work
from tidemark.llm.deobfuscation import SYMBOLS, Restorer, trigram_counts, trigram_model

# Labelled rows that the classifier is fitted on, at most; chosen by a hash of the id.
SAMPLE = 24_000
# A feature is in at least so many toxic documents of the sample, which bounds their number.
SUPPORT = 4
PREFIXES = (4, 5, 6)
HEAVIEST = 4
# Tokens whose restored words a Python worker remembers.
REMEMBERED = 300_000


def held_out(doc_id: Column) -> Column:
    """One id in five, by the CRC-32 of its text."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def features(word: str) -> list[str]:
    """The word, and its beginnings with a mark."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def bound(toxic: float, other: float, n_toxic: float, n_other: float) -> float:
    """Two standard errors below the log odds ratio of a feature."""
    ratio = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_other + 1))
    return ratio - 2 * math.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))


class Reader:
    """Distinct restored words of texts; remembers tokens up to a bound."""

    def __init__(self, letters: np.ndarray):
        self.restorer = Restorer(letters)
        self.known: dict[str, list[str]] = {}

    def words(self, text: str | None) -> tuple[set[str], int]:
        """The words, and the number of distinct tokens."""
        text = (text or "").lower()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = set(self.restorer.spaced(text))
        tokens = set(text.split())
        for token in tokens:
            own = self.known.get(token)
            if own is None:
                own = self.known[token] = self.restorer.words(token)
            found.update(own)
        return found, len(tokens)


@dataclass
class ToxicityModel:
    """What the score of a text is computed from."""

    letters: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    # Intercept, the heaviest words, log of the number of distinct tokens.
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(HEAVIEST + 2))
    prior: float | None = 0.0

    @staticmethod
    def inputs(word_weights: Iterable[float], tokens: int) -> list[float]:
        heavy = sorted(word_weights, reverse=True)[:HEAVIEST]
        return [1.0, *heavy, *[0.0] * (HEAVIEST - len(heavy)), math.log1p(tokens)]


class Scorer:
    """Scores texts; a token's heaviest words are remembered up to a bound."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.restorer = Restorer(model.letters)
        self.known: dict[str, tuple[tuple[str, float], ...]] = {}

    def _heavy(self, words: Iterable[str]) -> tuple[tuple[str, float], ...]:
        """The words that have a weight."""
        weights = self.model.weights
        weighed = ((w, max(weights.get(f, 0.0) for f in features(w))) for w in words)
        return tuple(x for x in weighed if x[1] > 0)

    def score(self, text: str | None) -> float:
        model = self.model
        if model.prior is not None:
            return model.prior
        if len(self.known) > REMEMBERED:
            self.known.clear()
        text = (text or "").lower()
        heavy = dict(self._heavy(self.restorer.spaced(text)))
        tokens = set(text.split())
        known = self.known
        for token in tokens:
            own = known.get(token)
            if own is None:
                own = known[token] = self._heavy(self.restorer.words(token))
            if own:
                heavy.update(own)
        margin = float(np.dot(model.coefficients, model.inputs(heavy.values(), len(tokens))))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, margin))))


def letter_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The character model of all texts: at most 28**3 counts reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.column(0).slice(start, 256).to_pylist()
                total += trigram_counts(t for t in part if t)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "n"])

    counted = docs.select(text).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = np.zeros(SYMBOLS**3, np.int64)
    for code, n in counted.collect():
        counts[code] = n
    return trigram_model(counts)


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> ToxicityModel:
    """Learn from labels (the id, toxic) of rows that are not held out."""
    with Work(docs.sparkSession) as work:
        model = ToxicityModel(letter_model(docs, text))
        known = labels.select(F.col(doc_id).alias("_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
        known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("toxic").alias("toxic"))
        known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
        # At most ``sample`` rows of two numbers.
        rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(known), "_id")
        letters = model.letters

        def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = Reader(letters)
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    read = [reader.words(t) for t in part.column(1).to_pylist()]
                    words = pa.array([sorted(own) for own, _ in read], pa.list_(pa.string()))
                    tokens = pa.array([n for _, n in read], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(2), words, tokens], names=["id", "toxic", "words", "tokens"]
                    )

        schema = "id long, toxic int, words array<string>, tokens long"
        rows = rows.select("_id", "_text", "toxic").mapInArrow(restore, schema)
        # Rows that repeat an id count once.
        read = F.max(F.struct("tokens", "words", "toxic")).alias("read")
        rows = work.table(rows.groupBy("id").agg(read).select("id", "read.*"), "words")
        sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        n_toxic = sizes.get(1, 0)
        n_other = sum(sizes.values()) - n_toxic
        if not n_toxic or not n_other:
            model.prior = float(n_toxic > 0)
            return model

        def tally(toxic: int, only: set[str] | None):
            def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total: Counter[str] = Counter()
                for batch in batches:
                    for words in batch.column(0).to_pylist():
                        own = {f for w in words for f in features(w)}
                        total.update(own if only is None else own & only)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["f", "n"]
                )

            counted = rows.where(F.col("toxic") == toxic).select("words").mapInArrow(count, "f string, n long")
            return counted.groupBy("f").agg(F.sum("n").alias("n"))

        frequent = tally(1, None).where(F.col("n") >= SUPPORT)
        toxic = {f: n for f, n in frequent.collect()}
        other = {f: n for f, n in tally(0, set(toxic)).collect()}
        counts = {f: (n, other.get(f, 0)) for f, n in toxic.items()}
        model.weights = {f: w for f, (a, b) in counts.items() if (w := bound(a, b, n_toxic, n_other)) > 0}

        # Each document's inputs by weights from the others.
        counts = {f: counts[f] for f in model.weights}

        def without(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own = []
                for y, words, tokens in zip(batch["toxic"], batch["words"], batch["tokens"], strict=True):

                    def weight(f, y=y):
                        a, b = counts.get(f, (0, 0))
                        if not a:
                            return 0.0
                        return max(0.0, bound(a - y, b - (1 - y), n_toxic - y, n_other - (1 - y)))

                    own.append(model.inputs([max(map(weight, features(w))) for w in words], tokens))
                yield pd.DataFrame({"id": batch["id"], "toxic": batch["toxic"], "x": own})

        fitted = rows.mapInPandas(without, "id long, toxic int, x array<double>").toPandas().sort_values("id")
        model.coefficients = logistic(np.array(fitted["x"].tolist()), fitted["toxic"].to_numpy(float))
        model.prior = None
        return model


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Coefficients of a logistic regression by Newton's method; the first is the intercept."""
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - ridge * beta
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def score(text: str, model: ToxicityModel) -> Column:
    """The score of a text column: 0 to 1."""

    @F.pandas_udf(DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.map(scorer.score).astype(float)

    return scored(F.col(text))
