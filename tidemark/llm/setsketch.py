"""Near-duplicates by SetSketch registers, confirmed on the full sets.

Two documents are linked if their sets of word shingles (see shingles.py) have a Jaccard
similarity of at least 75 %. A sketch has 128 registers. Register i holds the exponentially
spaced, truncated level of the smallest value that any element has in i, where the values
of an element are arrivals of its own Poisson process, thrown on the registers at random.
Registers of a union are the maxima of the registers, and registers of similar sets are
mostly equal, so:

1. Documents with the same set become one class; only classes are compared.
2. A band is four registers; classes that agree in a band share a bucket. A pair of
   similarity 0.75 shares none of the 32 bands in five of a million cases.
3. In every bucket each class is held against the one that meets most others. The likelihood of the
   registers, jointly with the known sizes, refutes pairs that are very likely (by 5
   standard deviations) below 0.75; the full sets decide on all others.
4. Components of the confirmed links. Buckets that still have classes of several components
   have the pairs of different components held against each other in the same way. In a
   large bucket those are the pairs that share a shingle early in their sets, with all
   sets in one order that begins with the rarest: two sets that share as many shingles as
   a link takes share one before the last that they may miss. So a group of thousands of
   near copies costs few pairs, and no pair that may be linked is left out.

A text that is null, empty or without words has an empty set and is linked with nothing. A
null id is never the smallest of a component unless all ids are null. Rows that repeat an
id are documents of their own. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidemark.llm.common import Work, row_key
from tidemark.llm.components import components
from tidemark.llm.shingles import mix64, shingle_sets
from tidemark.session import materialise

PERCENT = 75
REGISTERS = 128
BAND = 4
# Levels are powers of BASE; values above 1 / RATE have level 0, LEVELS is the last.
BASE = 1.02
RATE = 20.0
LEVELS = 4_000
# A pair is refuted if its likelihood at 0.75 is below the largest by this factor's log.
REFUTED = 12.5
# The last bits of the registers refute most pairs early: of 128 bits of a pair of 0.75 at
# most 16 differ on average, with a deviation of 3.7.
MOST_DIFFERENT_BITS = 36
# Buckets of more members take their pairs from the beginnings of the sets. Shingles are
# ordered by the smaller of two counts under bits of their hashes, so few shingles seem more
# frequent than they are; any order is right, rare ones first saves pairs.
LARGE = 32
COUNTED = 1 << 20
# Words of 64 bits in the filter that spares texts the shuffle, 1 MB; it only ever lets
# through too much.
FILTER_WORDS = 1 << 17

# Texts that a Python worker holds at a time, in rows.
ROWS = 256


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of levels per set; a union's levels are the maxima of its parts'."""
    n = len(sets)
    least = np.full(n * REGISTERS, np.inf)
    own = np.repeat(np.arange(n), [len(s) for s in sets])
    element = np.concatenate([*sets, np.zeros(0, np.uint64)])
    arrival = np.zeros(len(element))
    bound = np.full(n, np.inf)
    step = 0
    while len(element):
        step += 1
        draw = mix64(element ^ mix64(np.uint64([step])))
        arrival -= np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / (RATE * REGISTERS)
        register = (draw & np.uint64(REGISTERS - 1)).astype(np.int64)
        np.minimum.at(least, own * REGISTERS + register, arrival)
        # An element whose arrivals are behind all registers' minima changes nothing more.
        there = np.flatnonzero(np.bincount(own, minlength=n))
        bound[there] = least.reshape(n, REGISTERS)[there].max(axis=1)
        alive = arrival < bound[own]
        element, own, arrival = element[alive], own[alive], arrival[alive]
    level = np.floor(1 - np.log(np.where(np.isinf(least), 1e9, least)) / np.log(BASE))
    return np.clip(level, 0, LEVELS).astype("<u2").reshape(n, REGISTERS)


def likely(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether the similarity may be 0.75 or more, by the joint likelihood of the registers.

    For sizes in proportion u : v (u + v = 1) and similarity J a register of the first is
    the larger with probability p(u - v J), that of the second with p(v - u J).
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def log_likelihood(j):
        first, second = p(u - v * j), p(v - u * j)
        same = np.clip(1 - first - second, 1e-12, 1)
        first, second = np.clip(first, 1e-12, 1), np.clip(second, 1e-12, 1)
        return more * np.log(first) + less * np.log(second) + equal * np.log(same)

    most = np.minimum(u / v, v / u)
    best = np.max([log_likelihood(most * g) for g in np.linspace(0, 1, 65)], axis=0)
    high = np.max([log_likelihood(0.75 + (most - 0.75) * g) for g in np.linspace(0, 1, 17)], axis=0)
    return (most >= 0.75) & (high >= best - REFUTED)


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Digest, size, registers and their last bits of each row; digest is null for empty sets."""
    schema = "doc_id long, row_key binary, digest binary, n_shingles long, sketch binary, bits_a long, bits_b long"
    rows = docs.select(F.col(doc_id).cast("long"), row_key(doc_id, text), F.col(text))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                sets = shingle_sets(part.column(2).to_pylist())
                levels = registers(sets)
                bits = np.packbits((levels & 1).astype(np.uint8), axis=1).view(np.int64).T
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(digests, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([own.tobytes() for own in levels], pa.binary()),
                        *(pa.array(own) for own in bits),
                    ],
                    names=["doc_id", "row_key", "digest", "n_shingles", "sketch", "bits_a", "bits_b"],
                )

    return rows.mapInArrow(sketch, schema)


def full_sets(texts: DataFrame) -> DataFrame:
    """(cls, elements) of frames (cls, text)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                sets = shingle_sets(part.column(1).to_pylist())
                offsets = pa.array(np.r_[0, np.cumsum([len(s) for s in sets])], pa.int32())
                values = pa.array(np.concatenate(sets).view(np.int64))
                lists = pa.ListArray.from_arrays(offsets, values)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["cls", "elements"])

    return texts.mapInArrow(build, "cls long, elements array<long>")


@F.pandas_udf(BooleanType())
def _likely(a: pd.Series, b: pd.Series, size_a: pd.Series, size_b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=bool)
    rows = [np.frombuffer(b"".join(s), "<u2").reshape(len(s), -1) for s in (a, b)]
    return pd.Series(likely(*rows, size_a.to_numpy(float), size_b.to_numpy(float)))


def _bands(classes: DataFrame) -> DataFrame:
    """A row (bucket, cls, n, bits_a, bits_b) per class and band."""
    step = 2 * BAND
    band = F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)))
    rows = classes.select("cls", F.col("n").cast("int").alias("n"), "bits_a", "bits_b", "sketch", band.alias("band"))
    key = F.xxhash64("band", F.substring("sketch", F.col("band") * step + 1, F.lit(step)))
    return rows.select(key.alias("bucket"), "cls", "n", "bits_a", "bits_b")


def _sets_of(ids: DataFrame, classes: DataFrame, texts: DataFrame, work: Work) -> DataFrame:
    """(cls, elements) of the wanted classes, each from one of its texts."""
    keys = work.table(classes.join(ids, "cls").select("cls", "row_key"), "keys")
    wanted = _perhaps(texts, keys).join(keys, "row_key").groupBy("row_key")
    # Rows of equal id and text share a key: one of them is enough.
    wanted = wanted.agg(F.first("cls").alias("cls"), F.first("text").alias("text")).drop("row_key")
    return work.table(full_sets(wanted), "sets")


def _perhaps(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The texts whose key is among the keys, and few others: by a filter of fixed size."""
    place = F.pmod(F.xxhash64("row_key"), F.lit(FILTER_WORDS * 64))
    word, bit = F.floor(place / 64).cast("int"), F.pmod(place, F.lit(64)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bits = keys.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    marked = texts.withColumns({"_word": word, "_mask": mask}).join(F.broadcast(bits), "_word")
    return marked.where(F.col("_bits").bitwiseAND(F.col("_mask")) != 0).drop("_word", "_mask", "_bits")


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b) of classes those whose full sets are similar enough."""

    def side(name: str) -> DataFrame:
        columns = {"cls": name, "n": f"n_{name}", "sketch": f"sketch_{name}"}
        return classes.select(*[F.col(c).alias(to) for c, to in columns.items()])

    with Work(pairs.sparkSession) as work:
        open_pairs = pairs.join(side("a"), "a").join(side("b"), "b")
        open_pairs = open_pairs.where(_likely("sketch_a", "sketch_b", "n_a", "n_b"))
        open_pairs = work.table(open_pairs.select("a", "b", "n_a", "n_b"), "pairs")
        ids = open_pairs.select(F.col("a").alias("cls")).union(open_pairs.select("b")).distinct()
        sets = _sets_of(ids, classes, texts, work)
        left = sets.select(F.col("cls").alias("a"), F.col("elements").alias("set_a"))
        right = sets.select(F.col("cls").alias("b"), F.col("elements").alias("set_b"))
        shared = F.size(F.array_intersect("set_a", "set_b"))
        judged = open_pairs.join(right, "b").join(left, "a").withColumn("shared", shared)
        similar = 100 * F.col("shared") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("shared"))
        return materialise(judged.where(similar).select("a", "b").distinct(), "links")


def _possible(other: str) -> Column:
    """Whether a class and another (columns with a suffix) can be similar enough.

    By their sizes, and by the last bits of their registers.
    """
    n, m = F.col("n"), F.col(f"n{other}")
    differ = lambda c: F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}{other}")))
    alike = differ("bits_a") + differ("bits_b") <= MOST_DIFFERENT_BITS
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & alike


def _other(members: DataFrame, *more: str) -> DataFrame:
    columns = ("cls", "n", "bits_a", "bits_b", *more)
    return members.select("bucket", *[F.col(c).alias(f"{c}_o") for c in columns])


def _across(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of possible members of a bucket with different labels."""
    both = members.join(_other(members, "label"), "bucket")
    both = both.where((F.col("label") < F.col("label_o")) & _possible("_o"))
    return both.select(F.least("cls", "cls_o").alias("a"), F.greatest("cls", "cls_o").alias("b"))


def _codes(elements: np.ndarray) -> np.ndarray:
    """Two places of each element in tables of COUNTED numbers, the second behind the first."""
    return np.array([elements & (COUNTED - 1), (elements >> 24 & (COUNTED - 1)) + COUNTED])


def _counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold a shingle, by either place: 2 * COUNTED numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * COUNTED, np.int64)
        for batch in batches:
            elements = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(_codes(elements).ravel(), minlength=2 * COUNTED)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "n"])

    counted = sets.select("elements").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    # What occurs once is as rare as what is not counted at all, and stays with the executors.
    counts = np.ones(2 * COUNTED, np.int32)
    for batch in counted.where("n > 1").toArrow().to_batches():
        counts[batch.column(0).to_numpy()] = np.minimum(batch.column(1).to_numpy(), 2**31 - 1)
    return counts


def early_pairs(docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes (cls, label, n, elements) of different labels that may be linked.

    A link takes m = 3 / 7 (n_a + n_b) shared elements. The first of them in the common order
    has at most n - m elements before it in either set. Shingles that only one label holds
    make no pairs.
    """
    counts = _counts(docs)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, labels, sizes, sets = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                own = sets[i].values.to_numpy(zero_copy_only=False)
                most = len(own) - -(-PERCENT * len(own) // 100) + 1
                first = own[np.lexsort((own, counts[_codes(own)].min(axis=0)))[:most]]
                fixed = [pa.array([c[i].as_py()] * len(first), c.type) for c in (classes, labels, sizes)]
                place = pa.array(np.arange(1, len(first) + 1), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), *fixed, place], names=["s", "cls", "label", "n", "place"]
                )

    rows = docs.select("cls", "label", "n", "elements")
    rows = rows.mapInArrow(begin, "s long, cls long, label long, n int, place int")
    several = rows.groupBy("s").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    rows = rows.join(several.where("low != high").select("s"), "s")
    other = rows.select("s", *[F.col(c).alias(f"{c}_o") for c in ("cls", "label", "n", "place")])
    shared = F.ceil(3 * (F.col("n") + F.col("n_o")) / 7 - 1e-9)
    early = (F.col("place") <= F.col("n") - shared + 1) & (F.col("place_o") <= F.col("n_o") - shared + 1)
    both = rows.join(other, "s").where((F.col("label") < F.col("label_o")) & early)
    return both.select(F.least("cls", "cls_o").alias("a"), F.greatest("cls", "cls_o").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and row_key and group of each row.

    ``group`` is null for documents linked with nothing by their empty set.
    """
    with Work(docs.sparkSession) as work:
        found = work.table(sketches(docs, doc_id, text), "sketches")
        classes = (
            found.where(F.col("digest").isNotNull())
            .groupBy("digest")
            .agg(
                F.min("doc_id").alias("low"),
                F.min("row_key").alias("row_key"),
                F.first("n_shingles").alias("n"),
                F.first("sketch").alias("sketch"),
                F.first("bits_a").alias("bits_a"),
                F.first("bits_b").alias("bits_b"),
            )
        )
        classes = work.table(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
        texts = docs.select(row_key(doc_id, text).alias("row_key"), F.col(text).alias("text"))

        bands = _bands(classes)
        shared = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        members = work.table(bands.join(shared, "bucket"), "members")
        # The first of a bucket is the class that meets most others: of a text and its copies
        # the text, which joins the copies at once.
        central = members.groupBy("cls").agg(F.sum("size").alias("met"))
        leads = members.select("bucket", "cls").join(central, "cls").groupBy("bucket")
        leads = leads.agg(F.max(F.struct("met", "cls")).getField("cls").alias("lead"))
        members = work.table(members.drop("size").join(leads, "bucket"), "buckets")
        held = members.where("cls != lead").join(_other(members.where("cls = lead")), "bucket").where(_possible("_o"))
        held = held.select(F.least("lead", "cls").alias("a"), F.greatest("lead", "cls").alias("b"))
        held = work.table(held.distinct(), "held")
        links = _confirmed(held, classes, texts)
        first = components(links)

        # What the first links have not joined yet.
        labelled = members.join(first, members["cls"] == first["node"], "left").drop("lead", "node")
        labelled = labelled.withColumn("label", F.coalesce("root", "cls")).drop("root")
        mixed = labelled.groupBy("bucket").agg(
            F.min("label").alias("x"), F.max("label").alias("y"), (F.count("*") > LARGE).alias("large")
        )
        apart = work.table(labelled.join(mixed.where("x != y").select("bucket", "large"), "bucket"), "apart")
        cross = _across(apart.where("NOT large"))
        large = apart.where("large")
        crowd = work.table(large.select("cls", "label", "n").distinct(), "crowd")
        if not crowd.isEmpty():
            sets = _sets_of(crowd.select("cls"), classes, texts, work)
            begun = work.table(early_pairs(crowd.join(sets, "cls")), "early")
            cross = cross.unionByName(begun)
        cross = cross.distinct().join(held, ["a", "b"], "left_anti")
        more = _confirmed(cross, classes, texts)
        roots = components(links.unionByName(more))

        grouped = classes.join(roots, classes["cls"] == roots["node"], "left")
        grouped = grouped.select("digest", "low", F.coalesce("root", "cls").alias("group"))
        lowest = grouped.groupBy("group").agg(F.min("low").alias("low"))
        grouped = grouped.drop("low").join(lowest, "group")
        rows = found.drop("sketch", "bits_a", "bits_b").join(grouped, "digest", "left")
        component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("low"))
        rows = rows.withColumn("component_id", component)
        result = rows.select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "row_key",
            "group",
        )
        return materialise(result, "near-duplicates")
