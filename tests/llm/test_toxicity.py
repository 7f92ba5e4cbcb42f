from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.common import table
from tidemark.llm.deobfuscation import Restorer, trigram_counts, trigram_model

BAD = ["idiot", "stupid", "moron"]
GOOD = "the a of and river stone light window paper garden morning letter number table water".split()


def texts(n, seed, write=lambda w: w):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(GOOD) for _ in range(rng.randint(5, 60))]
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), write(rng.choice(BAD)))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = texts(600, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return toxicity.fit(docs, labels)


def scored(spark, model, values):
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    return [r[1] for r in sorted(docs.select("doc_id", toxicity.score("text", model)).collect())]


def test_disguises(spark, model):
    disguised = [
        "1d10t", "!diot", "i.d.i.o.t", "i d i o t", "idiooooot", "IDIOT!!", "st*upid", "$tupid", "m0r0n", "m-o-r-o-n",
        "mоrоn", "STUPID###",
    ]
    got = scored(spark, model, [f"the river {w} of stone" for w in disguised])
    assert [w for w, s in zip(disguised, got, strict=True) if s < 0.5] == []


def test_clean_and_edge_texts(spark, model):
    clean = [None, "", " \n ", "the river of stone", "c d e f", "555-1234", "w" * 50_000, "the " * 20_000, "…", "a1b2c3" * 50]
    got = scored(spark, model, clean)
    assert all(0 <= s < 0.5 for s in got)


def test_held_out_accuracy(spark, sf_dir):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.fit(docs, labels)
    rows = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    judged = rows.select("doc_id", "toxic", toxicity.score("text", model).alias("s")).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in judged)
    toxic = [r["s"] for r in judged if r["toxic"]]
    clean = [r["s"] for r in judged if not r["toxic"]]
    assert np.mean(np.array(toxic) >= 0.5) > 0.9 and np.mean(np.array(clean) >= 0.5) < 0.01


def test_without_labels(spark, make_docs):
    docs = make_docs([(1, "a"), (2, None), (None, "b"), (2, "b")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert [r[0] for r in docs.select(toxicity.score("text", model)).collect()] == [0.0] * 4
    # Of one class only: ids 1 and 2 are not held out, the null ones are no labels.
    known = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5]
    one = spark.createDataFrame([(i, 1) for i in known] + [(None, 0), (None, None), (1, None)], "doc_id long, toxic int")
    docs = make_docs([(i, "a") for i in known])
    assert toxicity.fit(docs, one).prior == 1.0
    assert toxicity.fit(docs.limit(0), one).prior == 0.0


def test_held_out_labels_are_not_read(spark):
    rows = texts(300, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = [(i, y) for i, _, y in rows]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    first, second = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert first.weights == second.weights and (first.coefficients == second.coefficients).all()


def test_viterbi_finds_the_best_path():
    counts = trigram_counts(["the idiot sat on the idle table", "an idiom is not idiotic"])
    restorer = Restorer(trigram_model(counts))
    assert restorer.decode("1d10t") == "idiot"
    assert restorer.words("table,") == ["table"]
    assert restorer.words("2024") == [] and restorer.words("...") == []
