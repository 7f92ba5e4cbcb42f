from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m[0]):
                found.append((m.start(), k, m.end()))
    return sorted(found)


TEXTS = [
    None, "", " ", "no data at all", "a.b+c@mail.example.com, x@y", "a@b.c_d@e.f g@h.i.j..k @l.m é@n.o",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1..2.3.4.5 1.2.3", "4111 1111 1111 1111 and 4111111111111112 5 6-7",
    "5500-0000-0000-0004x 4111  1111 1111 1111 1234567890123456789012", "+1 (784) 555-2485. +12 +1234567890123456 +49..30..123456789",
    "ünïcödé 😀 joe@site.org 😀 10.0.0.1", "+1 555 010 9999@x.y 8.8.8.8", "a" * 2_000 + "@" + "b-" * 900 + ".c" * 900,
    "9" * 20_000, "9 " * 9_000, "+" + "1 (" * 9_000, "1." * 9_000, "joe@a.b " * 300, "\r\nx@y.zz\r\n", "\U0001f600+33 1 22 33 44 55",
]


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(3)
    alphabet = list("aZ9.@+-_ (%)é") + ["12", "1.2", "@a.b", "+1 ", "4111", " 1111"]
    rows = [(i, t) for i, t in enumerate(TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(1500)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("clash"))
    docs = docs.withColumn("base_spans", F.lit("clash")).repartition(4)
    result = pii.find(docs, pii.fit(docs))
    columns = result.select(
        "doc_id", "text", "base_spans", "all_spans", pii.written(F.col("base_spans")).alias("w"),
        pii.masked(F.col("text"), F.col("all_spans")).alias("m"),
    )
    return columns.collect()


def test_base_spans(found):
    for r in found:
        assert [tuple(s) for s in r["base_spans"]] == base(r["text"]), (r["text"] or "")[:100]
        names = list(PATTERNS)
        assert r["w"] == ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base(r["text"]))


def test_base_spans_stay_and_added_ones_are_apart(found):
    for r in found:
        own, everything = [tuple(s) for s in r["base_spans"]], [tuple(s) for s in r["all_spans"]]
        assert set(own) <= set(everything) and everything == sorted(everything)
        for s in set(everything) - set(own):
            assert not any(o[0] < s[2] and s[0] < o[2] for o in everything if o != s)


def test_mask(found):
    for r in found:
        if r["text"] is None:
            assert r["m"] is None
            continue
        out, at = "", 0
        for a, k, b in (tuple(s) for s in r["all_spans"]):
            if a >= at:
                out += r["text"][at:a] + f"[{pii.KINDS[k].upper()}]"
            at = max(at, b)
        assert r["m"] == out + r["text"][at:]


def test_other_ways_to_write(spark):
    rng = random.Random(4)
    rows = [f"please call me: +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} today" for _ in range(60)]
    rows += [f"my mail joe{i}@site{i}.com is here" for i in range(60)]
    rows += ["order id 1234.5678.91.2 key", "hash 123456789012 token"] * 10
    rows += ["my mail is joe (at) site (dot) com now", "please call 784-555-2485 today", "plain words only"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    model = pii.fit(docs)
    added = {r["text"]: [pii.KINDS[s["kind"]] for s in r["all_spans"]] for r in pii.find(docs, model).collect()}
    assert added[rows[-3]] == ["email"] and added[rows[-2]] == ["phone"] and added[rows[-1]] == []
    assert added["order id 1234.5678.91.2 key"] == []
    # Agreement with the other labelers makes a labeler reliable.
    check = model.reliability[0]["check"]
    assert check[1][2] > check[0][2]


def test_reliabilities_of_known_labelers():
    rng = random.Random(9)
    right = {"check": 0.95, "gazetteer": 0.8, "context": 0.7, "edges": 0.6}
    counts = {}
    for _ in range(20_000):
        truth = rng.random() < 0.4
        votes = tuple((1 if truth else -1) * (1 if rng.random() < right[v] else -1) for v in pii.VOTES)
        counts[votes] = counts.get(votes, 0) + 1
    rows = [dict(zip(pii.VOTES, v, strict=True)) | {"count": n} for v, n in counts.items()]
    table, belief = pii.estimate(rows, 100)
    for v, p in right.items():
        assert table[v][1][2] == pytest.approx(p, abs=0.05) and table[v][0][0] == pytest.approx(p, abs=0.05)
    assert all(0 <= b <= 1 for b in belief)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "plain"), (2, None)], "doc_id long, text string")
    for frame in (docs, docs.limit(0)):
        rows = pii.find(frame, pii.fit(frame)).collect()
        assert all(r["base_spans"] == r["all_spans"] == [] for r in rows)
    assert hashlib.sha256(b"").hexdigest() == docs.select(F.sha2(pii.written(F.array().cast("array<struct<start:int,kind:int,end:int>>")), 256)).first()[0]
