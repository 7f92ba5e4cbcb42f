"""Spans that the method adds, held against planted ones, and what the fit takes in."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import pii

WORDS = "lorem ipsum dolor sit amet tempor magna aliqua minim veniam".split()


def planted(n=1500, seed=11):
    """Texts with base spans, other ways to write them (true) and look-alikes (false)."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choices("0123456789", k=k))
    part = lambda: f"{rng.randint(200, 989)}-555-{digits(4)}"
    rows, true = [], []
    for i in range(n):
        filler = " ".join(rng.choices(WORDS, k=6))
        shape = i % 8
        if shape == 0:
            prefix, own, keep = "contact mail", f"u{i}@site{i}.com", None
        elif shape == 1:
            prefix, own, keep = "my mail is", f"u{i} (at) site{i} (dot) org", True
        elif shape == 2:
            prefix, own, keep = "we meet", f"guest{i} (at) noon", False
        elif shape == 3:
            prefix, own, keep = "please call", f"+1 ({rng.randint(200, 989)}) 555-{digits(4)}", None
        elif shape == 4:
            prefix, own, keep = "my phone", part(), True
        elif shape == 5:
            prefix, own, keep = "order id", f"{rng.randint(0, 1)}{digits(2)}-555-{digits(4)}", False
        elif shape == 6:
            prefix, own, keep = "server version", f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}", False
        else:
            prefix, own, keep = "invoice token", "1" + digits(9), False
        text = f"{filler} {prefix} {own} {filler}"
        rows.append((i, text))
        start = text.index(own)
        true.append((keep, start, start + len(own)))
    return rows, true


def test_added_spans_of_planted_texts(spark):
    rows, true = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(docs, pii.fit(docs)).collect()}
    hits = added = wanted = 0
    for (i, _), (keep, start, end) in zip(rows, true, strict=True):
        base = [tuple(s) for s in found[i]["base_spans"]]
        more = [s for s in map(tuple, found[i]["all_spans"]) if s not in base]
        assert (len(base) > 0) == (keep is None)
        added += len(more)
        wanted += keep is True
        hits += keep is True and [(s[0], s[2]) for s in more] == [(start, end)]
    assert hits / wanted >= 0.95 and hits / added >= 0.95


def test_candidates_leave_out_what_a_base_span_touches(spark):
    texts = ["+1 (784) 555-2485", "x 784-555-2485 y", "a@b.com (at) c (dot) org", "1.2.3 and 1.2.3.4", "9876543210 or 41111111111111119"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = docs.select("text", F.explode(pii.candidates(F.col("text"))).alias("c")).select("text", "c.*").collect()
    got = {}
    for r in rows:
        got.setdefault(r["text"], []).append((pii.KINDS[r["kind"]], r["text"][r["start"] : r["end"]], r["base"], r["check"]))
    assert got[texts[0]] == [("phone", "+1 (784) 555-2485", True, 1)]
    assert got[texts[1]] == [("phone", "784-555-2485", False, 0)]
    assert got[texts[2]] == [("email", "a@b.com", True, 1)]
    assert got[texts[3]] == [("ip", "1.2.3.4", True, 1), ("ip", "1.2.3", False, -1)]
    assert sorted(g[0] for g in got[texts[4]]) == ["card", "phone"] and not any(g[2] for g in got[texts[4]])


def test_failing_cards_are_not_added_however_many(spark):
    """Numbers that fail their check stay out, at any size of the corpus."""
    rng = random.Random(5)
    rows = ["visa 4111111111111111 paid"] * 40 + [f"lorem 4{rng.randint(10**13, 10**14 - 1)}7 ipsum" for _ in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    for copies in (1, 20):
        many = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        result = pii.find(docs, pii.fit(many))
        assert result.filter(F.size("all_spans") > F.size("base_spans")).isEmpty()


def test_known_spans_have_no_part_in_the_share():
    quiet = {"gazetteer": 0, "context": 0, "edges": 0}
    rows = [
        {**quiet, "base": True, "check": 1, "count": 10_000},
        {**quiet, "base": False, "check": 0, "count": 50},
        {**quiet, "base": False, "check": -1, "count": 50},
    ]
    table, belief = pii.estimate(rows)
    assert belief[0] == 1.0 and belief[2] < 0.01 and 0.05 < belief[1] < 0.95
    assert table["check"][0][1] == table["check"][1][1]
