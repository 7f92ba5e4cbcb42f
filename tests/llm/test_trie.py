from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def modulo(c):
    return c - (abs(c) % 100) * (1 if c >= 0 else -1)


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(modulo(c), [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        size = len(node[-1][1]) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[b] for b in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if whole[c] == node)
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves[node], saved[node], sha))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit("clash") for c in ("conv", "digest", "pos", "size", "key", "part", "block", "total", "depth")})
    return sorted((tuple(r) for r in trie.prefix_trie(df).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_conversations(spark, monkeypatch, seed):
    monkeypatch.setattr(trie, "BLOCK", [2, 4, 3][seed - 1])
    monkeypatch.setattr(trie, "SPAN", [4, 1 << 16, 6][seed - 1])
    monkeypatch.setattr(trie, "IDS", 3)
    rng = random.Random(seed)
    words = ["a", "bb", "", None, "é🙂"]
    rows = []
    for c in rng.sample(range(-250, 700), 300):
        turns = [(t, rng.choice(["u", None]), rng.choice(words)) for t in range(rng.randint(1, 11))]
        if rng.random() < 0.3:
            turns = [(t, "u", "a") for t in range(rng.randint(1, 11))]
        rows += [(c, t if rng.random() < 0.9 else rng.choice([None, 3]), r, x) for t, r, x in turns]
    rows += [(None, 1, "u", "x"), (c, None, None, None)] + rows[:5]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_one_conversation_over_many_parts_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "SPAN", 64)
    rows = [(100, t, "u", f"{t % 7}") for t in range(1500)]
    rows += [(101, t, "u", f"{t % 7}") for t in range(1400)]
    rows += [(c, t, "u", "same") for c in range(1000, 1400) for t in range(6)]
    rows += [(c, 0, "u", "x") for c in range(5)]
    assert found(spark, rows) == brute(rows)


def test_edges(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "u", "x")]) == []
    # 1 takes at least one turn of the absent conversation 0 and has no other: only the root is left.
    for rows in ([(c, 0, "u", "x")] for c in (0, 1, 2, 3, 2**63 - 1, -(2**63))):
        assert found(spark, rows) == brute(rows)
    long = [(7, t, "u", "word " * 100_000) for t in range(7)] + [(8, t, None, None) for t in range(7)]
    assert found(spark, long) == brute(long)


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = catalog.op11_prefix_trie(spark, sf_dir).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
