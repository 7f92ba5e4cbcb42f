from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidemark.llm import setsketch
from tidemark.llm.components import components
from tidemark.llm.shingles import mix64, shingle_sets


def reference_set(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def reference_groups(rows):
    """doc ids' components by all pairs; rows of (id, text)."""
    sets = [reference_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [m for m in members[find(i)] if m is not None]
        low = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), low, doc_id == low))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gámma", "delta", "eps", "x1", "ß", "É"] + [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 60, 200]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own += [rng.choice(words) for _ in range(len(own) // 10)]
            rows.append(rng.choice([" ", "\n", " \t"]).join(own))
    # A chain in which only neighbours are near.
    chain = [f"c{i}" for i in range(200)]
    rows += [" ".join(chain[i * 8 : i * 8 + 104]) for i in range(10)]
    rows += [None, "", " \n", "a\x85b", "a b c d e f"]
    rng.shuffle(rows)
    return [(i + 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_all_pairs(make_docs, seed):
    rows = corpus(seed)
    found = setsketch.near_duplicates(make_docs(rows))
    got = [tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect()]
    assert sorted(got, key=str) == reference_groups(rows)


def crowd(seed, n=160):
    """Copies of one text with few to many edits: many pairs are just above or below 0.75."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5])):
            own[rng.randrange(len(own))] = f"e{rng.randint(0, 60)}"
        rows.append((i, " ".join(own[: rng.choice([120, 120, 110, 90])])))
    # Others share a passage only.
    passage = base[:40]
    rows += [(1000 + i, " ".join([*passage, *(f"p{i}x{j}" for j in range(30))])) for i in range(60)]
    return rows


@pytest.mark.parametrize("large", [32, 4])
def test_crowds_equal_all_pairs(make_docs, monkeypatch, large):
    monkeypatch.setattr(setsketch, "LARGE", large)
    rows = crowd(large)
    found = setsketch.near_duplicates(make_docs(rows))
    got = [tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect()]
    assert sorted(got, key=str) == reference_groups(rows)


def test_null_ids_and_repeated_rows(make_docs):
    long = "one two three four five six seven"
    rows = [(None, long), (None, "only null ids here in this text"), (7, long), (7, long), (9, long.upper()), (None, None), (4, "")]
    found = setsketch.near_duplicates(make_docs(rows))
    got = sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    want = [
        (None, 3, 7, False), (None, 3, None, True), (7, 3, 7, True), (7, 3, 7, True), (9, 3, 7, False),
        (None, 0, None, True), (4, 0, 4, True),
    ]
    assert got == sorted(want, key=str)


def test_no_rows(make_docs):
    assert setsketch.near_duplicates(make_docs([(1, "a")]).limit(0)).count() == 0


def test_shingles_of_long_texts():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdef") * rng.randint(1, 3) for _ in range(900_000))
    assert len(text) > 1 << 20
    whole, short = shingle_sets([text, text[:2000]])
    assert len(whole) == len(reference_set(text)) and len(short) == len(reference_set(text[:2000]))
    assert set(shingle_sets([text[:2000]])[0]) == set(short)


def test_registers_merge_and_estimate():
    universe = mix64(np.arange(3000, dtype=np.uint64))
    a, b = universe[:2000], universe[500:2500]
    levels = setsketch.registers([a, b, np.union1d(a, b)])
    assert (np.maximum(levels[0], levels[1]) == levels[2]).all()
    assert abs((levels[0] == levels[1]).mean() - 0.6) < 0.15
    pairs = [(universe[:1000], universe[s : s + 1000]) for s in range(0, 1000, 5)]
    similarity = np.array([(1000 - s) / (1000 + s) for s in range(0, 1000, 5)])
    first, second = (setsketch.registers([p[i] for p in pairs]) for i in (0, 1))
    size = np.full(len(pairs), 1000.0)
    judged = setsketch.likely(first, second, size, size)
    assert judged[similarity >= 0.75].all() and not judged[similarity < 0.4].any()


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)]
    links += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(80)] + [(7, 7), (1, 0), (400, 400)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    group = {n: n for pair in links for n in pair}
    for _ in range(200):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    nodes = [n for n in group if any(n in p and p[0] != p[1] for p in links)]
    assert set(found) == set(nodes)
    for n in nodes:
        for m in nodes:
            assert (found[n] == found[m]) == (group[n] == group[m])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
