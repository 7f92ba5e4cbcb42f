from __future__ import annotations

from collections import Counter

import pytest

from tidemark.llm import shards

NAMES = [f"s{i}" for i in range(7)]


def claims(names, size):
    """Every shard takes the first free slot of its whole permutation, in turns."""
    order = []
    for name in names:
        first = shards._number(f"offset:{name}") % size
        step = shards._number(f"skip:{name}") % (size - 1) + 1
        order.append([(first + i * step) % size for i in range(size)])
    owner = {}
    while len(owner) < size:
        for shard, own in enumerate(order):
            free = [slot for slot in own if slot not in owner]
            if free:
                owner[free[0]] = shard
    return [owner[i] for i in range(size)]


def test_table_is_that_of_the_permutations():
    assert shards.fill_table(NAMES, 53) == claims(NAMES, 53)


def test_shares_are_even_and_few_slots_move():
    table = shards.fill_table(NAMES, 1009)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    after = shards.fill_table(NAMES[1:], 1009)
    stay = [NAMES[a] == NAMES[1:][b] for a, b in zip(table, after, strict=True) if a]
    assert sum(stay) / len(stay) > 0.8


@pytest.mark.parametrize(
    ("names", "size"), [([], 53), (["a", "a"], 53), (["a", ""], 53), (["a"], 54), (NAMES, 5), (["a"], 1_048_583)]
)
def test_refused(names, size):
    with pytest.raises(ValueError):
        shards.fill_table(names, size)


def test_place(make_docs):
    docs = make_docs([(i, "x") for i in range(50)] + [(None, "y"), (None, None), (3, "again")])
    rows = shards.place(docs, NAMES, "doc_id", size=53).collect()
    table = shards.fill_table(NAMES, 53)
    assert len(rows) == 53
    assert all(r["shard"] == NAMES[table[r["slot"]]] for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert len({r["shard"] for r in rows if r["doc_id"] == 3}) == 1
    assert shards.place(docs.limit(0), NAMES, "doc_id", size=53).count() == 0


def test_write_shards(make_docs, spark, tmp_path):
    placed = shards.place(make_docs([(i, "x") for i in range(50)]), NAMES, "doc_id", size=53)
    shards.write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("doc_id", "shard").collect())) == sorted(
        map(tuple, placed.select("doc_id", "shard").collect())
    )
