from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_sources import log
from tidemark.session import local_frame
from tidemark.sources import keyed, tables

ROWS = 40_000


def rows_read(df) -> int:
    """Rows that the scan of a frame without a shuffle hands on, by Spark's own metric."""
    df.collect()

    def scans(plan):
        if "FileScan" in plan.nodeName() or plan.nodeName().startswith("Scan"):
            yield plan
        for i in range(plan.children().size()):
            yield from scans(plan.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    return sum(p.metrics().apply("numOutputRows").value() for p in scans(plan))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keyed") / "scores")
    key = F.concat(F.lit("key-"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(ROWS)), 6, "0"))
    rows = spark.range(ROWS).select(key.alias("account_id"), F.md5(key).alias("payload"))
    # Several row groups a file.
    keyed.write_keyed(rows, path, "account_id", partitions=4, row_group=64 << 10, keys_per_file=10_000)
    return path


def test_a_lookup_reads_a_small_part(spark, stored):
    table = spark.read.parquet(stored)
    assert rows_read(table.filter(F.length("payload") == 32)) == ROWS
    few = table.filter(keyed.one_of("account_id", ["key-000017", "key-039000"]))
    assert few.count() == 2
    assert 2 <= rows_read(table.filter(keyed.one_of("account_id", ["key-000017", "key-039000"]))) < ROWS / 8
    # Between two stored keys, so within the range of a row group: its bloom filter skips it.
    absent = table.filter(keyed.one_of("account_id", ["key-000017x"]))
    assert rows_read(absent) < ROWS / 8


def test_many_parts_are_pushed(spark, stored):
    keys = [f"key-{i:06d}" for i in range(0, 25)]
    found = spark.read.parquet(stored).filter(keyed.one_of("account_id", keys))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
    assert found.count() == 25
    assert rows_read(found) < ROWS / 4


@pytest.mark.parametrize("n", [0, 3, keyed.SHORT, keyed.SHORT + 1, 3 * keyed.SHORT])
def test_short_and_long_lists_agree_with_the_plain_lookup(spark, stored, n):
    keys = [(f"key-{i * 31:06d}",) for i in range(n)] + [(f"gone-{i}",) for i in range(n // 3)]
    wanted = local_frame(spark, [*keys, *keys[:2], (None,)], "account_id string")
    got = keyed.lookup_keyed(spark, stored, wanted, "account_id").collect()
    want = tables.lookup_keys(spark.read.parquet(stored), wanted, "account_id").collect()
    order = lambda r: (r["account_id"] or "", r["found"])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert len(got) == len(keys) + len(keys[:2]) + 1


def test_cache_by_key(spark, tmp_path):
    scores = log(spark, ("a", 0.72, "r1", 1), ("a", 0.15, "r0", 1), ("b", 0.3, "r1", 1))
    path = str(tmp_path / "cache")
    keyed.export_keyed_cache(scores, path, partitions=2)
    got = keyed.lookup_list(spark, path, ["a", "z"], "account_id").collect()
    assert {r["account_id"]: (r["probability"], r["found"]) for r in got} == {"a": (0.72, True), "z": (None, False)}
    with pytest.raises(ValueError, match="No predictions"):
        keyed.export_keyed_cache(scores.limit(0), path)


def test_clashing_payload_names_and_odd_keys(spark, tmp_path):
    rows = local_frame(spark, [("a'b", 1), ("", 2), (None, 3)], "`my key` string, _rank int")
    path = str(tmp_path / "odd")
    keyed.write_keyed(rows, path, "my key", partitions=2)
    got = keyed.lookup_list(spark, path, ["a'b", ""], "my key").collect()
    assert {(r["my key"], r["_rank"], r["found"]) for r in got} == {("a'b", 1, True), ("", 2, True)}
