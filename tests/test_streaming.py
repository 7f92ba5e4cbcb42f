from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.scores import latest_scores
from tidemark.session import local_frame
from tidemark.sources.predictions import predictions_schema
from tidemark.streaming import latest

WHEN = datetime(2026, 7, 1)


def rows_of(seed, n=60, keys=9):
    rng = random.Random(seed)
    return [
        (f"k{rng.randrange(keys)}", rng.random(), 1, 0.5, "m", "v", f"r{seed}-{i:03}", "t", WHEN + timedelta(hours=rng.randrange(200)))
        for i in range(n)
    ]


def arrive(spark, source, *seeds):
    for seed in seeds:
        local_frame(spark, rows_of(seed), predictions_schema()).coalesce(1).write.mode("append").parquet(source)


def run(spark, source, path, checkpoint, **options):
    stream = spark.readStream.schema(predictions_schema()).option("maxFilesPerTrigger", 1).parquet(source)
    latest.keep_latest(stream, path, checkpoint, **options).awaitTermination()


def same(got, expected):
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("every", [1, 2, 100])
def test_table_follows_the_stream(spark, tmp_path, every):
    source, path, checkpoint = (str(tmp_path / k) for k in ("source", "table", "checkpoint"))
    seeds = []
    for new in ([1, 2, 3], [4], [5, 6]):
        arrive(spark, source, *new)
        seeds += new
        run(spark, source, path, checkpoint, compact_every=every)
        everything = local_frame(spark, [r for s in seeds for r in rows_of(s)], predictions_schema())
        same(latest.current_scores(spark, path), latest_scores(everything))
    bases = latest._numbers(spark, f"{path}/base", "upto=")
    assert bases == {1: [4, 5], 2: [3, 5], 100: []}[every]
    assert latest._numbers(spark, f"{path}/changes", "batch=") == {1: [5], 2: [4, 5], 100: [0, 1, 2, 3, 4, 5]}[every]


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    batches = [local_frame(spark, rows_of(s), predictions_schema()) for s in range(4)]
    for number, batch in enumerate(batches):
        # Every batch is run twice, and merged twice, the second time by a merge that was cut off.
        for _ in range(2):
            latest.write_changes(batch, path, number)
            latest.compact(spark, path, number)
        seen = batches[0]
        for other in batches[1 : number + 1]:
            seen = seen.unionByName(other)
        same(latest.current_scores(spark, path), latest_scores(seen))


def test_a_base_cut_off_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "table")
    batch = local_frame(spark, rows_of(1), predictions_schema())
    latest.write_changes(batch, path, 0)
    batch.limit(1).write.parquet(f"{path}/base/upto=0")
    (tmp_path / "table/base/upto=0/_SUCCESS").unlink()
    same(latest.current_scores(spark, path), latest_scores(batch))


def test_empty_table_and_empty_batch(spark, tmp_path):
    path = str(tmp_path / "table")
    assert latest.current_scores(spark, path).count() == 0
    empty = local_frame(spark, [], predictions_schema())
    latest.write_changes(empty, path, 0)
    latest.compact(spark, path, 0)
    found = latest.current_scores(spark, path)
    assert found.count() == 0 and found.columns == predictions_schema().names


def test_nulls_and_settings_are_refused(spark, tmp_path):
    batch = local_frame(spark, rows_of(1), predictions_schema()).withColumn("probability", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="probability must not be NULL"):
        latest.write_changes(batch, str(tmp_path / "t"), 0)
    with pytest.raises(ValueError, match="compact_every"):
        latest.keep_latest(batch, "t", "c", compact_every=0)
