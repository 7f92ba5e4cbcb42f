from __future__ import annotations

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tests.telco import customers
from tidemark.operators import deltas, scores
from tidemark.roles import TELCO
from tidemark.session import local_frame, materialise, shared_dir
from tidemark.sources import jsonl, metrics, predictions, tables, views

SCORED = "account_id string, probability double, flag int, threshold double, model string, model_version string"
LOG = SCORED + ", run_id string, source_table string, scored_at timestamp"
WHEN = datetime(2026, 7, 1, 6, 0, tzinfo=UTC)


def scored(spark, *rows):
    return local_frame(spark, [(i, p, int(p >= 0.5), 0.5, "m", "m/v1") for i, p in rows], SCORED)


def test_csv_keeps_blank_text(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,tenure,total,flag\na,1,10.5,True\nb,0, ,False\nc,3,,True\n')
    df = tables.load_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "t"), "id string, tenure int, total string, flag boolean")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        ("a", 1, "10.5", True), ("b", 0, " ", False), ("c", 3, "", True)
    ]
    inferred = tables.load_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "t"))
    assert dict(inferred.dtypes) == {"id": "string", "tenure": "int", "total": "string", "flag": "boolean"}
    assert inferred.count() == 3


def test_limits_and_empty_population(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).write.parquet(path)
    assert tables.load_table(spark, path, 3).count() == 3
    assert tables.load_scoring(spark, path).count() == 10
    spark.range(0).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="is empty"):
        tables.load_scoring(spark, path)


def test_seeding(spark):
    df = local_frame(spark, [(f"c{i}", i) for i in range(50)], "id string, label int")
    seeded = tables.seed_scoring(df, "id", "label", 20)
    assert seeded.columns == ["id", "as_of_date"]
    assert seeded.count() == 20
    assert tables.seed_scoring(df, "id", "label", 20, keep_label=True).columns == ["id", "label", "as_of_date"]


def test_a_run_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "predictions")
    for run, rows in (("r1", [("a", 0.9), ("b", 0.1)]), ("r2", [("a", 0.4)]), ("r2", [("a", 0.4)])):
        predictions.write_predictions(
            scored(spark, *rows), path, run_id=run, source_table="t", scored_at=WHEN
        )
    table = predictions.read_predictions(spark, path)
    assert table.count() == 3
    assert [f.name for f in table.schema] == [f.name for f in predictions.predictions_schema()]
    only = predictions.read_predictions(spark, path, run_id="r1")
    assert {r["account_id"] for r in only.collect()} == {"a", "b"}
    assert {r["scored_at"] for r in only.select(F.col("scored_at").cast("string")).collect()} == {"2026-07-01 06:00:00"}


def test_a_retry_on_the_next_day_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "predictions")
    late, early = datetime(2026, 7, 1, 23, 59, tzinfo=UTC), datetime(2026, 7, 2, 0, 1, tzinfo=UTC)
    for when in (late, early):
        for run in ("r1", "r2"):
            predictions.write_predictions(
                scored(spark, ("a", 0.9), ("b", 0.1)), path, run_id=run, source_table="t", scored_at=when
            )
    table = predictions.read_predictions(spark, path)
    assert table.count() == 4
    assert [str(r[0]) for r in table.select(F.to_date("scored_at")).distinct().collect()] == ["2026-07-02"]


def test_days_and_runs_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "predictions")
    for day in range(1, 6):
        when = datetime(2026, 7, day, 6, tzinfo=UTC)
        predictions.write_predictions(scored(spark, ("a", day / 10)), path, run_id=f"r{day}", source_table="t", scored_at=when)
    some = predictions.read_predictions(spark, path, since=date(2026, 7, 2), until=date(2026, 7, 3))
    assert sorted(r["run_id"] for r in some.collect()) == ["r2", "r3"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("score_date" in f.split("PartitionFilters: [")[1].split("]")[0] for f in filters)
    one = predictions.read_predictions(spark, path, run_id="r4", until=date(2026, 7, 4))
    assert one.count() == 1
    assert predictions.read_predictions(spark, path, run_id="r4", until=date(2026, 7, 3)).count() == 0


def test_a_run_of_several_days_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = local_frame(spark, [(f"k{i}", 0.5, 1, 0.5, "m", "v") for i in range(6)], SCORED)
    stamped = predictions.stamp(rows, run_id="r: 1/ü", source_table="t", scored_at=WHEN)
    later = F.expr("scored_at + make_interval(0, 0, 0, int(substr(account_id, 2)))")
    predictions.append_predictions(stamped.withColumn("scored_at", later), path)
    assert predictions.read_runs(spark, path).agg(F.count("*"), F.sum("n")).first()[:] == (6, 6)
    predictions.append_predictions(stamped.filter("account_id < 'k2'"), path)
    assert [r["n"] for r in predictions.read_runs(spark, path).collect()] == [2]
    assert sorted(r["account_id"] for r in predictions.read_predictions(spark, path, run_id="r: 1/ü").collect()) == ["k0", "k1"]
    # The six folders of the first attempt are in no run's record.
    assert predictions.drop_replaced(spark, path) == 6
    assert predictions.drop_replaced(spark, path) == 0
    assert predictions.read_predictions(spark, path).count() == 2


def test_a_broken_attempt_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "predictions")
    good = scored(spark, ("a", 0.9))
    predictions.write_predictions(good, path, run_id="r1", source_table="t", scored_at=WHEN)
    with monkeypatch.context() as m:
        # The job ends between the rows and the record.
        m.setattr(predictions, "_rows", lambda *_: 1 / 0)
        for run in ("r1", "r2"):
            with pytest.raises(ZeroDivisionError):
                predictions.write_predictions(scored(spark, ("b", 0.1), ("c", 0.2)), path, run_id=run, source_table="t", scored_at=WHEN)
    assert [r["account_id"] for r in predictions.read_predictions(spark, path).collect()] == ["a"]
    predictions.write_predictions(scored(spark, ("b", 0.1)), path, run_id="r2", source_table="t", scored_at=WHEN)
    assert sorted(r["account_id"] for r in predictions.read_predictions(spark, path).collect()) == ["a", "b"]
    assert predictions.drop_replaced(spark, path) == 2


def test_null_probability_is_refused(spark, tmp_path):
    rows = local_frame(spark, [("a", None, 0, 0.5, "m", "v")], SCORED)
    with pytest.raises(Exception, match="probability must not be NULL"):
        predictions.write_predictions(rows, str(tmp_path / "p"), run_id="r", source_table="t")


def test_run_ids_look_like_time_and_hex():
    assert len(predictions.new_run_id()) == len("20260701T060000Z-0123abcd")
    assert predictions.new_run_id() != predictions.new_run_id()


def test_requests_carry_features_and_id(spark):
    lines = jsonl.request_lines(customers(spark, {"customerID": "x"}).drop("Churn"), TELCO).collect()
    instance = json.loads(lines[0]["value"])["instances"][0]
    assert instance["customerID"] == "x"
    assert set(instance) == {*TELCO.feature_columns(), "customerID"}
    assert instance["Partner"] == "True"


def test_responses_are_flattened(spark):
    lines = [
        '{"predictions": [{"account_id": "a", "probability": 0.2}, {"account_id": "b", "flag": 1}]}',
        "",
        "   ",
        '{"account_id": "c", "probability": 0.7}',
        '{"predictions": []}',
    ]
    rows = jsonl.parse_jsonl(local_frame(spark, [(x,) for x in lines], "value string"), jsonl.response_item())
    got = {r["account_id"]: (r["probability"], r["flag"]) for r in rows.collect()}
    assert got == {"a": (0.2, None), "b": (None, 1), "c": (0.7, None)}


def test_malformed_response_fails(spark):
    lines = local_frame(spark, [("{not json",)], "value string")
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.parse_jsonl(lines, jsonl.response_item()).collect()


def test_batch_output_folder(spark, tmp_path):
    nested = tmp_path / "out" / "part"
    nested.mkdir(parents=True)
    (tmp_path / "out" / "note.txt").write_text("not json\n")
    (nested / "a.jsonl").write_text('{"predictions": [{"account_id": "a", "probability": 0.2}]}\n\n')
    assert jsonl.load_batch_output(spark, str(tmp_path / "out")).count() == 1
    (nested / "a.jsonl").write_text('{"predictions": []}\n')
    with pytest.raises(FileNotFoundError):
        jsonl.load_batch_output(spark, str(tmp_path / "out"))
    (nested / "a.jsonl").write_text('{"probability": 0.2}\n')
    with pytest.raises(Exception, match="without account_id"):
        jsonl.load_batch_output(spark, str(tmp_path / "out")).collect()


def log(spark, *rows):
    return local_frame(
        spark,
        [(i, p, int(p >= 0.5), 0.5, "m", "v", run, "t", datetime(2026, 1, day)) for i, p, run, day in rows],
        LOG,
    )


def test_latest_by_time_then_run(spark):
    table = log(spark, ("a", 0.1, "r1", 1), ("a", 0.2, "r3", 2), ("a", 0.3, "r2", 2), ("b", 0.4, "r1", 1))
    got = {r["account_id"]: r["probability"] for r in scores.latest_scores(table).collect()}
    assert got == {"a": 0.2, "b": 0.4}
    assert scores.latest_scores(table).columns == table.columns


def test_hot_key_sends_one_row_per_task(spark):
    table = materialise(log(spark, ("a", 0.1, "r1", 1)), "log")
    plan = scores.latest_scores(table)._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning(account_id")
    assert "Final" in before and "WindowGroupLimit" in after and "Partial" in after


def test_cache_round_trip(spark, tmp_path):
    path = str(tmp_path / "cache")
    table = log(spark, ("a", 0.72, "r1", 1), ("a", 0.15, "r0", 1), ("b", 0.3, "r1", 1))
    jsonl.export_cache(table, path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert len(lines) == 2
    assert all(list(json.loads(x)) == sorted(json.loads(x)) for x in lines)
    cache = jsonl.load_cache(spark, path)
    assert tables.lookup_one(cache, "account_id", "a").first()["probability"] == 0.72
    with pytest.raises(KeyError, match="not-there"):
        tables.lookup_one(cache, "account_id", "not-there")
    with pytest.raises(ValueError, match="No predictions"):
        jsonl.export_cache(table.limit(0), path)


def test_cache_with_two_lines_for_a_key(spark, tmp_path):
    jsonl.write_cache(log(spark, ("a", 0.1, "r1", 1), ("a", 0.9, "r2", 2)), str(tmp_path / "c"))
    assert jsonl.load_cache(spark, str(tmp_path / "c")).first()["probability"] == 0.9


def test_lookup_of_many_keys(spark):
    keys = local_frame(spark, [("a",), ("z",)], "account_id string")
    got = tables.lookup_keys(log(spark, ("a", 0.1, "r1", 1)), keys, "account_id").collect()
    assert {r["account_id"]: r["found"] for r in got} == {"a": True, "z": False}


def test_threshold_is_inclusive(spark):
    df = local_frame(spark, [(0.5,), (0.4999,)], "probability double")
    assert [r["flag"] for r in scores.threshold_flag(df, 0.5).collect()] == [1, 0]


def test_parity_counts_differences_without_pairing_copies(spark):
    left = local_frame(spark, [("a", 0.5, 1), ("a", 0.5, 1), ("b", 0.2, 0), ("c", 0.1, 0)], "account_id string, probability double, flag int")
    right = local_frame(spark, [("a", 0.5, 1), ("a", 0.5, 1), ("b", 0.3, 1), ("d", 0.1, 0)], "account_id string, probability double, flag int")
    assert tuple(scores.score_parity(left, right).first()) == (2, 1, 1, 1, 1)
    assert tuple(scores.score_parity(left, left).first()) == (3, 0, 0, 0, 0)


def test_metrics_of_a_run_are_replaced(spark, tmp_path):
    path = str(tmp_path / "m")
    for run, value in (("r1", 0.1), ("r2", 0.2), ("r1", 0.3)):
        metrics.write_metrics(metrics.metrics_frame(spark, [(run, "m", "test", "f1", value)]), path)
    rows = {r["run_id"]: r["value"] for r in metrics.read_metrics(spark, path).collect()}
    assert rows == {"r1": 0.3, "r2": 0.2}


def long(spark, rows):
    return local_frame(spark, rows, "model string, metric string, value double")


def test_deltas(spark):
    current = long(spark, [("a", "f1", 0.61234), ("b", "f1", 0.5)])
    base = long(spark, [("a", "f1", 0.6), ("c", "f1", 0.9)])
    got = {r["model"]: (r["baseline_value"], r["delta"]) for r in deltas.baseline_delta(current, base).collect()}
    assert got == {"a": (0.6, 0.0123), "b": (None, 0.5)}
    both = deltas.feature_set_delta(current, base).collect()
    assert [(r["model"], r["delta"]) for r in both] == [("a", -0.0123)]
    assert deltas.recommend_feature_set(current, base, "f1").first()["recommendation"] == "probe_selected"
    assert deltas.recommend_feature_set(base, current, "f1").first()["recommendation"] == "full"


def test_first_model_wins_ties(spark):
    rows = [("b", 0, "cv_score", 0.5), ("a", 1, "cv_score", 0.5), ("c", 2, "cv_score", 0.4)]
    df = local_frame(spark, rows, "model string, position int, metric string, value double")
    assert deltas.select_winner(df).first()["model"] == "b"


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    folder = shared_dir(spark)
    assert folder
    table = materialise(spark.range(3).withColumn("k", F.col("id") % 2), "t", ["k"])
    assert folder in table.inputFiles()[0]
    assert table.count() == 3


def test_customers_are_never_broadcast(spark, tmp_path):
    """However small their file: as rows in the driver they grow with the input."""
    times = "timestamp_ntz'2000-01-05 00:00:00'", "timestamp_ntz'2000-03-05 00:00:00'", "timestamp_ntz'2000-12-01 00:00:00'"
    written = {
        # Customer 2 comes twice, 3 has no order, 4 none before the cutoff, and one has no key.
        "customer": "select * from values (1L, 0, 5D, 'A'), (2L, 1, -5D, 'B'), (2L, 1, 7D, 'B'), (3L, 0, 1D, 'A'), (4L, 0, 1D, 'A'),"
        " (null, 0, 1D, 'A') t(c_custkey, c_nationkey, c_acctbal, c_mktsegment)",
        "orders": f"select * from values (1L, 10D, {times[0]}), (1L, 20D, {times[1]}), (1L, 30D, {times[2]}), (2L, 40D, {times[0]}),"
        f" (4L, 50D, {times[2]}), (null, 60D, {times[0]}) t(o_custkey, o_totalprice, o_orderdate)",
        "nation": "select * from values (0, 0), (1, 1) t(n_nationkey, n_regionkey)",
    }
    for table, rows in written.items():
        spark.sql(rows).write.parquet(f"{tmp_path}/{table}.parquet")
    view = views.accounts(spark, str(tmp_path))
    kept = view.orderBy("account_id", "in_debt").select("account_id", "in_debt", "partner", "tenure", "monthly", "total_text", "label")
    assert [tuple(r) for r in kept.collect()] == [
        ("1", 0, True, 2, 15.0, "30.00", "No"), ("2", 0, False, 0, 40.0, " ", "Yes"), ("2", 1, False, 0, 40.0, " ", "Yes")
    ]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "SortMergeJoin [c_custkey" in final
    assert "BroadcastHashJoin [c_custkey" not in plan
