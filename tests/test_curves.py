from __future__ import annotations

import math
import random

import pytest

from tidemark.operators import curves, fairness, ranking
from tidemark.session import local_frame


def scored(spark, pairs):
    return local_frame(spark, [(int(y), float(p)) for y, p in pairs], "y int, p double")


def brute_curve(pairs):
    """Points (threshold, precision, recall) by counting at each distinct score."""
    total = sum(y for y, _ in pairs)
    points = []
    for t in sorted({p for _, p in pairs}):
        flagged = [y for y, p in pairs if p >= t]
        points.append((t, sum(flagged) / len(flagged), sum(flagged) / total if total else 1.0))
    return points


def brute_scores(pairs):
    points = sorted(brute_curve(pairs), reverse=True)
    ap, last = 0.0, 0.0
    for _, precision, recall in points:
        ap += (recall - last) * precision
        last = recall
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return ap, wins / (len(pos) * len(neg))


def random_pairs(seed, n=300, levels=40):
    rng = random.Random(seed)
    pairs = []
    for _ in range(n):
        y = int(rng.random() < 0.3)
        p = 0.5 if rng.random() < 0.33 else rng.randrange(levels) / levels
        pairs.append((y, min(1.0, p + 0.1 * y)))
    return pairs


@pytest.mark.parametrize("per_bucket", [500_000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_curve_and_areas_match_counting(spark, monkeypatch, seed, per_bucket):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", per_bucket)
    pairs = random_pairs(seed)
    df = scored(spark, pairs)
    got = sorted(tuple(r) for r in curves.pr_curve(df).collect() if r["threshold"] is not None)
    want = brute_curve(pairs)
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[1:] == pytest.approx(w[1:])
    ap, auc = brute_scores(pairs)
    row = curves.evaluate(df, 0.5).first()
    assert row["pr_auc"] == pytest.approx(ap)
    assert row["roc_auc"] == pytest.approx(auc)


def test_closing_point(spark):
    ends = [r for r in curves.pr_curve(scored(spark, [(1, 0.4), (0, 0.2)])).collect() if r[0] is None]
    assert [tuple(r) for r in ends] == [(None, 1.0, 0.0)]


def test_f2_is_at_least_f1_on_the_example(spark):
    df = scored(spark, zip([1, 1, 0, 0, 0], [0.9, 0.8, 0.4, 0.3, 0.1], strict=True))
    row = curves.evaluate(df, 0.5).first()
    assert row["f2"] >= row["f1"] == 1.0
    assert row["mcc"] == 1.0


def test_average_precision_is_the_step_sum(spark):
    pairs = list(zip([0, 0, 1, 1, 0, 1], [0.1, 0.4, 0.35, 0.8, 0.8, 0.6], strict=True))
    row = curves.evaluate(scored(spark, pairs), 0.5).first()
    assert row["pr_auc"] == pytest.approx(brute_scores(pairs)[0])


RECALL_CASE = list(
    zip(
        [1, 1, 1, 1, 0, 0, 0, 0, 0, 0],
        [0.95, 0.85, 0.75, 0.55, 0.45, 0.35, 0.25, 0.15, 0.10, 0.05],
        strict=True,
    )
)


def test_recall_floor(spark):
    row = curves.best_threshold(scored(spark, RECALL_CASE), strategy="recall_floor", recall_floor=0.75).first()
    assert row["recall"] >= 0.75
    assert row["precision"] >= 0.5


@pytest.mark.parametrize("strategy", curves.STRATEGIES)
@pytest.mark.parametrize("seed", [3, 4])
def test_threshold_is_the_first_maximum(spark, strategy, seed):
    pairs = random_pairs(seed, 120, 15)
    tiny = 1e-12
    value = {
        "f1": lambda p, r: 2 * p * r / (p + r + tiny),
        "f2": lambda p, r: 5 * p * r / (4 * p + r + tiny),
        "recall_floor": lambda p, r: p if r >= 0.75 else -1.0,
    }[strategy]
    points = brute_curve(pairs)
    best = max(value(p, r) for _, p, r in points)
    want = next(t for t, p, r in points if value(p, r) == best)
    assert curves.best_threshold(scored(spark, pairs), strategy=strategy).first()["threshold"] == want


def test_unreachable_floor_falls_back_to_most_recall(spark):
    row = curves.best_threshold(scored(spark, RECALL_CASE), strategy="recall_floor", recall_floor=1.5).first()
    assert (row["recall"], row["threshold"]) == (1.0, 0.05)


def test_empty_curve_gives_the_default_threshold(spark):
    empty = spark.createDataFrame([], "y int, p double")
    assert curves.pick_threshold(curves.score_counts(empty)) == 0.5
    with pytest.raises(ValueError, match="threshold strategy"):
        curves.best_threshold(empty, strategy="other")


def test_published_confusion_matrix(spark):
    counts = spark.createDataFrame([(614, 163, 81, 199)], "tn long, fp long, fn long, tp long")
    row = curves.with_rates(counts).first()
    assert round(row["precision"], 4) == 0.5497
    assert round(row["recall"], 4) == 0.7107
    assert round(row["f1"], 4) == 0.6199
    assert round(row["f2"], 4) == 0.6714


def test_nothing_flagged(spark):
    row = curves.evaluate(scored(spark, [(1, 0.2), (0, 0.1)]), 0.9).first()
    assert (row["precision"], row["recall"], row["f1"], row["mcc"]) == (0.0, 0.0, 0.0, 0.0)
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 0, 1, 0)


def test_no_positives(spark):
    df = scored(spark, [(0, 0.2), (0, 0.1)])
    row = curves.evaluate(df, 0.5).first()
    assert row["pr_auc"] == 0.0
    assert row["roc_auc"] is None
    assert math.isnan(curves.pr_summary(df, 0.5).first()["lift_over_random"])


@pytest.mark.parametrize("bad", [(None, 0.5), (1, None), (1, float("nan"))])
def test_missing_label_or_score_fails(spark, bad):
    df = spark.createDataFrame([(1, 0.5), bad], "y int, p double")
    with pytest.raises(Exception, match="is missing"):
        curves.evaluate(df, 0.5).collect()


def test_metric_names(spark):
    assert curves.resolve_metric("average_precision") == "pr_auc"
    assert curves.resolve_metric("F1") == "f1"
    with pytest.raises(ValueError, match="Unknown metric"):
        curves.resolve_metric("accuracy")


def people(spark, rows):
    return local_frame(spark, rows, "id string, gender string")


def fair_scores(spark):
    return local_frame(
        spark,
        [("a", 1, 0.9), ("a", 0, 0.8), ("b", 1, 0.2), ("c", 0, 0.1)],
        "id string, y int, p double",
    )


def test_fairness_by_joined_group(spark):
    groups = people(spark, [("a", "F"), ("b", "M"), ("c", "M"), ("d", "F")])
    rows = fairness.fairness_join(fair_scores(spark), groups, "id", ["gender"], 0.5).collect()
    assert [tuple(r)[1:] for r in rows] == [("F", 2, 0.5, 1.0, 1.0, 0.5), ("M", 2, 0.5, 0.0, 0.0, 0.0)]


def test_fairness_without_demographics_fails(spark):
    groups = people(spark, [("a", "F"), ("b", "M")])
    with pytest.raises(Exception, match="No demographics for id c"):
        fairness.fairness_join(fair_scores(spark), groups, "id", ["gender"], 0.5).collect()
    row = fairness.unmatched(fair_scores(spark), groups, "id").first()
    assert tuple(row) == (1, 0)


def test_fairness_with_ambiguous_demographics_fails(spark):
    groups = people(spark, [("a", "F"), ("a", "M"), ("b", "M"), ("c", "M")])
    with pytest.raises(Exception, match="Two demographics rows for id a"):
        fairness.fairness_join(fair_scores(spark), groups, "id", ["gender"], 0.5).collect()
    assert tuple(fairness.unmatched(fair_scores(spark), groups, "id").first()) == (0, 1)
