"""Models of a suite, and suites of a run, are trained at the same time."""

from __future__ import annotations

import threading

import pytest

from tests.telco import population
from tidemark.plans import estimators, experiment, explain, training
from tidemark.roles import BASELINE, TELCO
from tidemark.session import local_frame

# Seconds that one waits for the others; only a sequence of them waits that long.
PATIENCE = 20


class Met(Exception):
    """All were there at once."""


@pytest.fixture(scope="module")
def data(spark):
    return training.prepare(population(spark, 120), TELCO, BASELINE, folds=3)


def test_models_of_a_suite_train_at_once_in_their_order(monkeypatch, data):
    specs = estimators.model_specs(TELCO, tune=False)
    barrier, asked = threading.Barrier(len(specs), timeout=PATIENCE), []

    def one(spec, rows, roles, **options):
        barrier.wait()
        asked.append(options)
        return spec.name.upper()

    monkeypatch.setattr(training, "train_one", one)
    trained = training.train_suite(iter(specs), data, TELCO, folds=3, strategy="f2")
    assert list(trained.items()) == [(s.name, s.name.upper()) for s in specs]
    assert all((o["folds"], o["strategy"], o["ledger"], o["parallelism"]) == (3, "f2", None, None) for o in asked)
    assert training.train_suite([], data, TELCO) == {}


def test_parallelism_bounds_the_models_at_a_time(monkeypatch, data):
    lock, seen = threading.Lock(), []

    def one(spec, rows, roles, **options):
        assert lock.acquire(blocking=False)
        seen.append((spec.name, options["parallelism"]))
        lock.release()

    monkeypatch.setattr(training, "train_one", one)
    training.train_suite(estimators.model_specs(TELCO, tune=False), data, TELCO, parallelism=1)
    assert seen == [(name, 1) for name in estimators.MODELS]


def test_models_share_one_ledger(monkeypatch, data, tmp_path):
    ledgers = []
    monkeypatch.setattr(training, "train_one", lambda *args, **options: ledgers.append(options["ledger"]))
    training.train_suite(estimators.model_specs(TELCO, tune=False), data, TELCO, ledger=str(tmp_path / "ledger"))
    assert len(ledgers) == 4 and len({id(own) for own in ledgers}) == 1
    assert isinstance(ledgers[0], training.Ledger) and ledgers[0].path == str(tmp_path / "ledger")


def test_suites_of_a_run_train_at_once(monkeypatch, spark, tmp_path):
    barrier, selected = threading.Barrier(2, timeout=PATIENCE), []

    def suite(specs, *args, **options):
        selected.append(len(specs[0].prep.getOrDefault("selected")))
        barrier.wait()
        raise Met

    audit = local_frame(spark, [("tenure", False, 0.1)], "feature string, probe boolean, threshold double")
    monkeypatch.setattr(training, "train_suite", suite)
    monkeypatch.setattr(explain, "probe_audit", lambda *args, **options: audit)
    monkeypatch.setattr(explain, "probe_kept", lambda audit: ["tenure"])
    monkeypatch.setattr(explain, "probe_correlations", lambda *args: audit)
    settings = training.RunSettings(tune=False, probe_train=True, folds=3)
    with pytest.raises(Met):
        experiment.run_training(population(spark, 120), TELCO, str(tmp_path / "run"), settings=settings)
    assert sorted(selected) == [0, 1]
