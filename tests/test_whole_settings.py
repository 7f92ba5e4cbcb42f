"""The registered training queries ask for the operators' own settings."""

from __future__ import annotations

import pytest

from tidemark.catalog import model_queries
from tidemark.plans import estimators, experiment, explain, training


class Asked(Exception):
    """What a query asked its operator for, before any work."""


@pytest.fixture
def asked(monkeypatch):
    def stop(*args, **kwargs):
        raise Asked(args, kwargs)

    class Rows:
        def part(self, split):
            return None

    monkeypatch.setattr(model_queries, "rows_of", lambda *args: Rows())
    monkeypatch.setattr(model_queries, "accounts", lambda *args: None)
    monkeypatch.setattr(model_queries, "work_path", lambda *args: "")
    for module, names in (
        (training, ("train_one", "train_suite", "grid_search")), (explain, ("probe_audit",)), (experiment, ("run_training",))
    ):
        for name in names:
            monkeypatch.setattr(module, name, stop)

    def ask(query):
        with pytest.raises(Asked) as caught:
            query(None, "")
        return caught.value.args

    return ask


def settings(spec):
    wanted = estimators.FOREST_DEFAULTS if spec.name == estimators.FOREST else estimators.BOOSTER_DEFAULTS
    return {k: spec.classifier.getOrDefault(k) for k in wanted} == wanted


@pytest.mark.usefixtures("spark")
def test_trees_are_the_defaults(asked):
    for name in ("train_random_forest", "train_gbt_a", "train_gbt_b"):
        assert settings(asked(getattr(model_queries, name))[0][0])
    for name in ("train_suite", "suite_winner", "suite_champion"):
        specs = asked(getattr(model_queries, name))[0][0]
        assert [s.name for s in specs] == list(estimators.MODELS) and all(map(settings, specs[1:]))
    for name in ("probe_audit", "probe_kept"):
        assert asked(getattr(model_queries, name))[1] == {}


@pytest.mark.usefixtures("spark")
def test_grids_and_runs_are_whole(asked):
    assert len(asked(model_queries.cv_score)[0][0].grid) == 32
    for name, maps in (("grid_search", 32), ("grid_search_forest", 32), ("grid_search_gbt_a", 12), ("grid_search_gbt_b", 12)):
        spec = asked(model_queries.QUERIES[name])[0][0]
        assert settings(spec) and len(spec.grid) == maps
    args, options = asked(model_queries.WHOLE["training_run_whole"])
    assert options["settings"] == training.RunSettings(probe_train=True)
    assert not {"models", "forest", "booster"} & set(options)
    assert asked(model_queries.training_run)[1]["settings"].run_shap
