"""The forest as a table: scores, importances and the forecast equal those of the model."""

from __future__ import annotations

import pytest
from conftest import MEDIUM
from pyspark.ml.functions import vector_to_array

from envspark.ml import forecast as fc
from envspark.ml import forest, nodes
from envspark.operators import reports
from envspark.operators.features import ml_frame
from envspark.plans import pipeline
from envspark.profiles import profile_of
from envspark.sources.readings import load_readings


@pytest.fixture(scope="module", params=["full", "lite"])
def run(spark, request):
    p = profile_of(request.param)
    frame = ml_frame(pipeline.features(load_readings(spark, MEDIUM), p), p, ("reading_id",))
    train, test = reports.split_hash(frame)
    model = forest.fit_forest(train, p)
    return p, model, test.cache(), nodes.tree_nodes(model).cache()


def plain_score(table, vector):
    trees = {}
    for n in table:
        trees.setdefault(n.tree, {})[n.node] = n
    total = 0.0
    for tree in trees.values():
        n = tree[0]
        while n.feature is not None:
            x = vector[n.feature]
            n = tree[n.left if (x <= n.threshold if n.left_values is None else x in n.left_values) else n.right]
        total += n.value
    return total / len(trees)


def test_scores_equal_the_model_and_plain_python(run):
    _, model, test, table = run
    vectors = nodes.inputs(model, test)
    got = {r.reading_id: r.prediction for r in nodes.score_by_nodes(table, vectors, nodes.forest_depth(model), ["reading_id"]).collect()}
    wanted = {r.reading_id: r.prediction for r in forest.score(model, test).collect()}
    assert got == pytest.approx(wanted, rel=1e-9) and len(got) == test.count() > 1000
    rows = table.collect()
    for r in vectors.select("reading_id", vector_to_array("features").alias("v")).limit(200).collect():
        assert plain_score(rows, r.v) == pytest.approx(wanted[r.reading_id], rel=1e-9)


def test_importances_equal_the_model(run):
    p, model, test, table = run
    got = {r.feature: r.importance for r in nodes.importance_by_nodes(table, p).collect()}
    wanted = {r.feature: r.importance for r in forest.feature_importance(model, test, p).collect()}
    assert got == pytest.approx(wanted, abs=1e-9) and len(got) == len(p.features) + 1


def test_forecast_equals_the_model(spark, run):
    p, model, _, table = run
    if p.name != "full":
        pytest.skip("the scenario is the full profile's")
    frame = fc.forecast_frame(pipeline.features(load_readings(spark, MEDIUM)))
    scored = nodes.score_by_nodes(table, nodes.inputs(model, frame), nodes.forest_depth(model), ["hour"]).collect()
    assert {r.hour: round(r.prediction, 1) for r in scored} == pytest.approx(
        {r.hour: r.predicted_aqi for r in fc.forecast(model, frame).collect()}, abs=0.11)


def test_nodes_form_trees(run):
    """The table is a set of trees: every child has one parent, inner nodes have both children."""
    _, model, _, table = run
    rows = table.collect()
    inner = [n for n in rows if n.feature is not None]
    assert len({(n.tree, n.node) for n in rows}) == len(rows)
    children = [(n.tree, c) for n in inner for c in (n.left, n.right)]
    assert len(set(children)) == len(children) == len(rows) - model.stages[-1].getNumTrees
    assert all((n.threshold is None) != (n.left_values is None) for n in inner)
