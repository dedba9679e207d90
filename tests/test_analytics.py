"""Counts, networks and statistics on small tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest

from taxograph.operators import analytics, stats


def test_degrees_of_a_multigraph_with_a_loop(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "c"), ("x", None)], "s string, t string")
    assert {tuple(r) for r in analytics.degrees(e, "s", "t").collect()} == {("a", 0, 1, 1), ("b", 1, 0, 1), ("c", 1, 1, 2)}
    assert {tuple(r) for r in analytics.edge_weights(e, "s", "t").collect()} == {("a", "b", 2), ("c", "c", 1)}


def test_network_prefers_interactions(spark):
    t = spark.createDataFrame([("a", "b"), ("a", "leaf"), (None, "leaf")], "sourceName string, tryDataLab string")
    m = spark.createDataFrame([("a", "b"), ("a", "sugar")], "sourceName string, wd_chem string")
    i = spark.createDataFrame([("b", "a"), ("a", None)], "sourceName string, targetName string")
    edges = {(r.a, r.b): r.edge_type for r in analytics.network(t, m, i).collect()}
    assert edges == {("a", "b"): "interaction", ("a", "leaf"): "trait", ("a", "sugar"): "metabolite"}
    assert [r.species for r in analytics.species_sets(t, m, i, common=True).collect()] == ["a"]
    assert {tuple(r) for r in analytics.completeness(t, m, i).collect()} == {("a", 3), ("b", 1)}
    summary = analytics.network_summary(analytics.network(t, m, i), analytics.species_sets(t, m, i, common=False)).first()
    assert (summary.n_nodes, summary.n_species, summary.n_edges) == (4, 2, 3)


def test_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", None), (None, "x")], "k string, v string")
    assert [tuple(r) for r in analytics.value_counts(df, "k", 2).collect()] == [("a", 2), ("b", 1)]
    assert {tuple(r) for r in analytics.summary(df, "k", "v").collect()} == {("a", 2, 2), ("b", 1, 1), ("c", 1, 0)}
    cross = {r.k: r.asDict() for r in analytics.crosstab_top(df, "k", "v", 3, 2).collect()}
    assert cross["a"] == {"k": "a", "x": 1, "y": 1} and cross["c"] == {"k": "c", "x": 0, "y": 0}
    nodes, links = analytics.sankey(df, ["k", "v"])
    assert nodes.count() == 5 and links.count() == 3
    assert analytics.synonym(df, ("zz", "v")) == "v"
    with pytest.raises(ValueError):
        analytics.synonym(df, ("zz",))


def test_rank_correlation_with_ties(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 40, 3000), rng.integers(0, 700, 3000)
    df = spark.createDataFrame([(int(x), float(y)) for x, y in zip(a, b, strict=True)] + [(1, None)], "a int, b double")
    r, n = stats.spearman(df, "a", "b").first()
    want = np.corrcoef(pd.Series(a).rank(), pd.Series(b).rank())[0, 1]
    assert n == 3000 and abs(r - want) < 1e-9
    assert abs(stats.correlation_p(spark, 0.5, 20) - 0.02474) < 1e-4
    assert stats.correlation_p(spark, 1.0, 9) == 0.0 and math.isnan(stats.correlation_p(spark, 0.1, 2))


def test_principal_components(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=200)
    x = np.column_stack([base + 0.1 * rng.normal(size=200), -base + 0.1 * rng.normal(size=200), rng.normal(size=200)])
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x)], "id int, SLA double, b double, c double")
    scores, ratio, loads = stats.pca(df, ["SLA", "b", "c"], 2, "SLA")
    z = (x - x.mean(0)) / x.std(0)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    sign = np.sign(vt[0, 0])
    got = np.array([r.pc1 for r in scores.orderBy("id").collect()])
    assert np.allclose(got, sign * u[:, 0] * s[0], atol=1e-6) and np.allclose(ratio, (s**2 / (s**2).sum())[:2]) and loads[0][0] > 0
    classes = stats.strategies(df, ["SLA", "b", "c"]).groupBy("strategy").count().collect()
    assert {r.strategy for r in classes} == {"Conservative", "Intermediate", "Acquisitive"}
    assert np.allclose(stats.correlation_matrix(df, ["SLA", "b"]), np.corrcoef(x[:, :2].T))


def test_trait_matrix_and_histogram(spark):
    df = spark.createDataFrame([("a", "t", "1"), ("a", "t", "3"), ("a", "u", "x"), ("a", "u", "2"), ("b", "t", "1")], "s string, t string, v string")
    assert [tuple(r) for r in stats.trait_matrix(df, "s", "t", "v", ["t", "u"]).collect()] == [("a", 2.0, 2.0)]
    h = stats.histogram(spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double"), "v", 5).orderBy("bin").collect()
    assert [r.n for r in h] == [2, 0, 0, 0, 1]
    assert stats.histogram(spark.createDataFrame([], "v double"), "v", 5).count() == 0


@pytest.mark.parametrize("few", [2, 10_000])
def test_median_by_refined_bins(spark, monkeypatch, few):
    monkeypatch.setattr(stats, "FEW", few)
    rng, inf = random.Random(2), float("inf")
    cases = [[], [None], [3.0], [1.0, 2.0], [5.0] * 50, [1e308, -1e308, 0.0, 1e-308], [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 7.0], [-inf, -inf, 1.0, 2.0], [inf, inf, 1.0], [rng.gauss(0, 1e6) for _ in range(501)], [float(rng.randrange(5)) for _ in range(200)] + [None] * 7, [rng.lognormvariate(0, 9) for _ in range(300)]]
    for values in cases:
        held = sorted(v for v in values if v is not None)
        expected = None if not held else held[len(held) // 2] if len(held) % 2 else (held[len(held) // 2 - 1] + held[len(held) // 2]) / 2
        assert stats.median_of(spark.createDataFrame([(v,) for v in values], "v double").repartition(3), "v").first()[0] == expected, values[:5]
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "v double")
    assert stats.kth_values(nan, "v", [0, 1]) == [1.0, 2.0] and stats.kth_values(nan, "v", [2])[0] != stats.kth_values(nan, "v", [2])[0]
