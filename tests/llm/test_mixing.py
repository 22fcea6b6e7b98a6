"""Rates against a dense solution, and what is left of targets that cannot be met."""

import numpy as np
import pytest

from tidemark.llm import mixing


def members(spark, n, posterior):
    rows = [(int(t), [float(x) for x in p]) for t, p in zip(n, posterior)]
    return spark.createDataFrame(rows, "n_tokens long, posterior array<double>")


def shares(n, posterior, rates):
    return (n * rates) @ posterior / n.sum()


def test_rates_meet_the_targets_nearest_to_one(spark):
    """Equality-constrained least squares on the positive rates has the same solution."""
    rng = np.random.default_rng(4)
    n = rng.integers(1, 500, 300)
    posterior = rng.dirichlet([2, 1, 1], 300)
    target = shares(n, posterior, np.ones(300)) * [0.9, 1.3, 0.95]
    target /= target.sum()
    settings = mixing.Settings(targets=dict(zip("abc", map(float, target))))
    steps, error = mixing.fit(members(spark, n, posterior), ("a", "b", "c"), settings)
    assert error <= settings.tolerance
    rates = np.ones(300)
    for step in steps:
        rates = np.maximum(0, rates - posterior @ step)
    assert shares(n, posterior, rates) == pytest.approx(target, abs=2 * settings.tolerance)
    # no rate is at zero here: the token-weighted nearest solution is one linear step
    assert (rates > 0).all()
    metric = (posterior * n[:, None]).T @ posterior / n.sum()
    dense = 1 - posterior @ np.linalg.solve(metric, shares(n, posterior, np.ones(300)) - target)
    assert rates == pytest.approx(dense, abs=1e-4)


def test_targets_out_of_reach_leave_an_error(spark):
    """Every document is half and half: no rates make one domain nine tenths."""
    settings = mixing.Settings(targets={"a": 0.9, "b": 0.1}, steps=8)
    _, error = mixing.fit(members(spark, np.full(20, 10), np.full((20, 2), 0.5)), ("a", "b"), settings)
    assert error > 0.1


def test_nothing_to_fit(spark):
    empty = members(spark, [], np.zeros((0, 2)))
    assert mixing.fit(empty, ("a", "b"), mixing.Settings(targets={"a": 0.5, "b": 0.5}))[1] == 0
    assert mixing.fit(empty, ("a",), mixing.Settings(targets={"a": 1.0})) == ([], 0.0)
