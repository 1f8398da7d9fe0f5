"""Regularised boosting against plain loops over the same bins."""

import math

import numpy as np
import pytest

from tickloom.operators import boosting

CUTS = [[1.0, 2.0, 3.0], [0.5], [10.0, 20.0]]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    out = []
    for i in range(600):
        a, b, c = float(rng.integers(0, 5)), float(rng.integers(0, 2)), float(rng.integers(0, 30))
        y = round(3 * (a >= 2) - 2 * b + 0.1 * c + float(rng.normal()), 3)
        if i % 4 == 0:
            a, y = None, y + 2.5
        out.append((a, b if i % 9 else math.nan, c, y if i % 50 else None, i))
    return out, spark.createDataFrame(out, "a double, b double, c double, y double, i int").repartition(3).persist()


def plain(rows, depth, l2, rate, least):
    """The forecast of one tree, every split tried on every row."""
    x = np.array([[math.nan if v is None else v for v in r[:3]] for r in rows])
    y = np.array([r[3] for r in rows])
    base, out = y.mean(), np.zeros(len(y))

    def grow(at, level):
        g = base - y[at]
        part = lambda m: g[m].sum() ** 2 / (m.sum() + l2)
        best = (0.0, None)
        for i, cuts in enumerate(CUTS) if level < depth else ():
            v = x[at, i]
            for cut in [*cuts, math.inf]:
                for missing in (False, True):
                    left = np.where(np.isnan(v), missing, v < cut)
                    if min(left.sum(), (~left).sum()) >= least:
                        gain = part(left) + part(~left) - part(np.ones(len(at), bool))
                        best = max(best, (gain, left), key=lambda b: b[0] - 1e-9 * (b is not best))
        if best[1] is None or best[0] <= 1e-6:
            out[at] = -g.sum() / (len(at) + l2) * rate
        else:
            grow(at[best[1]], level + 1)
            grow(at[~best[1]], level + 1)

    grow(np.arange(len(y)), 0)
    return base + out


@pytest.mark.parametrize("depth", [1, 3])
def test_one_tree_equals_plain_loops(table, depth):
    rows, df = table
    model = boosting.fit(df, ["a", "b", "c"], "y", trees=1, depth=depth, input_fraction=1, row_fraction=1, cuts=CUTS)
    known = [r for r in rows if r[3] is not None]
    got = {r.i: r.p for r in model.predict(df, "p").collect()}
    want = plain(known, depth, 5, 0.1, 20)
    assert len(got) == len(rows)
    assert [got[r[4]] for r in known] == pytest.approx(list(want), abs=1e-6)


def test_same_model_from_other_partitions_and_after_saving(table):
    _, df = table
    fit = lambda d: boosting.fit(d, ["a", "b", "c"], "y", trees=7, depth=2, input_fraction=0.7, row_fraction=0.8, redraw=3, cuts=CUTS)
    model = fit(df)
    assert model == fit(df.repartition(7, "c"))
    assert boosting.BoostedTrees.from_json(model.to_json()) == model
    assert len({tuple(sorted({s.input for s in t.splits.values()})) for t in model.trees}) > 1


def test_error_falls_with_quantile_cuts(table):
    _, df = table
    errors = []
    for trees in (0, 5, 20):
        model = boosting.fit(df, ["a", "b", "c"], "y", trees=trees, depth=3)
        errors.append(model.predict(df, "p").selectExpr("avg(pow(p - y, 2))").first()[0])
    assert errors[2] < 0.5 * errors[0] and errors[2] < errors[1] < errors[0]


def test_odd_tables(spark):
    schema = "`a.b` double, y double"
    empty = boosting.fit(spark.createDataFrame([], schema), ["a.b"], "y", trees=2)
    assert (empty.base, empty.trees) == (0.0, [])
    flat = spark.createDataFrame([(None, 2.0), (None, 4.0), (math.nan, None)], schema)
    model = boosting.fit(flat, ["a.b"], "y", trees=2)
    assert [r.p for r in model.predict(flat, "p").collect()] == [3.0] * 3
    zero = spark.createDataFrame([(float(i), 0.0) for i in range(50)], schema)
    assert {r.p for r in boosting.fit(zero, ["a.b"], "y", trees=2).predict(zero, "p").collect()} == {0.0}
