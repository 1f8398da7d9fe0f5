import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import features

N = 60


@pytest.fixture(scope="module")
def days(spark):
    rng = np.random.default_rng(5)
    out = []
    for symbol in ("A_USDT_X", "B_USDT_X"):
        spot = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, N)))
        for i in range(N):
            futures = None if i % 9 == 4 else float(spot[i] * (1 + rng.normal(0, 0.001)))
            out.append((symbol, dt.date(2024, 1, 1) + dt.timedelta(i), float(spot[i]), futures, 10.0 + i, 5.0))
    schema = "symbol_id string, date date, close_spot double, close_futures double, volume_spot double, volume_futures double"
    return spark.createDataFrame(out, schema)


def series(df, symbol="A_USDT_X"):
    return df.where(F.col("symbol_id") == symbol).toPandas().sort_values("date").reset_index(drop=True)


def test_returns_against_pandas(days):
    got = series(features.returns_features(days))
    r = got.close_spot.pct_change()
    np.testing.assert_allclose(got.spot_returns_1, r, rtol=1e-9)
    np.testing.assert_allclose(got.spot_returns_1_mean_30, r.rolling(30, min_periods=1).mean(), rtol=1e-7, atol=1e-12)
    std = r.rolling(30, min_periods=2).std()
    np.testing.assert_allclose(got.spot_returns_1_std_30, std, rtol=1e-7)
    share = r.rolling(30, min_periods=1).apply(lambda w: (w.dropna() <= w.iloc[-1]).mean(), raw=False)
    np.testing.assert_allclose(got.spot_returns_1_percentile_30, share, rtol=1e-9)


def test_drawdown_against_pandas(days):
    got = series(features.risk_features(days))
    deepest = got.close_spot.rolling(30, min_periods=1).apply(lambda w: (w / w.cummax() - 1).min(), raw=False)
    np.testing.assert_allclose(got.spot_max_drawdown_30, deepest, atol=1e-12)


def test_zscores_against_window_functions(days):
    got = features.rolling_zscore(days, windows=(10,))
    frame = "OVER (PARTITION BY symbol_id ORDER BY date ROWS 9 PRECEDING)"
    for c in ("close_futures", "volume_spot"):
        want = f"({c} - avg({c}) {frame}) / nullif(stddev_samp({c}) {frame}, 0D)"
        both = got.selectExpr(f"{c}_rz_10 AS a", f"{want} AS b")
        assert both.where("a IS NOT NULL").count() > 0
        assert both.where("(a IS NULL) <> (b IS NULL) OR abs(a - b) > 1e-9").count() == 0


def test_constant_series_has_no_zscore(days):
    got = features.rolling_zscore(days, ["volume_futures"])
    assert got.where("volume_futures_rz_30 IS NOT NULL").count() == 0


def test_steps_chain_and_keep_rows(days):
    made = features.build_features(days, features.feature_steps(None))
    assert made.count() == 2 * N
    assert {"day_of_week", "futures_returns_7", "basis_delta_1", "basis_rz_30"} <= set(made.columns)
    monday = made.where("date = DATE'2024-01-01'").first()
    assert monday["day_of_week"] == 0 and monday["day_of_month"] == 1


def test_user_step(days):
    made = features.build_features(days, [features.time_features, lambda df: df.withColumn("one", F.lit(1))])
    assert made.columns[-1] == "one"


def test_rows_must_be_unique(days):
    assert features.repeated_days(days).count() == 0
    twice = days.union(days.where("symbol_id = 'B_USDT_X' AND date = DATE'2024-01-05'"))
    (found,) = features.repeated_days(twice).collect()
    assert tuple(found) == ("B_USDT_X", dt.date(2024, 1, 5), 2)
    assert features.build_features(days, [features.time_features]).count() == 2 * N
    with pytest.raises(Exception, match="more than one row for B_USDT_X on 2024-01-05"):
        features.build_features(twice, [features.time_features]).collect()


def test_zscores_stay_in_the_engine(days):
    made = features.build_features(days, features.feature_steps(None))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "InPandas" not in plan


def test_zscores_of_missing_and_infinite_values(spark):
    x = [1.0, None, float("nan"), 3.0, float("inf"), 2.0, 2.0, 2.0, 2.0]
    rows = [("S", dt.date(2024, 1, 1 + i), v, None) for i, v in enumerate(x)]
    made = spark.createDataFrame(rows, "symbol_id string, date date, v double, nothing double")
    got = series(features.rolling_zscore(made, ["v", "nothing"], (3, 4)), "S")
    assert got.nothing_rz_3.isna().all()
    assert got.v_rz_4[3] == pytest.approx(1 / 2**0.5) and got.v_rz_4[[0, 1, 2, 4, 5, 6, 7]].isna().all()
    assert got.v_rz_3.isna().all()
