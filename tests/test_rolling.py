import pytest
from pyspark.sql import functions as F

from tickloom.operators.aggregate import daily_trade_stats
from tickloom.operators.rolling import rolling_trade_features
from views import load_views


@pytest.fixture(scope="module")
def stats(spark, sf_dir):
    df = daily_trade_stats(load_views(spark, sf_dir)["spot_trades"], exact_scale=2).persist()
    yield df
    df.unpersist()


def by_key(df):
    return {(r["symbol_id"], r["date"]): r.asDict() for r in df.collect()}


def agree(a, b):
    assert a.keys() == b.keys()
    for key in a:
        for c, v in a[key].items():
            assert b[key][c] == (pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else v), (key, c)


def test_running_totals_agree_with_frames(stats):
    agree(by_key(rolling_trade_features(stats)), by_key(rolling_trade_features(stats, exact_scale=2)))


@pytest.mark.parametrize("scale", [None, 2])
def test_latest_is_the_last_row_of_history(stats, scale):
    history = by_key(rolling_trade_features(stats, exact_scale=scale))
    last = {}
    for symbol, day in history:
        last[symbol] = max(day, last.get(symbol, day))
    want = {k: v for k, v in history.items() if last[k[0]] == k[1]}
    agree(want, by_key(rolling_trade_features(stats, mode="latest", exact_scale=scale)))


def test_as_of_keeps_only_symbols_of_that_day(stats):
    day = stats.agg(F.max("date")).first()[0]
    got = by_key(rolling_trade_features(stats, mode="latest", as_of=day.isoformat()))
    assert got and {d for _, d in got} == {day}
    agree(got, by_key(rolling_trade_features(stats, as_of=day.isoformat()).where(F.col("date") == day)))


def test_shares_add_up_and_order(stats):
    df = rolling_trade_features(stats)
    off = df.where(
        (F.abs(F.col("pct_buys_30d") + F.col("pct_sells_30d") - 1) > 1e-12)
        | (F.col("total_dollar_volume_7d") > F.col("total_dollar_volume_30d") + 1e-6)
        | (F.col("num_trades_365d") < F.col("num_trades_180d"))
    )
    assert off.count() == 0


def test_null_totals_stay_null(spark, stats):
    blank = stats.limit(1).withColumn("total_dollar_volume", F.lit(None).cast("double"))
    for scale in (None, 2):
        row = rolling_trade_features(blank, exact_scale=scale).first()
        assert row["total_dollar_volume_7d"] is None


def test_one_shuffle_for_all_windows(stats):
    plan = rolling_trade_features(stats)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(symbol_id") == 1


def test_unknown_mode(stats):
    with pytest.raises(ValueError):
        rolling_trade_features(stats, mode="weekly")
