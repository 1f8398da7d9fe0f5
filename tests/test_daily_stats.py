import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators.aggregate import daily_ohlcv, daily_trade_stats

DAY = dt.datetime(2024, 1, 2, 10)


def trades(rows, values, side="buy"):
    return rows(
        schemas.FUTURES_TRADES,
        *[{"trade_id": i, "timestamp": DAY, "quote_quantity": float(v), "side": side} for i, v in enumerate(values)],
    )


def one(df):
    (row,) = df.collect()
    return row.asDict()


def test_five_values(rows):
    got = one(daily_trade_stats(trades(rows, [1, 2, 4, 7, 30])))
    assert got["skew_dollar_volume"] == pytest.approx(2.0428840347178)
    assert got["kurtosis_dollar_volume"] == pytest.approx(0.06747700849)
    assert got["std_dollar_volume"] == pytest.approx(10.7962956610126)
    assert got["10th_percentile_dollar_volume"] == pytest.approx(1.4)
    assert got["median_dollar_volume"] == 4
    assert got["90th_percentile_dollar_volume"] == pytest.approx(20.8)


def test_two_values_have_no_skewness(rows):
    got = one(daily_trade_stats(trades(rows, [1, 2])))
    assert got["skew_dollar_volume"] is None
    assert got["kurtosis_dollar_volume"] == pytest.approx(-2.0)
    assert got["std_dollar_volume"] == 0.5


def test_equal_values(rows):
    got = one(daily_trade_stats(trades(rows, [5, 5, 5])))
    assert got["skew_dollar_volume"] is None
    assert got["kurtosis_dollar_volume"] is None
    assert got["std_dollar_volume"] == 0


def test_one_sided_day(rows):
    got = one(daily_trade_stats(trades(rows, [1, 2, 3])))
    assert got["total_sell_dollar_volume"] == 0
    assert got["num_sells"] == 0
    for c in ("avg", "std", "10th_percentile", "median", "90th_percentile"):
        assert got[f"{c}_sell_dollar_volume"] is None


def skewed(spark, n_hot, n_cold):
    """One symbol-day with most of the rows, few of them sells, beside small ones."""
    ids = spark.range(n_hot + n_cold)
    hot = F.col("id") < n_hot
    value = F.round(F.pow(F.rand(7) * 1000 + 1, F.lit(1.5)), 2)
    return ids.select(
        F.col("id").alias("trade_id"),
        F.lit(DAY).cast("timestamp_ntz").alias("timestamp"),
        value.alias("quote_quantity"),
        F.when(hot & (F.col("id") % 5000 == 0), "sell").otherwise("buy").alias("side"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 50).cast("string"))).alias("asset_id_base"),
        F.lit("USDT").alias("asset_id_quote"),
        F.lit("X").alias("exchange_id"),
    )


def check_against_numpy(rows, got):
    values = rows.toPandas()
    for symbol, of in values.groupby("asset_id_base"):
        for side, part in (("", of), ("buy_", of[of.side == "buy"]), ("sell_", of[of.side == "sell"])):
            x = part.quote_quantity.to_numpy()
            if not len(x):
                continue
            for name, p in (("10th_percentile", 10), ("median", 50), ("90th_percentile", 90)):
                assert got[symbol][f"{name}_{side}dollar_volume"] == pytest.approx(np.percentile(x, p), rel=1e-12), (symbol, side)
            assert got[symbol][f"avg_{side}dollar_volume"] == pytest.approx(x.mean(), rel=1e-12, abs=1e-12)
            assert got[symbol][f"std_{side}dollar_volume"] == pytest.approx(x.std(), rel=1e-9, abs=1e-12)
            if len(x) > 3 and x.std() > 0:
                kurtosis = ((x - x.mean()) ** 4).mean() / x.var() ** 2 - 3
                assert got[symbol][f"kurtosis_{side}dollar_volume"] == pytest.approx(kurtosis, rel=1e-8, abs=1e-8)


def by_symbol(df):
    return {r["asset_id_base"]: r.asDict() for r in daily_trade_stats(df).collect()}


def test_large_symbol_day_is_exact(spark):
    rows = skewed(spark, 60_000, 5_000).persist()
    got = by_symbol(rows)
    assert len(got) == 51
    check_against_numpy(rows, got)
    rows.unpersist()


@pytest.mark.parametrize(
    "value",
    [
        "pow(10D, id % 600 - 300)",  # the whole range of exponents
        "CASE WHEN id % 2 = 0 THEN -1D ELSE 1D END * (id % 977)",  # signs and zeros
        "1000000D + id / 4096D",  # one cell
        "CASE WHEN id % 50 = 0 THEN 3D ELSE 7D END",  # two values
        "-5e-324 * (id % 3)",
    ],
)
def test_selection_over_odd_values(spark, value):
    rows = skewed(spark, 3_000, 300).withColumn("id", F.col("trade_id")).withColumn("quote_quantity", F.expr(value)).persist()
    got = by_symbol(rows)
    values = rows.toPandas()
    for symbol, of in values.groupby("asset_id_base"):
        for name, p in (("10th_percentile", 10), ("median", 50), ("90th_percentile", 90)):
            want = np.percentile(of.quote_quantity, p)
            assert got[symbol][f"{name}_dollar_volume"] == pytest.approx(want, rel=1e-9), (symbol, name)
    rows.unpersist()


def test_infinite_missing_and_unsided_values(rows):
    inf = float("inf")
    made = [(1.0, "buy"), (-inf, None), (inf, "buy"), (2.0, None), (3.0, "sell"), (None, "buy")]
    table = rows(
        schemas.FUTURES_TRADES,
        *[{"trade_id": i, "timestamp": DAY, "quote_quantity": v, "side": s} for i, (v, s) in enumerate(made)],
    )
    got = one(daily_trade_stats(table))
    assert got["median_dollar_volume"] == 2.0 and got["10th_percentile_dollar_volume"] == -inf
    assert got["90th_percentile_dollar_volume"] == inf
    assert (got["num_buys"], got["num_sells"], got["median_sell_dollar_volume"]) == (3, 1, 3.0)


def test_day_without_values(rows):
    got = one(daily_trade_stats(rows(schemas.FUTURES_TRADES, {"trade_id": 1, "timestamp": DAY, "side": "buy"})))
    assert got["num_buys"] == 1 and got["median_dollar_volume"] is None and got["std_dollar_volume"] is None


def test_statistics_read_the_trades_twice(spark, sf_dir):
    from views import load_views

    stats = daily_trade_stats(load_views(spark, sf_dir)["spot_trades"], exact_scale=2)
    stats.collect()
    plan = stats._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "collect_list" not in plan and plan.count("FileScan parquet") == 2


def test_large_symbol_day_of_one_value(spark):
    rows = skewed(spark, 60_000, 100).withColumn("quote_quantity", F.lit(3.0))
    got = daily_trade_stats(rows).where("asset_id_base = 'HOT'").first()
    assert got["median_dollar_volume"] == got["10th_percentile_dollar_volume"] == 3.0
    assert got["std_dollar_volume"] == 0 and got["kurtosis_dollar_volume"] is None


def test_approximate_percentiles_are_close(spark):
    rows = skewed(spark, 20_000, 100)
    exact = daily_trade_stats(rows).where("asset_id_base = 'HOT'").first()
    near = daily_trade_stats(rows, approx=True).where("asset_id_base = 'HOT'").first()
    assert near["median_dollar_volume"] == pytest.approx(exact["median_dollar_volume"], rel=0.01)
    assert near["num_buys"] == exact["num_buys"]


def test_day_totals_add_up(spark, sf_dir):
    from views import load_views

    trades = load_views(spark, sf_dir)["spot_trades"]
    days = daily_trade_stats(trades, exact_scale=2)
    whole = trades.agg(F.sum(F.col("quote_quantity").cast("decimal(18,2)")).cast("double")).first()[0]
    got = days.agg(
        F.sum("total_dollar_volume"), F.sum(F.col("total_buy_dollar_volume") + F.col("total_sell_dollar_volume"))
    ).first()
    assert got[0] == pytest.approx(whole) and got[1] == pytest.approx(whole)


def test_midnight_bar_belongs_to_its_start(rows):
    last = dt.datetime(2024, 1, 1, 23, 59)
    bars = rows(
        schemas.SPOT_BARS,
        {"time_period_start": last, "time_period_end": dt.datetime(2024, 1, 2), "open": 1.0, "high": 2.0,
         "low": 0.5, "close": 1.5, "volume": 3.0, "trades": 4},
    )
    assert one(daily_ohlcv(bars))["date"] == dt.date(2024, 1, 1)
    assert one(daily_ohlcv(bars, label="end"))["date"] == dt.date(2024, 1, 2)
    with pytest.raises(ValueError):
        daily_ohlcv(bars, label="middle")


def test_only_rows_of_the_wanted_parts_are_counted_by_value(spark, sf_dir):
    from tickloom.functions.scalar import KEYS
    from tickloom.operators.percentiles import percentiles
    from views import load_views

    trades = load_views(spark, sf_dir)["spot_trades"]
    made = percentiles(trades, KEYS, "quote_quantity", {"": None}, [0.5])
    plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
    by_value = [i for i, line in enumerate(plan) if "Aggregate [" in line and ", _x#" in line.split("]")[0]]
    assert by_value and all(any("array_contains" in below for below in plan[i:]) for i in by_value)


def test_percentiles_over_signs_octaves_and_copies(spark):
    made = np.concatenate([np.geomspace(1e-3, 1e6, 701), -np.geomspace(1e-2, 1e4, 300), np.full(500, 7.25), [0.0, -0.0]])
    rows = spark.createDataFrame([(None, float(v)) for v in made], "g string, v double").repartition(5)
    from tickloom.operators.percentiles import percentiles

    probs = [0.0, 0.1, 0.5, 0.73, 1.0]
    got = percentiles(rows, ["g"], "v", {"all": None, "minus": "v < 0"}, probs).first()
    assert got["_p_all"] == pytest.approx(np.quantile(made, probs), rel=1e-12)
    assert got["_p_minus"] == pytest.approx(np.quantile(made[made < 0], probs), rel=1e-12)


def test_only_rows_of_the_wanted_cells_are_counted_by_value(spark, monkeypatch):
    from tickloom.operators import percentiles as module

    seen, match = [], module._match
    monkeypatch.setattr(module, "_match", lambda left, right, on: seen.append((left, on[-1])) or match(left, right, on))
    rows = spark.range(1, 20_001).selectExpr("'g' AS g", "CAST(id AS DOUBLE) AS v")
    assert module.percentiles(rows, ["g"], "v", {"": None}, [0.5]).first()["_p_"] == [10_000.5]
    (by_value,) = [left for left, last in seen if last == "_cell"]
    assert by_value.count() < 50  # of some 600 in the wanted part


def test_percentiles_sort_no_rows_where_nothing_is_broadcast(spark):
    """Rows are looked up among the wanted parts and cells and dealt once; keys may be null."""
    from tickloom.operators.percentiles import percentiles

    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(3_001).selectExpr("IF(id % 3 = 0, NULL, id % 3) AS g", "'x' AS h", "CAST(id AS DOUBLE) AS v")
        made = percentiles(rows, ["g", "h"], "v", {"": None}, [0.5])
        got = {r["g"]: r["_p_"] for r in made.collect()}
        plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert got == {None: [1_500.0], 1: [1_499.5], 2: [1_500.5]}
    assert plan.count("ShuffledHashJoin") >= 2
    assert plan.count("Range (0, 3001") == 1
