import datetime as dt

from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.operators.cleaning import dedupe_trades, gap_fill

T0 = dt.datetime(2024, 1, 1)


def bar(end, volume, close=1.0, start=None):
    at = T0 + dt.timedelta(minutes=end)
    return {
        "time_period_start": start or at - dt.timedelta(minutes=1),
        "time_period_end": at,
        "open": close, "high": close, "low": close, "close": close,
        "volume": float(volume),
        "trades": int(volume),
    }


def test_missing_minutes_repeat_the_bar_before(rows):
    bars = rows(schemas.SPOT_BARS, bar(1, 1), bar(4, 2))
    got = gap_fill(bars).orderBy("time_period_end").collect()
    assert [r["time_period_end"].minute for r in got] == [1, 2, 3, 4]
    assert [r["volume"] for r in got] == [1, 1, 1, 2]
    assert [r["trades"] for r in got] == [1, 1, 1, 2]


def test_zero_volume_fill(rows):
    bars = rows(schemas.SPOT_BARS, bar(1, 1, close=5.0), bar(3, 2))
    got = gap_fill(bars, fill="zero_volume").orderBy("time_period_end").collect()
    assert [r["volume"] for r in got] == [1, 0, 2]
    assert got[1]["open"] == got[1]["close"] == 5.0
    assert got[1]["time_period_start"] == T0 + dt.timedelta(minutes=1)


def test_null_values_are_carried_forward(rows):
    bars = rows(schemas.SPOT_BARS, bar(1, 1, close=5.0), {**bar(2, 2), "close": None})
    got = gap_fill(bars).orderBy("time_period_end").collect()
    assert [r["close"] for r in got] == [5.0, 5.0]


def test_repeated_bars_and_days_apart(rows):
    next_day = 24 * 60 + 5
    bars = rows(schemas.SPOT_BARS, bar(1, 1), bar(1, 1), bar(next_day, 2))
    # No filling across midnight.
    assert gap_fill(bars).count() == 2


def test_earliest_trade_wins(rows):
    def trade(minute, price):
        return {"trade_id": 1, "timestamp": T0 + dt.timedelta(minutes=minute), "price": price, "side": "buy"}

    trades = rows(schemas.FUTURES_TRADES, trade(5, 1.0), trade(2, 9.0), trade(2, 8.0))
    (row,) = dedupe_trades(trades).collect()
    assert row["timestamp"].minute == 2 and row["price"] == 8.0


def test_symbols_do_not_share_trade_ids(rows):
    trades = rows(
        schemas.FUTURES_TRADES, {"trade_id": 1}, {"trade_id": 1, "asset_id_base": "ETH"}
    )
    assert dedupe_trades(trades).count() == 2


def test_many_copies_collapse_before_the_shuffle(spark):
    copies = spark.range(100_000).select(
        *[F.lit(k).alias(k) for k in ("asset_id_base", "asset_id_quote", "exchange_id")],
        F.lit(7).alias("trade_id"),
        F.lit(T0).cast("timestamp_ntz").alias("timestamp"),
    )
    deduped = dedupe_trades(copies)
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert deduped.count() == 1


def test_other_steps_than_a_minute(spark):
    """Gaps in bars of five minutes; a gap that is no multiple of the step is filled up to it."""
    bars = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, m) AS time_period_start,"
        " TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, m + 5) AS time_period_end,"
        " CAST(m AS DOUBLE) AS close, 'A' AS asset_id_base, 'USDT' AS asset_id_quote, 'X' AS exchange_id"
        " FROM VALUES (0), (15), (18) t(m)"
    )
    filled = gap_fill(bars, step="5 minutes").orderBy("time_period_end").collect()
    assert [(r["time_period_end"].minute, r["close"]) for r in filled] == [(5, 0.0), (10, 0.0), (15, 0.0), (20, 15.0), (23, 18.0)]
