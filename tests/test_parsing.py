import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions.scalar import (
    clean_float,
    epoch_or_text_to_ts,
    epoch_to_ts,
    round_minute,
    side_from_maker,
    split_symbol_id,
    symbol_id,
)
from tickloom.sources.layouts import LAYOUTS, parse_bars, parse_metrics, parse_trades


def raw(spark, *lines):
    n = max(len(line) for line in lines)
    fields = ", ".join(f"c{i} string" for i in range(n))
    df = spark.createDataFrame([tuple(line) for line in lines], fields)
    return df.selectExpr("*", "'BTC' AS asset_id_base", "'USDT' AS asset_id_quote", "'X' AS exchange_id")


def value(spark, expression, text="x"):
    return spark.createDataFrame([(text,)], "x string").select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("epoch", ["1735689600000", "1735689600000000"])
def test_epoch_unit_by_magnitude(spark, epoch):
    assert value(spark, epoch_to_ts("x"), epoch) == dt.datetime(2025, 1, 1)


def test_epoch_or_text(spark):
    assert value(spark, epoch_or_text_to_ts("x"), "1735689600000") == dt.datetime(2025, 1, 1)
    assert value(spark, epoch_or_text_to_ts("x"), "2025-01-01 00:05:00") == dt.datetime(2025, 1, 1, 0, 5)
    assert value(spark, epoch_or_text_to_ts("x"), "timestamp") is None


@pytest.mark.parametrize(
    "text, minute",
    [("00:00:29.9", 0), ("00:00:30", 0), ("00:00:30.001", 1), ("00:01:30", 2), ("00:01:29", 1)],
)
def test_rounding_to_the_minute_ties_to_even(spark, text, minute):
    got = value(spark, round_minute(F.col("x").cast("timestamp_ntz")), f"2024-01-01 {text}")
    assert got == dt.datetime(2024, 1, 1, 0, minute)


def test_close_time_rounds_into_the_next_day(spark):
    line = ["1704067140000", "1", "2", "0.5", "1.5", "3", "1704067199999", "0", "4", "0", "0", "0"]
    (bar,) = parse_bars(raw(spark, line), "spot").collect()
    assert bar["time_period_end"] == dt.datetime(2024, 1, 1)
    assert (bar["open"], bar["trades"]) == (1.0, 4)


def test_header_row_and_text_flags(spark):
    header = ["id", "price", "qty", "quote_qty", "time", "is_buyer_maker"]
    lines = [[str(i), "1.5", "2", "3", "1735689600000", flag] for i, flag in enumerate(["true", "false", "True"])]
    got = parse_trades(raw(spark, header, *lines), "futures").orderBy("trade_id").collect()
    assert [r["side"] for r in got] == ["sell", "buy", "sell"]
    assert got[0]["quantity"] == 2.0 and got[0]["timestamp"] == dt.datetime(2025, 1, 1)


def test_side_of_booleans(spark):
    assert value(spark, side_from_maker(F.lit(True))) == "sell"
    assert value(spark, side_from_maker(F.lit(False))) == "buy"


def test_unreadable_numbers_become_null(spark):
    line = ["2024-01-01 00:05:00", "BTCUSDT", "1", "NaN", "Infinity", "", "x", "2"]
    (row,) = parse_metrics(raw(spark, line)).collect()
    assert row["sum_open_interest"] == 1.0
    assert row["sum_open_interest_value"] is None
    assert row["count_toptrader_long_short_ratio"] is None
    assert row["sum_taker_long_short_vol_ratio"] == 2.0
    assert "symbol" not in row.asDict()


def test_layouts_know_their_width():
    assert {name: n for name, (n, _) in LAYOUTS.items()} == {
        "candle": 12, "futures_candle": 12, "trade": 7, "futures_trade": 6,
        "funding_rate": 3, "order_book_depth": 4, "futures_metrics": 8,
    }


def test_symbol_id_round_trip(spark):
    df = spark.createDataFrame([("BTC", "USDT", "X"), (None, "USDT", "X")], "asset_id_base string, asset_id_quote string, exchange_id string")
    got = df.select(symbol_id().alias("s")).collect()
    assert [r["s"] for r in got] == ["BTC_USDT_X", None]
    parts = spark.createDataFrame([("BTC_USDT_X",)], "s string").select(*split_symbol_id("s")).first()
    assert tuple(parts) == ("BTC", "USDT", "X")


@pytest.mark.parametrize("bad", ["NaN", "Infinity", "-Infinity"])
def test_clean_float(spark, bad):
    assert value(spark, clean_float(F.col("x").cast("double")), bad) is None
    assert value(spark, clean_float(F.col("x").cast("double")), "1.5") == 1.5
