"""Schemas of every dataset, enforced on read instead of inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from tickloom.constants import METADATA_DATASETS

_KEYS = [T.StructField(k, T.StringType()) for k in ("asset_id_base", "asset_id_quote", "exchange_id")]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _with_keys(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields] + _KEYS)


_D, _L, _S, _TS = T.DoubleType(), T.LongType(), T.StringType(), T.TimestampNTZType()

_BAR = [
    ("time_period_start", _TS),
    ("time_period_end", _TS),
    ("open", _D),
    ("high", _D),
    ("low", _D),
    ("close", _D),
    ("volume", _D),
    ("trades", _L),
]
SPOT_BARS = _with_keys(*_BAR)
FUTURES_BARS = _with_keys(
    *_BAR, ("quote_volume", _D), ("taker_buy_volume", _D), ("taker_buy_quote_volume", _D)
)
_TRADE = [
    ("trade_id", _L),
    ("timestamp", _TS),
    ("price", _D),
    ("quantity", _D),
    ("quote_quantity", _D),
    ("side", _S),
]
SPOT_TRADES = _with_keys(*_TRADE, ("is_best_match", T.BooleanType()))
FUTURES_TRADES = _with_keys(*_TRADE)
FUNDING = _with_keys(
    ("timestamp", _TS), ("funding_interval_hours", T.IntegerType()), ("last_funding_rate", _D)
)
DEPTH = _with_keys(("timestamp", _TS), ("percentage", _D), ("depth", _D), ("notional", _D))
METRICS = _with_keys(
    ("timestamp", _TS),
    ("sum_open_interest", _D),
    ("sum_open_interest_value", _D),
    ("count_toptrader_long_short_ratio", _D),
    ("sum_toper_long_short_ratio", _D),
    ("count_long_short_ratio", _D),
    ("sum_taker_long_short_vol_ratio", _D),
)
METADATA = T.StructType(
    _KEYS
    + [
        T.StructField(f"{d}_data_{edge}", _L)
        for d in METADATA_DATASETS
        for edge in ("start", "end")
    ]
)
DAILY_OHLCV = _struct(
    ("date", T.DateType()),
    *[(f.name, f.dataType) for f in _KEYS],
    ("symbol_id", _S),
    ("open", _D),
    ("high", _D),
    ("low", _D),
    ("close", _D),
    ("volume", _D),
    ("trades", _L),
)
LISTING = _struct(
    ("symbol", _S),
    ("baseAsset", _S),
    ("quoteAsset", _S),
    ("isSpotTradingAllowed", T.BooleanType()),
    ("isMarginTradingAllowed", T.BooleanType()),
)
EXCHANGE_INFO = T.StructType([T.StructField("symbols", T.ArrayType(LISTING))])
