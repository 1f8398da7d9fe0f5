"""Archive rows (all text, named by position ``c0, c1, ...``) to typed rows.

Input rows carry the three key columns next to the text fields.  A header line inside an
archive shows up as a row whose time is not a number, and is dropped for that reason.
Times that are neither milliseconds nor microseconds do not exist in these layouts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.constants import (
    DEPTH_COLUMNS,
    FUNDING_COLUMNS,
    FUTURES_TRADE_COLUMNS,
    KLINE_COLUMNS,
    METRICS_COLUMNS,
    SPOT_TRADE_COLUMNS,
)
from tickloom.functions.scalar import (
    KEYS,
    clean_float,
    epoch_or_text_to_ts,
    epoch_to_ts,
    epoch_us,
    round_minute_us,
    side_from_maker,
    us_to_ts,
)

#: Column with the period in an archive's name, for rows that are filed by it.
PERIOD = "archive_period"


def name_by_position(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """``c0, c1, ...`` renamed; the key columns stay, and the archive's period if known."""
    return raw.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], *KEYS, *_period(raw))


def _period(rows: DataFrame) -> list[str]:
    return [PERIOD] if PERIOD in rows.columns else []


def _typed(name: str, schema: T.StructType) -> Column:
    """Text to the schema's type; unreadable numbers become null, NaN and infinities too."""
    kind = schema[name].dataType
    x = F.col(name).try_cast(kind)
    return (clean_float(x) if isinstance(kind, T.DoubleType) else x).alias(name)


def _project(rows: DataFrame, schema: T.StructType, made: dict[str, Column]) -> DataFrame:
    return rows.select(
        *[
            made[f.name].alias(f.name)
            if f.name in made
            else F.col(f.name)
            if f.name in KEYS
            else _typed(f.name, schema)
            for f in schema.fields
        ],
        *_period(rows),
    )


def parse_bars(raw: DataFrame, market: str) -> DataFrame:
    """Minute bars; both ends are rounded to the minute."""
    schema = {"spot": schemas.SPOT_BARS, "futures": schemas.FUTURES_BARS}[market]
    rows = name_by_position(raw, KLINE_COLUMNS).where(epoch_us("time_period_start").isNotNull())
    ends = ("time_period_start", "time_period_end")
    return _project(rows, schema, {c: us_to_ts(round_minute_us(epoch_us(c))) for c in ends})


def parse_trades(raw: DataFrame, market: str) -> DataFrame:
    """Trades with the aggressor side; repeated ids are left for ``dedupe_trades``."""
    names, schema = {
        "spot": (SPOT_TRADE_COLUMNS, schemas.SPOT_TRADES),
        "futures": (FUTURES_TRADE_COLUMNS, schemas.FUTURES_TRADES),
    }[market]
    rows = (
        name_by_position(raw, names)
        .where(epoch_us("time").isNotNull())
        .withColumnsRenamed({"qty": "quantity", "quote_qty": "quote_quantity"})
    )
    made = {"timestamp": epoch_to_ts("time"), "side": side_from_maker("is_buyer_maker")}
    return _project(rows, schema, made)


def _parse_feed(raw: DataFrame, names: Sequence[str], schema: T.StructType) -> DataFrame:
    at = epoch_or_text_to_ts("timestamp")
    rows = name_by_position(raw, names).where(at.isNotNull())
    return _project(rows, schema, {"timestamp": at})


def parse_funding(raw: DataFrame) -> DataFrame:
    return _parse_feed(raw, FUNDING_COLUMNS, schemas.FUNDING)


def parse_depth(raw: DataFrame) -> DataFrame:
    return _parse_feed(raw, DEPTH_COLUMNS, schemas.DEPTH)


def parse_metrics(raw: DataFrame) -> DataFrame:
    """The archive's own ``symbol`` column is dropped; the keys name the symbol."""
    return _parse_feed(raw, METRICS_COLUMNS, schemas.METRICS)


# Per dataset: number of text fields, and the parser from text rows to typed rows.
LAYOUTS = {
    "candle": (len(KLINE_COLUMNS), lambda raw: parse_bars(raw, "spot")),
    "futures_candle": (len(KLINE_COLUMNS), lambda raw: parse_bars(raw, "futures")),
    "trade": (len(SPOT_TRADE_COLUMNS), lambda raw: parse_trades(raw, "spot")),
    "futures_trade": (len(FUTURES_TRADE_COLUMNS), lambda raw: parse_trades(raw, "futures")),
    "funding_rate": (len(FUNDING_COLUMNS), parse_funding),
    "order_book_depth": (len(DEPTH_COLUMNS), parse_depth),
    "futures_metrics": (len(METRICS_COLUMNS), parse_metrics),
}
