"""Keys, timestamps and guards, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.constants import MAX_EPOCH_MS

KEYS = ("asset_id_base", "asset_id_quote", "exchange_id")
MINUTE_US = 60_000_000
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def symbol_id(
    base: Column | str = "asset_id_base",
    quote: Column | str = "asset_id_quote",
    exchange: Column | str = "exchange_id",
) -> Column:
    """``base_quote_exchange``; null when a part is null (``concat_ws`` would skip it)."""
    sep = F.lit("_")
    return F.concat(_col(base), sep, _col(quote), sep, _col(exchange))


def split_symbol_id(c: Column | str) -> list[Column]:
    """The three key columns held in a symbol id."""
    parts = F.split(_col(c), "_")
    return [F.get(parts, F.lit(i)).alias(k) for i, k in enumerate(KEYS)]


def epoch_us(c: Column | str) -> Column:
    """Epoch microseconds from a value in milliseconds or microseconds.

    The unit is decided per row by magnitude; text that is not an integer gives null.
    """
    v = _col(c).try_cast("bigint")
    return F.when(v > MAX_EPOCH_MS, v).otherwise(v * 1000)


def us_to_ts(us: Column) -> Column:
    """Zone-free timestamp at ``us`` microseconds after the epoch."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def ts_to_us(ts: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _col(ts))


def ts_to_ms(ts: Column | str) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), _col(ts))


def ms_to_ts(ms: Column | str) -> Column:
    return us_to_ts(_col(ms).cast("bigint") * 1000)


def epoch_to_ts(c: Column | str) -> Column:
    return us_to_ts(epoch_us(c))


def epoch_or_text_to_ts(c: Column | str) -> Column:
    """Epoch when the text is an integer, otherwise a written timestamp."""
    return F.coalesce(epoch_to_ts(c), _col(c).try_cast("timestamp_ntz"))


def round_minute_us(us: Column) -> Column:
    """Nearest minute; a value exactly between two goes to the even one."""
    rest = F.pmod(us, F.lit(MINUTE_US))
    floor = us - rest
    odd = F.pmod(floor, F.lit(2 * MINUTE_US)) != 0
    up = (rest > MINUTE_US // 2) | ((rest == MINUTE_US // 2) & odd)
    return F.when(up, floor + MINUTE_US).otherwise(floor)


def round_minute(ts: Column | str) -> Column:
    return us_to_ts(round_minute_us(ts_to_us(ts)))


def clean_float(c: Column | str) -> Column:
    """Null in place of NaN and the infinities, which poison sums and averages."""
    x = _col(c)
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def clean_floats(df, columns=None):
    """``clean_float`` on the floating-point columns of ``df`` (all, or those named)."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(
        *[
            clean_float(_quoted(f.name)).alias(f.name)
            if f.name in wanted and isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else _quoted(f.name)
            for f in df.schema.fields
        ]
    )


def side_from_maker(c: Column | str) -> Column:
    """Aggressor side: a buyer that was the maker means the trade was a sell.

    Works on text and on booleans, in any letter case.
    """
    text = F.lower(F.trim(_col(c).cast("string")))
    return F.when(text == "true", "sell").otherwise("buy")


def quoted(name: str) -> Column:
    """Column by exact name, also when it starts with a digit."""
    return _quoted(name)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
