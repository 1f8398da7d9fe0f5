"""Row-level repair of raw data: duplicates and missing minutes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalar import KEYS, quoted

_BAR_VALUES = ("open", "high", "low", "close")
_BAR_FLOWS = ("volume", "trades", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by the remaining columns.

    The whole row is the tie-break, so the result does not depend on scan order.  It is
    an aggregation, not a ``row_number``: copies collapse on the map side, so a key with a
    huge number of copies sends one row per task instead of all of them to one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[quoted(c) for c in (*order, *rest)])
    grouped = df.groupBy(*[quoted(k) for k in keys]).agg(F.min(row).alias("_row"))
    return grouped.select(
        *[quoted(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def dedupe_trades(
    trades: DataFrame, keys: Sequence[str] = ("trade_id", *KEYS), order: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """One row per trade id and symbol, the earliest.

    The id comes first in the key: sorting by a number settles nearly every comparison.
    """
    return keep_first(trades, keys, order)


def gap_fill(
    bars: DataFrame,
    step: str = "1 minute",
    fill: str = "reference",
    dedupe: bool = True,
) -> DataFrame:
    """Regular bars within each symbol and day, from the first bar to the last.

    A missing minute repeats the bar before it.  ``fill='reference'`` repeats all values,
    volume and trades included (daily sums then count them again); ``fill='zero_volume'``
    repeats only the close, as a flat bar without volume.

    Each bar is stretched up to the next one, which needs one window over the day and no
    join with a minute grid.  A partition is one symbol-day, at most 1,440 distinct bars;
    repeated bars are dropped before.  A bar whose end is unreadable ends one step after its
    start; without a start either it stays as it is.
    """
    if fill not in ("reference", "zero_volume"):
        raise ValueError("fill is 'reference' or 'zero_volume'")
    end = "time_period_end"
    one = F.expr(f"INTERVAL {step}")
    bars = bars.withColumn(end, F.coalesce(F.col(end), F.col("time_period_start") + one))
    if dedupe:
        bars = keep_first(bars, [end, *KEYS], ["time_period_start"])
    day = F.to_date(F.coalesce(F.col("time_period_start"), F.col(end)))
    order = Window.partitionBy(*KEYS, "_day").orderBy(end)
    past = order.rowsBetween(Window.unboundedPreceding, 0)
    carried = [c for c in bars.columns if c not in (*KEYS, end, "symbol_id")]
    stretched = bars.withColumn("_day", day).select(
        *[
            F.last(quoted(c), ignorenulls=True).over(past).alias(c) if c in carried else quoted(c)
            for c in bars.columns
        ],
        F.lead(end).over(order).alias("_next"),
    )
    # Bars closer than a step leave nothing to fill.
    until = F.greatest(F.coalesce(F.col("_next") - one, F.col(end)), F.col(end))
    grid = stretched.withColumn("_at", F.explode_outer(F.sequence(F.col(end), until, one)))
    filled = F.col("_at") > F.col(end)

    def value(c: str):
        if c == end:
            return F.col("_at").alias(c)
        if fill == "zero_volume":
            if c in _BAR_VALUES:
                return F.when(filled, F.col("close")).otherwise(quoted(c)).alias(c)
            if c in _BAR_FLOWS:
                return F.when(filled, F.lit(0).cast(bars.schema[c].dataType)).otherwise(quoted(c)).alias(c)
            if c == "time_period_start":
                return F.when(filled, F.col("_at") - one).otherwise(quoted(c)).alias(c)
        return quoted(c)

    return grid.select(*[value(c) for c in bars.columns])
