"""Rolling order-flow features over the daily trade statistics.

Frames count rows, that is observed days, per symbol.  A symbol has at most one row per
day, so a window partition is bounded by the calendar however many trades there were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.constants import LOOKBACK_DAYS, ROLLING_WINDOWS
from tickloom.functions.scalar import KEYS
from tickloom.functions.sqltext import from_units, q, ratio, rows, to_units
from tickloom.operators.aggregate import SIDES

MONEY = tuple(f"total_{s}dollar_volume" for s in SIDES)
COUNTS = ("num_buys", "num_sells")
_SHAPES = ("std", "skew", "kurtosis", "10th_percentile", "median", "90th_percentile")


def rolling_trade_features(
    stats: DataFrame,
    windows: Sequence[int] = ROLLING_WINDOWS,
    mode: str = "history",
    as_of: str | None = None,
    exact_scale: int | None = None,
) -> DataFrame:
    """Totals, averages and order-flow ratios for one day and each window.

    ``mode='history'`` gives a row per symbol and day, ``mode='latest'`` only each
    symbol's last day (with ``as_of``: only symbols that traded on that day).  The
    latest mode needs no sliding frames: it numbers the days backwards and sums by group.

    ``as_of`` cuts the input to the ``LOOKBACK_DAYS`` up to and including that date; the
    filter is applied to the input, below the window, where it prunes partitions.
    """
    if mode not in ("history", "latest"):
        raise ValueError("mode is 'history' or 'latest'")
    if as_of is not None:
        last = F.lit(as_of).cast("date")
        stats = stats.where(F.col("date").between(F.date_sub(last, LOOKBACK_DAYS - 1), last))
    if mode == "latest":
        rolled = _latest_sums(stats, windows, exact_scale)
        if as_of is not None:
            rolled = rolled.where(F.col("date") == last)
    elif exact_scale is None:
        rolled = _frame_sums(stats, windows)
    else:
        rolled = _running_sums(stats, windows, exact_scale)
    return _derive(rolled, windows)


def _frame_sums(stats: DataFrame, windows: Sequence[int]) -> DataFrame:
    """One sliding frame per window, all over the same sort."""
    return stats.selectExpr(
        "*", *[f"sum({c}) OVER {rows(n)} AS {c}_{n}d" for c in (*MONEY, *COUNTS) for n in windows]
    )


def _running_sums(stats: DataFrame, windows: Sequence[int], scale: int) -> DataFrame:
    """Difference of two running totals: constant work per row for any window length.

    Only done in fixed point, where the difference is exact.
    """
    totals = {
        **{c: f"sum({to_units(c, scale)})" for c in MONEY},
        **{f"seen_{c}": f"count({c})" for c in MONEY},
        **{c: f"sum({c})" for c in COUNTS},
    }
    summed = stats.selectExpr(
        "*", *[f"coalesce({e} OVER {rows(None)}, 0L) AS _run_{c}" for c, e in totals.items()]
    )

    def within(c: str, n: int) -> str:
        return f"(_run_{c} - lag(_run_{c}, {n}, 0L) OVER (PARTITION BY symbol_id ORDER BY date))"

    out = [q(c) for c in stats.columns]
    for n in windows:
        for c in MONEY:
            value = from_units(within(c, n), scale)
            out.append(f"CASE WHEN {within('seen_' + c, n)} > 0 THEN {value} END AS {c}_{n}d")
        out += [f"{within(c, n)} AS {c}_{n}d" for c in COUNTS]
    return summed.selectExpr(*out)


def _latest_sums(stats: DataFrame, windows: Sequence[int], scale: int | None) -> DataFrame:
    recent = stats.selectExpr(
        "*", "row_number() OVER (PARTITION BY symbol_id ORDER BY date DESC) AS _rn"
    ).where(f"_rn <= {max(windows)}")

    def within(c: str, n: int) -> str:
        if c in MONEY and scale is not None:
            units = f"sum({to_units(c, scale)}) FILTER (WHERE _rn <= {n})"
            return f"{from_units(units, scale)} AS {c}_{n}d"
        return f"sum({c}) FILTER (WHERE _rn <= {n}) AS {c}_{n}d"

    last = [f"max({q(c)}) FILTER (WHERE _rn = 1) AS {q(c)}" for c in stats.columns if c != "symbol_id"]
    sums = [within(c, n) for c in (*MONEY, *COUNTS) for n in windows]
    return recent.groupBy("symbol_id").agg(*[F.expr(e) for e in (*last, *sums)])


def _derive(rolled: DataFrame, windows: Sequence[int]) -> DataFrame:
    horizons = [1, *windows]

    def at(c: str, n: int) -> str:
        return q(c if n == 1 else f"{c}_{n}d")

    def sum_of(a: str, b: str) -> str:
        return f"({a} + {b})"

    out = ["date", *KEYS, "symbol_id"]
    for c in (*MONEY, *COUNTS):
        out += [f"{at(c, n)} AS {c}_{n}d" for n in horizons]
    for s in SIDES:
        out.append(f"avg_{s}dollar_volume AS avg_{s}dollar_volume_1d")
        for n in windows:
            # A ratio of sums, not a mean of daily means.
            buys, sells = at("num_buys", n), at("num_sells", n)
            trades = {"": sum_of(buys, sells), "buy_": buys, "sell_": sells}[s]
            out.append(f"{ratio(at(f'total_{s}dollar_volume', n), trades)} AS avg_{s}dollar_volume_{n}d")
    out += [
        f"{q(f'{shape}_{s}dollar_volume')} AS {q(f'{shape}_{s}dollar_volume_1d')}"
        for s in SIDES
        for shape in _SHAPES
    ]
    for n in horizons:
        buys, sells = at("num_buys", n), at("num_sells", n)
        bought, sold = at("total_buy_dollar_volume", n), at("total_sell_dollar_volume", n)
        out += [
            f"{sum_of(buys, sells)} AS num_trades_{n}d",
            f"{ratio(buys, sum_of(buys, sells))} AS pct_buys_{n}d",
            f"{ratio(sells, sum_of(buys, sells))} AS pct_sells_{n}d",
            f"{ratio(bought, sum_of(bought, sold))} AS pct_buy_dollar_volume_{n}d",
            f"{ratio(sold, sum_of(bought, sold))} AS pct_sell_dollar_volume_{n}d",
            f"{ratio(f'({bought} - {sold})', sum_of(bought, sold))} AS trade_imbalance_{n}d",
        ]
    return rolled.selectExpr(*out)
