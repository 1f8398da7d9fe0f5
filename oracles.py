"""The registered queries as DuckDB SQL over the same Parquet tables.

Written from the definitions of the measures, not from the Spark code: percentiles,
windows, gap filling and drawdowns all take another way here.
"""

from __future__ import annotations

from tickloom.constants import PREDICTION
from views import view_sql

AS_OF = "2000-06-15"  # target day of the single-day runs
RUN_DATE = "2000-01-01"  # training date; scoring covers the days after it
SCORING_RUN = "2000-01-20"  # a daily run after it; its target is the day before
HOT_DAY = "2000-01-01"  # gets half of the futures trades in one query
UNTIL = "2002-01-01"  # end of the load plans

BOOSTING_CUTS = {
    "quantity": [float(c) for c in range(4, 50, 3)],
    "month": [float(c) for c in range(2, 13)],
    "residue": [1.0, 2.0, 3.0, 4.0],
}

V = view_sql("duckdb")
KEYS = ("asset_id_base", "asset_id_quote", "exchange_id")
KEY_LIST = ", ".join(KEYS)
SYMBOL = "asset_id_base || '_' || asset_id_quote || '_' || exchange_id"
WINDOWS = (7, 30, 90, 180, 365)
SIDES = ("", "buy_", "sell_")
MARKETS = ("spot", "futures")


def r6(x: str) -> str:
    return f"round_even(({x}) * 1e6, 0) / 1e6"


def money(x: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def boosted(trees: int, depth: int, l2: float = 5, rate: float = 0.1, least: int = 20, unit: int = 1 << 20) -> str:
    """Trees level by level: a table of the rows with their node, joined with the best splits."""
    inputs = list(BOOSTING_CUTS)
    bins = ", ".join(
        f"CASE WHEN {c} IS NULL THEN -1 ELSE len(list_filter({cuts}, lambda e: e <= {c})) END AS b{i}"
        for i, (c, cuts) in enumerate(BOOSTING_CUTS.items())
    )

    def steps(x: str) -> str:
        return f"CAST(floor(({x}) * {unit}.0 + 0.5) AS BIGINT)"

    def part(g: str, h: str) -> str:
        return f"({g} / {unit}::DOUBLE) * ({g} / {unit}::DOUBLE) / ({h} + {l2}::DOUBLE)"

    own = "CASE input " + " ".join(f"WHEN {i} THEN b{i}" for i in range(len(inputs))) + " END"
    ctes = [
        "trades AS (SELECT trade_id, price, CASE WHEN trade_id % 7 <> 0 THEN quantity END AS quantity,"
        f' CAST(month("timestamp") AS DOUBLE) AS month, CAST(trade_id % 5 AS DOUBLE) AS residue FROM ({V["spot_trades"]}) t)',
        f"t0 AS MATERIALIZED (SELECT trade_id, price, {bins},"
        f" (SELECT sum({steps('price')})::DOUBLE / count(*) / {unit} FROM trades) AS f FROM trades)",
    ]
    for t in range(trees):
        ctes.append(f"n{t}_0 AS (SELECT *, {steps('f - price')} AS g, 1 AS node FROM t{t})")
        for d in range(depth):
            here = f"n{t}_{d}"
            each = " UNION ALL ".join(f"SELECT node, {i} AS input, b{i} AS bin, g FROM {here}" for i in range(len(inputs)))
            ctes += [
                f"h{here} AS (SELECT node, input, bin, sum(g)::DOUBLE AS g, count(*) AS h FROM ({each}) e GROUP BY ALL)",
                f"w{here} AS (SELECT node, sum(g)::DOUBLE AS g, count(*) AS h FROM {here} GROUP BY ALL)",
                f"c{here} AS (SELECT a.node, a.input, a.bin, s.ml, w.g, w.h, sum(b.g) AS gl, sum(b.h) AS hl"
                f" FROM h{here} a CROSS JOIN (VALUES (false), (true)) s(ml) JOIN w{here} w USING (node)"
                f" JOIN h{here} b ON b.node = a.node AND b.input = a.input"
                " AND (b.bin BETWEEN 0 AND a.bin OR (s.ml AND b.bin = -1))"
                " WHERE a.bin >= 0 GROUP BY ALL)",
                f"s{here} AS (SELECT node, input, bin, ml FROM (SELECT *, {part('gl', 'hl')} + {part('(g - gl)', '(h - hl)')}"
                f" - {part('g', 'h')} AS gain FROM c{here} WHERE hl >= {least} AND h - hl >= {least}) x WHERE gain > 0"
                " QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, input, bin, ml) = 1)",
                f"n{t}_{d + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN s.node IS NULL THEN r.node"
                f" WHEN CASE WHEN {own} = -1 THEN ml ELSE {own} <= s.bin END THEN 2 * r.node ELSE 2 * r.node + 1 END AS node"
                f" FROM {here} r LEFT JOIN s{here} s ON s.node = r.node)",
            ]
        ctes.append(
            f"t{t + 1} AS MATERIALIZED (SELECT * EXCLUDE (g, node, f), f - (sum(g) OVER (PARTITION BY node))::DOUBLE / {unit}"
            f" / (count(*) OVER (PARTITION BY node) + {l2}) * {rate} AS f FROM n{t}_{depth})"
        )
    return f"WITH {', '.join(ctes)} SELECT trade_id, {r6('price')} AS price, {r6('f')} AS {PREDICTION} FROM t{trees}"


def select(columns: dict[str, str], source: str) -> str:
    body = ",\n  ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"SELECT {body}\nFROM ({source}) src"


def same(*names: str) -> dict[str, str]:
    return {n: f'"{n}"' for n in names}


def rounded(*names: str) -> dict[str, str]:
    return {n: r6(f'"{n}"') for n in names}


def as_float(*names: str) -> dict[str, str]:
    """Integers that can be null, as floating point (like the query side)."""
    return {n: f'CAST("{n}" AS DOUBLE)' for n in names}


def integers(*names: str) -> dict[str, str]:
    out = {}
    for n in names:
        out.update(as_float(n) if nullable_integer(n) else same(n))
    return out


def nullable_integer(name: str) -> bool:
    return name == "trades_futures" or "_delta_" in name or name.endswith(("_data_start", "_data_end"))


# --- daily aggregates -------------------------------------------------------------


def stats_columns() -> list[str]:
    out = [f"total_{s}dollar_volume" for s in SIDES] + ["num_buys", "num_sells"]
    for shape in ("avg", "std", "skew", "kurtosis", "10th_percentile", "median", "90th_percentile"):
        out += [f"{shape}_{s}dollar_volume" for s in SIDES]
    return out


def stats(trades: str) -> str:
    e: dict[str, str] = {}
    for s in SIDES:
        who = s.rstrip("_")
        x = "quote_quantity"
        only = f" FILTER (WHERE side = '{who}')" if s else ""
        e[f"total_{s}dollar_volume"] = f"coalesce(CAST(sum(CAST({x} AS DECIMAL(18,2))){only} AS DOUBLE), 0)"
        if s:
            e[f"num_{who}s"] = f"count(*){only}"
        e[f"avg_{s}dollar_volume"] = (
            f"CAST(sum(CAST({x} AS DECIMAL(18,2))){only} AS DOUBLE) / nullif(count({x}){only}, 0)"
        )
        e[f"std_{s}dollar_volume"] = f"stddev_pop({x}){only}"
        e[f"skew_{s}dollar_volume"] = f"skewness({x}){only}"
        e[f"kurtosis_{s}dollar_volume"] = f"kurtosis_pop({x}){only}"
        e[f"10th_percentile_{s}dollar_volume"] = f"quantile_cont({x}, 0.1){only}"
        e[f"median_{s}dollar_volume"] = f"median({x}){only}"
        e[f"90th_percentile_{s}dollar_volume"] = f"quantile_cont({x}, 0.9){only}"
    measures = ",\n  ".join(f'{x} AS "{c}"' for c, x in e.items())
    return (
        f'SELECT CAST("timestamp" AS DATE) AS "date", {KEY_LIST}, {SYMBOL} AS symbol_id,\n  {measures}\n'
        f'FROM ({trades}) t GROUP BY CAST("timestamp" AS DATE), {KEY_LIST}'
    )


ID = ("date", *KEYS, "symbol_id")


def hot_trades() -> str:
    moved = f"CASE WHEN side = 'buy' THEN TIMESTAMP '{HOT_DAY}' ELSE \"timestamp\" END AS \"timestamp\""
    return (
        f"SELECT * REPLACE ({moved}, CASE WHEN side = 'buy' THEN 'S0' ELSE asset_id_base END AS asset_id_base)"
        f" FROM ({V['futures_trades']}) m"
    )


def stats_query(market: str, trades: str | None = None) -> str:
    counts = ("num_buys", "num_sells")
    floats = [c for c in stats_columns() if c not in counts]
    return select({**same(*ID, *counts), **rounded(*floats)}, stats(trades or V[f"{market}_trades"]))


def ohlcv(bars: str, label: str = "start", scale: int = 2) -> str:
    at = f"time_period_{label}"
    return (
        f'SELECT CAST({at} AS DATE) AS "date", {KEY_LIST}, {SYMBOL} AS symbol_id,'
        f" first(open ORDER BY {at}) AS open, max(high) AS high, min(low) AS low,"
        f" last(close ORDER BY {at}) AS close, {money('volume', scale)} AS volume,"
        f" CAST(sum(trades) AS BIGINT) AS trades"
        f" FROM ({bars}) b GROUP BY CAST({at} AS DATE), {KEY_LIST}"
    )


OHLCV = ("open", "high", "low", "close", "volume")


def ohlcv_query(bars: str, label: str = "start", scale: int = 2) -> str:
    return select({**same(*ID, "trades"), **rounded(*OHLCV)}, ohlcv(V[bars], label, scale))


# --- rolling ----------------------------------------------------------------------

MONEY = tuple(f"total_{s}dollar_volume" for s in SIDES)
COUNTS = ("num_buys", "num_sells")
SHAPES = ("std", "skew", "kurtosis", "10th_percentile", "median", "90th_percentile")


def rolling(source: str) -> str:
    """All rolling columns, unrounded."""
    sums = []
    for c in (*MONEY, *COUNTS):
        for n in WINDOWS:
            total = (
                f"CAST(sum(CAST({c} AS DECIMAL(18,2))) OVER w{n} AS DOUBLE)"
                if c in MONEY
                else f"CAST(sum({c}) OVER w{n} AS BIGINT)"
            )
            sums.append(f"{total} AS {c}_{n}d")
    frames = ", ".join(
        f'w{n} AS (PARTITION BY symbol_id ORDER BY "date" ROWS {n - 1} PRECEDING)' for n in WINDOWS
    )
    base = f"SELECT *, {', '.join(sums)} FROM ({source}) s WINDOW {frames}"
    e = same(*ID)
    for c in (*MONEY, *COUNTS):
        e[f"{c}_1d"] = c
        e.update(same(*[f"{c}_{n}d" for n in WINDOWS]))
    for s in SIDES:
        e[f"avg_{s}dollar_volume_1d"] = f"avg_{s}dollar_volume"
        e.update({f"{x}_{s}dollar_volume_1d": f'"{x}_{s}dollar_volume"' for x in SHAPES})
    for n in (1, *WINDOWS):
        h = "" if n == 1 else f"_{n}d"
        buys, sells = f"num_buys{h}", f"num_sells{h}"
        bought, sold = f"total_buy_dollar_volume{h}", f"total_sell_dollar_volume{h}"
        if n > 1:
            for s, d in (("", f"({buys} + {sells})"), ("buy_", buys), ("sell_", sells)):
                e[f"avg_{s}dollar_volume_{n}d"] = f"total_{s}dollar_volume{h} / nullif({d}, 0)"
        e[f"num_trades_{n}d"] = f"{buys} + {sells}"
        e[f"pct_buys_{n}d"] = f"{buys} / nullif({buys} + {sells}, 0)"
        e[f"pct_sells_{n}d"] = f"{sells} / nullif({buys} + {sells}, 0)"
        e[f"pct_buy_dollar_volume_{n}d"] = f"{bought} / nullif({bought} + {sold}, 0)"
        e[f"pct_sell_dollar_volume_{n}d"] = f"{sold} / nullif({bought} + {sold}, 0)"
        e[f"trade_imbalance_{n}d"] = f"({bought} - {sold}) / nullif({bought} + {sold}, 0)"
    return select(e, base)


def rolling_columns() -> tuple[list[str], list[str]]:
    """(integers, doubles)"""
    horizons = (1, *WINDOWS)
    ints = [f"{c}_{n}d" for c in (*COUNTS, "num_trades") for n in horizons]
    families = [
        *MONEY,
        *[f"avg_{s}dollar_volume" for s in SIDES],
        "pct_buys",
        "pct_sells",
        "pct_buy_dollar_volume",
        "pct_sell_dollar_volume",
        "trade_imbalance",
    ]
    doubles = [f"{c}_{n}d" for c in families for n in horizons]
    doubles += [f"{x}_{s}dollar_volume_1d" for x in SHAPES for s in SIDES]
    return ints, doubles


def rolling_query(where: str = "", cut: str = "") -> str:
    source = stats(V["spot_trades"])
    if cut:
        source = f"SELECT * FROM ({source}) c WHERE {cut}"
    ints, doubles = rolling_columns()
    sql = select({**same(*ID, *ints), **rounded(*doubles)}, rolling(source))
    return f"SELECT * FROM ({sql}) o {where}"


# --- features ---------------------------------------------------------------------


def joined() -> str:
    spot, futures = ohlcv(V["spot_bars"]), ohlcv(V["futures_bars"])
    values = (*OHLCV, "trades")
    left = ", ".join(f"s.{c} AS {c}_spot" for c in values)
    right = ", ".join(f"f.{c} AS {c}_futures" for c in values)
    keys = ", ".join(f"s.{k}" for k in KEYS)
    return (
        f'SELECT s.symbol_id, s."date", {keys}, {left}, {right} FROM ({spot}) s'
        f' LEFT JOIN ({futures}) f ON s.symbol_id = f.symbol_id AND s."date" = f."date"'
    )


JOIN_ID = ("symbol_id", "date", *KEYS)
JOIN_INTS = ("trades_spot", "trades_futures")
JOIN_FLOATS = tuple(f"{c}_{m}" for m in MARKETS for c in OHLCV)


def over(n: int) -> str:
    return f'OVER (PARTITION BY symbol_id ORDER BY "date" ROWS {n - 1} PRECEDING)'


DAY = 'OVER (PARTITION BY symbol_id ORDER BY "date")'


class Chain:
    """A source query with the names of its columns, extended step by step."""

    def __init__(self, sql: str, ids: tuple[str, ...], ints: list[str], floats: list[str]):
        self.sql, self.ids, self.ints, self.floats = sql, list(ids), list(ints), list(floats)

    def add(self, floats: dict[str, str] | None = None, ints: dict[str, str] | None = None) -> Chain:
        new = {**(floats or {}), **(ints or {})}
        new = {c: e for c, e in new.items() if c not in (*self.ints, *self.floats)}
        if new:
            body = ", ".join(f'{e} AS "{c}"' for c, e in new.items())
            self.sql = f"SELECT *, {body} FROM ({self.sql}) p"
            self.floats += [c for c in new if c in (floats or {})]
            self.ints += [c for c in new if c in (ints or {})]
        return self

    def query(self) -> str:
        return select({**same(*self.ids), **integers(*self.ints), **rounded(*self.floats)}, self.sql)


def start() -> Chain:
    return Chain(joined(), JOIN_ID, list(JOIN_INTS), list(JOIN_FLOATS))


def z(c: str, n: int) -> str:
    return f'("{c}" - avg("{c}") {over(n)}) / nullif(stddev_samp("{c}") {over(n)}, 0)'


def steady_z(c: str, n: int) -> str:
    """z-score, null where the frame's spread is rounding error."""
    low, high = f'min("{c}") {over(n)}', f'max("{c}") {over(n)}'
    apart = f"{high} - {low} > 1e-9 * greatest(abs({high}), abs({low}))"
    return f"CASE WHEN {apart} THEN {z(c, n)} END"


def add_time(c: Chain) -> Chain:
    return c.add(
        ints={
            "day_of_week": 'CAST(isodow("date") - 1 AS INTEGER)',
            "month": 'CAST(month("date") AS INTEGER)',
            "day_of_month": 'CAST(day("date") AS INTEGER)',
        }
    )


def plain_returns(c: Chain, windows) -> Chain:
    return c.add(
        {
            f"{m}_returns_{w}": f"close_{m} / nullif(lag(close_{m}, {w}) {DAY}, 0) - 1"
            for m in MARKETS
            for w in windows
        }
    )


def add_returns(c: Chain, windows=(1, 7), lookbacks=(30,)) -> Chain:
    c = plain_returns(c, windows)
    e = {}
    for m in MARKETS:
        for w in windows:
            for n in lookbacks:
                r = f"{m}_returns_{w}"
                e[f"{r}_mean_{n}"] = f"avg({r}) {over(n)}"
                e[f"{r}_std_{n}"] = f"stddev_samp({r}) {over(n)}"
                e[f"{r}_zscore_{n}"] = z(r, n)
                seen = f"list({r}) FILTER (WHERE {r} IS NOT NULL) {over(n)}"
                e[f"{r}_percentile_{n}"] = (
                    f"CASE WHEN {r} IS NOT NULL THEN"
                    f" len(list_filter({seen}, lambda x: x <= {r})) / len({seen}) END"
                )
    return c.add(e)


def add_risk(c: Chain, windows=(1, 7), lookbacks=(30,)) -> Chain:
    c = plain_returns(c, windows)
    e = {}
    for m in MARKETS:
        for n in lookbacks:
            for w in windows:
                r = f"{m}_returns_{w}"
                e[f"{r}_vol_{n}"] = f"stddev_samp({r}) {over(n)}"
                loss = f"CASE WHEN {r} IS NULL THEN NULL WHEN {r} < 0 THEN {r} ELSE 0 END"
                e[f"{r}_downside_{n}"] = f"sqrt(avg(power({loss}, 2)) {over(n)})"
                e[f"{r}_sharpe_{n}"] = f"avg({r}) {over(n)} / nullif(stddev_samp({r}) {over(n)}, 0)"
                e[f"{r}_min_{n}"] = f"min({r}) {over(n)}"
                e[f"{r}_max_{n}"] = f"max({r}) {over(n)}"
                e[f"{r}_skew_{n}"] = f"skewness({r}) {over(n)}"
            p = f"list(close_{m}) FILTER (WHERE close_{m} IS NOT NULL) {over(n)}"
            # Every price against the highest price up to it.
            e[f"{m}_max_drawdown_{n}"] = (
                f"list_min(list_transform(range(1, len({p}) + 1),"
                f" lambda i: ({p})[i] / list_max(({p})[1:i]) - 1))"
            )
    return c.add(e)


FLOWS = (
    *MONEY,
    *COUNTS,
    *[f"avg_{s}dollar_volume" for s in SIDES],
    "num_trades",
    "pct_buys",
    "pct_sells",
    "pct_buy_dollar_volume",
    "pct_sell_dollar_volume",
    "trade_imbalance",
)


def add_trade(c: Chain, windows=(1, 7), lookbacks=(30,)) -> Chain:
    ints, doubles = rolling_columns()
    flows = ", ".join(f'r."{x}"' for x in (*ints, *doubles))
    source = rolling_query()  # rounded, as stored
    c.sql = (
        f'SELECT j.*, {flows} FROM ({c.sql}) j LEFT JOIN ({source}) r'
        f' ON j.symbol_id = r.symbol_id AND j."date" = r."date"'
    )
    c.ints += ints
    c.floats += doubles
    delta, score, int_delta = {}, {}, {}
    for w in windows:
        for x in FLOWS:
            col = f"{x}_{w}d"
            for d in windows:
                (int_delta if col in ints else delta)[f"{col}_delta_{d}"] = f'"{col}" - lag("{col}", {d}) {DAY}'
            for n in lookbacks:
                score[f"{col}_zscore_{n}"] = steady_z(col, n)
    return c.add({**delta, **score}, int_delta)


def add_interaction(c: Chain, windows=(1, 7), lookbacks=(30,)) -> Chain:
    c = plain_returns(c, windows).add(
        {
            "basis": "close_futures / nullif(close_spot, 0) - 1",
            "volume_ratio": "volume_futures / nullif(volume_spot, 0)",
        }
    )
    e = {f"basis_delta_{w}": f"basis - lag(basis, {w}) {DAY}" for w in windows}
    for w in windows:
        f, s = f"futures_returns_{w}", f"spot_returns_{w}"
        e[f"returns_spread_{w}"] = f"{f} - {s}"
        both = f"{f} IS NOT NULL AND {s} IS NOT NULL"
        for n in lookbacks:
            cov = f"covar_samp({f}, {s}) {over(n)}"
            fs, ss = (f"stddev_samp({x}) FILTER (WHERE {both}) {over(n)}" for x in (f, s))
            e[f"returns_corr_{w}_{n}"] = f"{cov} / nullif({fs} * {ss}, 0)"
            e[f"returns_beta_{w}_{n}"] = f"{cov} / nullif(var_samp({s}) FILTER (WHERE {both}) {over(n)}, 0)"
    return c.add(e)


CALENDAR = ("day_of_week", "month", "day_of_month")


def add_rz(c: Chain, windows=(30,)) -> Chain:
    columns = [x for x in (*c.ints, *c.floats) if x not in CALENDAR]
    return c.add({f"{x}_rz_{n}": steady_z(x, n) for x in columns for n in windows})


def training() -> str:
    c = add_interaction(add_risk(add_returns(add_time(start()))))
    label = "futures_forward_returns_7"
    skip = {"open_spot", "high_spot", "low_spot", "close_spot"}
    skip |= {"open_futures", "high_futures", "low_futures", "close_futures"}
    kept_ints = [x for x in c.ints if "num" not in x]
    kept = [x for x in c.floats if x not in skip and "delta" not in x]
    rows = (
        f"SELECT *, lead(futures_returns_7, 7) {DAY} AS {label} FROM ({c.sql}) t"
        f" WHERE close_futures IS NOT NULL AND \"date\" < DATE '{RUN_DATE}'"
        f" AND \"date\" >= DATE '{RUN_DATE}' - INTERVAL 730 DAY"
    )
    columns = {**same("symbol_id"), **integers(*kept_ints), **rounded(*kept, label)}
    return f"SELECT * FROM ({select(columns, rows)}) o WHERE {label} IS NOT NULL"


# --- cleaning and parsing ---------------------------------------------------------

TRADE = ("trade_id", "timestamp", "side", *KEYS)
TRADE_FLOATS = ("price", "quantity", "quote_quantity")
BAR = ("time_period_start", "time_period_end", "trades", *KEYS)


def dedupe() -> str:
    ranked = (
        f"SELECT *, row_number() OVER (PARTITION BY {KEY_LIST}, trade_id"
        f' ORDER BY "timestamp", price, quantity, quote_quantity, side) AS rn FROM ({V["spot_trades"]}) t'
    )
    return select({**same(*TRADE), **rounded(*TRADE_FLOATS)}, f"SELECT * FROM ({ranked}) k WHERE rn = 1")


def gaps(zero: bool) -> str:
    bars = V["bars_1m"]
    day = "CAST(time_period_start AS DATE)"
    grid = (
        f"SELECT {KEY_LIST}, d, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS slot FROM ("
        f"SELECT {KEY_LIST}, {day} AS d, min(time_period_end) AS lo, max(time_period_end) AS hi"
        f" FROM ({bars}) b GROUP BY {KEY_LIST}, {day}) g"
    )
    e = {"time_period_end": "slot", **{k: f"g.{k}" for k in KEYS}}
    e["time_period_start"] = (
        "CASE WHEN slot > time_period_end THEN slot - INTERVAL 1 MINUTE ELSE time_period_start END"
        if zero
        else "time_period_start"
    )
    made = "slot > time_period_end"
    for c in ("open", "high", "low", "close"):
        e[c] = r6(f"CASE WHEN {made} THEN close ELSE {c} END" if zero else c)
    e["volume"] = r6(f"CASE WHEN {made} THEN 0 ELSE volume END" if zero else "volume")
    e["trades"] = f"CASE WHEN {made} THEN 0 ELSE trades END" if zero else "trades"
    body = ", ".join(f"{x} AS {c}" for c, x in e.items())
    on = " AND ".join(f"g.{k} = b.{k}" for k in KEYS)
    return (
        f"SELECT {body} FROM ({grid}) g ASOF JOIN (SELECT *, {day} AS d FROM ({bars}) x) b"
        f" ON {on} AND g.d = b.d AND g.slot >= b.time_period_end"
    )


def bars_query(view: str, extra: dict[str, str] | None = None) -> str:
    e = {**same(*BAR), **rounded(*OHLCV), **{c: r6(x) for c, x in (extra or {}).items()}}
    return select(e, V[view])


def trades_query(view: str, extra: dict[str, str] | None = None) -> str:
    return select({**same(*TRADE), **rounded(*TRADE_FLOATS), **(extra or {})}, V[view])


# --- load progress ----------------------------------------------------------------

MARKS = [
    f"{d}_data_{edge}"
    for d in (
        "candle",
        "trade",
        "futures_trade",
        "futures_candle",
        "funding_rate",
        "order_book_depth",
        "futures_metrics",
    )
    for edge in ("start", "end")
]


def meta_dates(expr: str) -> str:
    return f"SELECT {KEY_LIST}, {SYMBOL} AS symbol_id, {expr} AS next_start FROM ({V['symbol_meta']}) m"


def plan(expr: str, unit: str, until: str, tag: str, label: str) -> str:
    step = f"INTERVAL 1 {unit}"
    # The first period is a date; the series of it is made of timestamps.
    rows = (
        f"SELECT {KEY_LIST}, {SYMBOL} AS symbol_id, CAST(unnest(generate_series("
        f"CAST({expr} AS TIMESTAMP), TIMESTAMP '{until}', {step})) AS DATE) AS period_start"
        f" FROM ({V['symbol_meta']}) m"
    )
    return (
        f"SELECT *, asset_id_base || asset_id_quote || '-{tag}-' || strftime(period_start, '{label}')"
        f" || '.zip' AS archive FROM ({rows}) r"
    )


def first_month(mark: str, later: int) -> str:
    return f"date_trunc('month', make_timestamp({mark} * 1000)) + INTERVAL {later} MONTH"


def hw(source: str = "futures_trades", at: str = "timestamp") -> str:
    return f'SELECT {KEY_LIST}, epoch_ms(max("{at}")) AS high_water FROM ({V[source]}) t GROUP BY {KEY_LIST}'


def advanced(moved: str = "futures_trade_data_end", *source: str) -> str:
    kept = ", ".join(f"m.{c}" for c in (*KEYS, *[x for x in MARKS if x != moved]))
    on = " AND ".join(f"m.{k} = h.{k}" for k in KEYS)
    return (
        f"SELECT {kept}, greatest(m.{moved}, h.high_water) AS {moved}"
        f" FROM ({V['symbol_meta']}) m LEFT JOIN ({hw(*source)}) h ON {on}"
    )


def absent() -> str:
    return (
        f"SELECT DISTINCT {SYMBOL} AS symbol_id FROM ({V['futures_trades']}) t"
        f" WHERE {SYMBOL} NOT IN (SELECT {SYMBOL} FROM ({V['symbol_meta']}) m)"
    )


def extended() -> str:
    marks = ", ".join(f"CAST(1546300800000 AS BIGINT) AS {c}" for c in MARKS)
    keys = ", ".join(f"split_part(symbol_id, '_', {i + 1}) AS {k}" for i, k in enumerate(KEYS))
    names = ", ".join((*KEYS, *MARKS))
    return (
        f"SELECT {names} FROM ({V['symbol_meta']}) m"
        f" UNION ALL SELECT {names} FROM (SELECT {keys}, {marks} FROM ({absent()}) a) n"
    )


def marks(sql: str) -> str:
    return select({**same(*KEYS), **as_float(*MARKS)}, sql)


def scaled(*columns: str) -> str:
    """Distance from the mean before the run date in standard deviations, per symbol."""
    fitted = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in columns)
    shown = {c: f"({c} - m_{c}) / nullif(s_{c}, 0)" for c in columns}
    body = ", ".join(f"{r6(x)} AS {c}_scaled" for c, x in shown.items())
    return (
        f'SELECT j.symbol_id, j."date", {body} FROM ({joined()}) j LEFT JOIN (SELECT symbol_id, {fitted}'
        f" FROM ({joined()}) k WHERE \"date\" < DATE '{RUN_DATE}' GROUP BY symbol_id) f ON f.symbol_id = j.symbol_id"
    )


def event_trades() -> str:
    """Events as trades, each once at its own time."""
    return (
        "SELECT event_id AS trade_id, ts AS \"timestamp\", "
        f"{r6('value')} AS price, CAST(1 AS DOUBLE) AS quantity, {r6('value')} AS quote_quantity,"
        " CASE WHEN event_type = 'click' THEN 'buy' ELSE 'sell' END AS side,"
        " concat('S', CAST(user_id % 3 AS VARCHAR)) AS asset_id_base,"
        " 'USDT' AS asset_id_quote, 'BINANCE' AS exchange_id FROM events"
    )


def archive_report() -> str:
    return f"""
WITH made AS (
    SELECT CASE asset_id_base WHEN 'S4' THEN 'NONE' ELSE asset_id_base END || asset_id_quote AS symbol,
        strftime("timestamp", '%Y-%m') AS "date", count(*) AS n
    FROM ({V['spot_trades']}) t GROUP BY ALL
), landed AS (
    SELECT symbol || '-trades-' || "date" || '.zip' AS archive, "date", symbol,
        CASE WHEN "date" LIKE '%-03' THEN 'error' WHEN symbol = 'NONEUSDT' THEN 'unmatched'
             WHEN symbol = 'S3USDT' THEN 'ambiguous' ELSE 'ok' END AS status,
        CASE WHEN "date" LIKE '%-03' THEN 0 ELSE n END AS "rows"
    FROM made
)
SELECT * FROM landed
UNION ALL
SELECT DISTINCT 'S9USDT-trades-' || "date" || '.zip', "date", 'S9USDT', 'missing', 0 FROM landed
"""


def all_sql() -> dict[str, str]:
    spot, futures = V["spot_trades"], V["futures_trades"]
    on_day = f"WHERE CAST(\"timestamp\" AS DATE) = DATE '{AS_OF}'"
    cut = f"\"date\" BETWEEN DATE '{AS_OF}' - INTERVAL 364 DAY AND DATE '{AS_OF}'"
    year = f"\"date\" BETWEEN DATE '{AS_OF}' - INTERVAL 365 DAY AND DATE '{AS_OF}' - INTERVAL 1 DAY"
    ts = '"timestamp"'
    feed = same("timestamp", *KEYS)
    metrics = select(
        {
            "timestamp": "time_period_start",
            **same(*KEYS),
            "sum_open_interest": r6("open"),
            "sum_open_interest_value": r6("high"),
            "count_toptrader_long_short_ratio": r6("low"),
            "sum_toper_long_short_ratio": r6("close"),
            "count_long_short_ratio": r6("volume"),
            "sum_taker_long_short_vol_ratio": "CAST(NULL AS DOUBLE)",
        },
        V["bars_1m"],
    )
    return {
        "daily_trade_stats_spot": stats_query("spot"),
        "daily_trade_stats_futures": stats_query("futures"),
        "daily_trade_stats_hot": stats_query("futures", hot_trades()),
        "daily_ohlcv_spot": ohlcv_query("bars_1m", scale=6),
        "daily_ohlcv_spot_end_label": ohlcv_query("bars_1m", "end", 6),
        "daily_ohlcv_futures": ohlcv_query("futures_bars"),
        "rolling_trade_features": rolling_query(),
        "rolling_trade_features_double": select(
            {
                **same(*ID, *[f"{c}_{n}d" for c in COUNTS for n in (1, *WINDOWS)]),
                **rounded(*[f"{c}_{n}d" for c in MONEY for n in (1, *WINDOWS)]),
            },
            rolling(stats(V["spot_trades"])),
        ),
        "rolling_trade_latest": rolling_query(
            'QUALIFY row_number() OVER (PARTITION BY symbol_id ORDER BY "date" DESC) = 1'
        ),
        "rolling_trade_as_of": rolling_query(f"WHERE \"date\" = DATE '{AS_OF}'", cut),
        "dedupe_trades": dedupe(),
        "gap_fill_bars": gaps(False),
        "gap_fill_bars_zero_volume": gaps(True),
        "parse_klines_spot": bars_query("bars_1m"),
        "parse_klines_futures": bars_query(
            "futures_bars",
            {"quote_volume": "volume * 2", "taker_buy_volume": "volume / 2", "taker_buy_quote_volume": "volume"},
        ),
        "parse_trades_spot": trades_query("spot_trades", {"is_best_match": "true"}),
        "parse_trades_futures": trades_query("futures_trades"),
        "parse_funding": select(
            {**feed, "funding_interval_hours": "8", "last_funding_rate": r6("price / 1000000")}, futures
        ),
        "parse_depth": select(
            {
                **feed,
                "percentage": r6("quantity"),
                "depth": r6("price"),
                "notional": r6("quote_quantity"),
            },
            spot,
        ),
        "parse_metrics": metrics,
        "symbol_universe": (
            f"SELECT DISTINCT {SYMBOL} AS symbol_id FROM ({spot}) s"
            f" WHERE {SYMBOL} IN (SELECT {SYMBOL} FROM ({futures}) f)"
        ),
        "symbol_universe_on_date": (
            f"SELECT DISTINCT {SYMBOL} AS symbol_id FROM ({spot}) s {on_day}"
            f" AND {SYMBOL} IN (SELECT {SYMBOL} FROM ({futures}) f {on_day})"
        ),
        "listing_filter": (
            "SELECT *, baseAsset || '_' || quoteAsset || '_BINANCE' AS symbol_id"
            f" FROM ({V['listing']}) l WHERE quoteAsset LIKE '%USD%' AND isSpotTradingAllowed"
            " AND isMarginTradingAllowed AND baseAsset NOT LIKE '%USD%' AND baseAsset NOT LIKE '%USTC%'"
        ),
        "quote_assets": (
            "SELECT quoteAsset AS asset_id_quote, count(*) AS symbols, count(DISTINCT baseAsset) AS bases"
            f" FROM ({V['listing']}) l WHERE quoteAsset IN ('USDT', 'USDC', 'BUSD') GROUP BY quoteAsset"
        ),
        "spot_futures_join": start().query(),
        "spot_futures_join_universe": (
            f"SELECT * FROM ({start().query()}) j WHERE {year} AND symbol_id IN"
            f" (SELECT {SYMBOL} FROM ({futures}) f)"
        ),
        "time_features": add_time(start()).query(),
        "returns_features": add_returns(start()).query(),
        "returns_features_long": add_returns(start(), (1, 7, 30, 180), (30, 180)).query(),
        "risk_features": add_risk(start()).query(),
        "trade_features": add_trade(start()).query(),
        "interaction_features": add_interaction(start()).query(),
        "rolling_zscore": add_rz(add_interaction(add_returns(start()))).query(),
        "ml_features": add_rz(
            add_interaction(add_trade(add_risk(add_returns(add_time(start())))))
        ).query(),
        "order_check": (
            f"SELECT {SYMBOL} AS symbol_id, CAST({ts} AS DATE) AS \"date\", count(*) AS \"rows\""
            f" FROM ({spot}) t GROUP BY ALL HAVING count(*) > 1"
        ),
        "forward_label": add_returns(start(), (7,), (30,))
        .add({"futures_forward_returns_7": f"lead(futures_returns_7, 7) {DAY}"})
        .query(),
        "training_set": training(),
        "user_transformer": scaled("close_spot", "volume_spot", "close_futures"),
        "boosted_trees": boosted(trees=2, depth=3),
        "predict_day": (
            f'SELECT symbol_id, "date", true AS finite FROM ({joined()}) j'
            f" WHERE close_futures IS NOT NULL AND \"date\" = DATE '{SCORING_RUN}' - INTERVAL 1 DAY"
        ),
        "next_start": meta_dates("make_timestamp(coalesce(trade_data_end, trade_data_start) * 1000)"),
        "next_start_floor": meta_dates(
            "greatest(make_timestamp(futures_metrics_data_end * 1000), TIMESTAMP '2021-12-01')"
        ),
        "load_plan_months": plan(first_month("futures_trade_data_end", 1), "MONTH", UNTIL, "trades", "%Y-%m"),
        "load_plan_days": plan("'2023-01-01'", "DAY", "2023-04-15", "bookDepth", "%Y-%m-%d"),
        "missing_archives": (
            f"SELECT * FROM ({plan(first_month('futures_trade_data_end', 0), 'MONTH', UNTIL, 'trades', '%Y-%m')}) p"
            " WHERE archive NOT IN (SELECT asset_id_base || asset_id_quote || '-trades-' ||"
            f" strftime({ts}, '%Y-%m') || '.zip' FROM ({futures}) t)"
        ),
        "high_water": hw(),
        "advance_high_water": marks(advanced()),
        "missing_symbols": absent(),
        "extend_metadata": marks(extended()),
        "write_partitions": ohlcv_query("bars_1m", scale=6),
        "write_by_date": ohlcv_query("bars_1m", scale=6),
        "write_raw": bars_query("bars_1m"),
        "write_feed": metrics,
        "write_csv_gz": bars_query("bars_1m"),
        "write_metadata": marks(advanced()),
        "append_replace": dedupe(),
        "exchange_listing": (
            "SELECT baseAsset || quoteAsset AS symbol, baseAsset, quoteAsset, isSpotTradingAllowed,"
            f" isMarginTradingAllowed FROM ({V['listing']}) l"
        ),
        "advance_marks": marks(advanced("candle_data_end", "bars_1m", "time_period_end")),
        "ingest_stream_trades": event_trades(),
        "ingest_stream_two_batches": event_trades(),
        "archive_round_trip": trades_query("spot_trades", {"is_best_match": "true"}),
        "archive_outcomes": archive_report(),
    }
