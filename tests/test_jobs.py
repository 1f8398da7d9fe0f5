"""Landed archives through every daily job to features."""

import datetime as dt
import zipfile
from pathlib import Path

import pytest

from tickloom.plans import jobs
from tickloom.sources import archives, datasets

RUN = "2024-01-11"
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(10)]


def epoch_ms(day, minutes):
    at = dt.datetime.combine(day, dt.time(), dt.timezone.utc) + dt.timedelta(minutes=minutes)
    return int(at.timestamp() * 1000)


def zipped(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / f"{name}.zip", "w") as z:
        z.writestr(f"{name}.csv", "".join(f"{x}\n" for x in lines))


def land(base, symbol, price):
    for i, day in enumerate(DAYS):
        p = price + i
        bars = [f"{epoch_ms(day, m)},{p},{p + 1},{p - 1},{p + m / 10},2,{epoch_ms(day, m + 1) - 1},0,3,0,0,0" for m in (0, 1, 4)]
        trades = [f"{i * 10 + k},{p},1,{p * (k + 1)},{epoch_ms(day, k)},{'true' if k % 2 else 'false'}" for k in range(4)]
        zipped(base / "bars", f"{symbol}USDT-1m-{day}", bars)
        zipped(base / "trades", f"{symbol}USDT-trades-{day}", [t + ",true" for t in trades])


def test_archives_to_features(spark, tmp_path):
    for symbol, price in (("BTC", 100), ("ETH", 50)):
        land(tmp_path, symbol, price)
    symbols = spark.createDataFrame(
        [("BTC", "USDT", "X"), ("ETH", "USDT", "X"), ("ADA", "EUR", "X")],
        "asset_id_base string, asset_id_quote string, exchange_id string",
    )
    root = lambda name: str(tmp_path / "lake" / name)
    for dataset, landing, market in (("candle", "bars", "spot"), ("futures_candle", "bars", "futures"), ("trade", "trades", "trades")):
        outcome = jobs.ingest(spark, str(tmp_path / landing), dataset, symbols, root(f"raw_{market}"))
        assert {r["status"] for r in outcome.collect()} == {"ok"} and outcome.count() == 20
    raw = datasets.read_dataset(spark, root("raw_spot"))
    assert raw.where("date = DATE'2024-01-03' AND symbol_id = 'BTC_USDT_X'").count() == 5  # 3 bars, 2 filled

    for day in [*DAYS[1:], dt.date.fromisoformat(RUN)]:
        jobs.aggregate_bars(spark, root("raw_spot"), root("spot"), str(day))
        jobs.aggregate_bars(spark, root("raw_futures"), root("futures"), str(day))
        jobs.aggregate_trades(spark, root("raw_trades"), root("stats"), str(day))
    daily = datasets.read_dataset(spark, root("spot"))
    assert daily.count() == 20
    stats = datasets.read_dataset(spark, root("stats")).where("date = DATE'2024-01-10' AND symbol_id = 'BTC_USDT_X'").first()
    assert (stats["num_buys"], stats["num_sells"], stats["total_dollar_volume"]) == (2, 2, 109 * 10)

    jobs.roll_trades(spark, root("stats"), root("rolling"), RUN)
    jobs.roll_trades(spark, root("stats"), root("rolling"), RUN)
    rolled = datasets.read_dataset(spark, root("rolling"))
    assert rolled.count() == 2
    assert rolled.where("symbol_id = 'BTC_USDT_X'").first()["num_trades_7d"] == 28

    jobs.make_features(spark, root("spot"), root("futures"), root("stats"), root("features"), RUN, root("rolling"))
    made = datasets.read_dataset(spark, root("features"))
    assert made.count() == 2
    row = made.where("symbol_id = 'BTC_USDT_X'").first()
    assert row["num_trades_7d"] == 28 and row["futures_returns_7"] is not None and row["basis"] == 0

    meta = symbols.selectExpr("*", "0L AS trade_data_start", "CAST(NULL AS BIGINT) AS trade_data_end")
    datasets.write_metadata(meta, root("meta"))
    jobs.advance_marks(spark, root("meta"), root("raw_trades"), "trade")
    ends = {r["asset_id_base"]: r["trade_data_end"] for r in datasets.read_metadata(spark, root("meta")).collect()}
    assert ends == {"BTC": epoch_ms(DAYS[-1], 3), "ETH": epoch_ms(DAYS[-1], 3), "ADA": None}


def test_a_stray_row_does_not_clear_its_day(spark, tmp_path):
    """Trades of midnight in the archive of the day before are kept, beside that day's own,
    whichever lands first, and are counted on their own day."""
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    own = [f"{k},10,1,10,{epoch_ms(two, 60 + k)},true" for k in (1, 2)]
    zipped(tmp_path / "second", f"BTCUSDC-trades-{two}", own)
    zipped(tmp_path / "first", f"BTCUSDC-trades-{one}", [f"8,10,1,10,{epoch_ms(one, 5)},true", f"9,10,1,10,{epoch_ms(two, 0)},true"])
    symbols = spark.createDataFrame(
        [("BTC", "USDC", "X")], "asset_id_base string, asset_id_quote string, exchange_id string"
    )
    for order in (("first", "second"), ("second", "first"), ("first", "second", "first")):
        root = str(tmp_path / "-".join(order) / "raw")
        for landing in order:
            outcome = jobs.ingest(spark, str(tmp_path / landing), "futures_trade", symbols, root).collect()
            assert [r["status"] for r in outcome] == ["ok"]
        assert sorted(r["trade_id"] for r in datasets.read_dataset(spark, root).collect()) == [1, 2, 8, 9]
        assert "archive_period" not in datasets.read_dataset(spark, root).columns
        stats = str(tmp_path / "-".join(order) / "stats")
        for run in ("2024-01-02", "2024-01-03"):
            jobs.aggregate_trades(spark, root, stats, run)
        got = {str(r["date"]): r["num_sells"] for r in datasets.read_dataset(spark, stats).collect()}
        assert got == {"2024-01-01": 1, "2024-01-02": 3}


def test_archives_above_the_limit_fail_the_job(spark, tmp_path):
    """The others are written first; a caller may accept that rows are left out."""
    day = dt.date(2024, 1, 1)
    land_at, root = tmp_path / "landing", str(tmp_path / "raw")
    zipped(land_at, f"BTCUSDC-trades-{day}", [f"1,10,1,10,{epoch_ms(day, 1)},true"])
    for symbol in ("ETH", "XRP"):  # only ETH is listed
        zipped(land_at, f"{symbol}USDC-trades-{day}", [f"{k},10,1,10,{epoch_ms(day, 2)},true" for k in range(500)])
    limit = max(Path(f).stat().st_size for f in land_at.glob("BTC*.zip"))
    symbols = spark.createDataFrame(
        [("BTC", "USDC", "X"), ("ETH", "USDC", "X")], "asset_id_base string, asset_id_quote string, exchange_id string"
    )
    run = lambda **more: jobs.ingest(spark, str(land_at), "futures_trade", symbols, root, content_limit=limit, **more)
    with pytest.raises(archives.ArchivesTooLarge, match="^1 archives .*ETHUSDC-trades-2024-01-01.zip$"):
        run()
    assert [r["trade_id"] for r in datasets.read_dataset(spark, root).collect()] == [1]
    assert sorted(r["status"] for r in run(skip_large=True).collect()) == ["error", "error", "ok"]
