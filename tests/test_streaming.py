import datetime as dt

import pytest

from tickloom import schemas
from tickloom.sources import archives
from tickloom.streaming.ingest import ingest_archive_stream, ingest_stream, merge_into_days

T0 = dt.datetime(2024, 1, 1, 12)


def trades(rows, *items):
    return rows(
        schemas.FUTURES_TRADES,
        *[{"trade_id": i, "timestamp": T0 + dt.timedelta(hours=h), "price": p, "side": "buy"} for i, h, p in items],
    )


def held(spark, root):
    df = spark.read.parquet(root)
    return sorted((r["trade_id"], r["date"].day, r["price"]) for r in df.collect())


def test_files_are_loaded_once_and_late_repeats_resolved(spark, rows, tmp_path):
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    run = lambda: ingest_stream(spark, landing, schemas.FUTURES_TRADES, out, progress).awaitTermination()
    trades(rows, (1, 0, 1.0), (2, 1, 2.0), (2, 1, 2.0), (3, 24, 3.0)).write.mode("append").parquet(landing)
    run()
    assert held(spark, out) == [(1, 1, 1.0), (2, 1, 2.0), (3, 2, 3.0)]
    run()  # nothing new
    assert held(spark, out) == [(1, 1, 1.0), (2, 1, 2.0), (3, 2, 3.0)]
    # Much later an earlier version of trade 3 and a new day arrive.
    trades(rows, (3, 23, 9.0), (4, 240, 4.0)).write.mode("append").parquet(landing)
    run()
    assert held(spark, out) == [(1, 1, 1.0), (2, 1, 2.0), (3, 2, 9.0), (4, 11, 4.0)]


def test_replaying_a_batch_changes_nothing(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    batch = trades(rows, (1, 0, 1.0), (2, 1, 2.0))
    for attempt in ("a", "a", "b"):  # the second finds the first's staged rows
        merge_into_days(batch, out, str(tmp_path / attempt))
        assert held(spark, out) == [(1, 1, 1.0), (2, 1, 2.0)]


def test_watermark_option(spark, rows, tmp_path):
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    trades(rows, (1, 0, 1.0), (1, 0, 1.0)).write.parquet(landing)
    ingest_stream(spark, landing, schemas.FUTURES_TRADES, out, progress, watermark="1 day").awaitTermination()
    assert held(spark, out) == [(1, 1, 1.0)]


@pytest.mark.parametrize("late_first", [True, False])
def test_copies_across_midnight_are_kept_once(spark, rows, tmp_path, late_first):
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    early, late = (1, 11, 1.0), (1, 13, 9.0)  # 23:00 and 01:00 of the next day
    for item in (late, early) if late_first else (early, late):
        trades(rows, item).write.mode("append").parquet(landing)
        ingest_stream(spark, landing, schemas.FUTURES_TRADES, out, progress).awaitTermination()
    assert held(spark, out) == [(1, 1, 1.0)]
    # The next day has lost its only row, and its folder.
    assert not list((tmp_path / "out").glob("symbol_id=*/date=2024-01-02"))


def test_copies_beyond_the_horizon_stay(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    for n, item in enumerate([(1, 0, 1.0), (1, 72, 2.0)]):
        merge_into_days(trades(rows, item), out, str(tmp_path / f"staged{n}"))
    assert held(spark, out) == [(1, 1, 1.0), (1, 4, 2.0)]
    merge_into_days(trades(rows, (1, 72, 2.0)), out, str(tmp_path / "staged2"), horizon=3)
    assert held(spark, out) == [(1, 1, 1.0)]


def test_interrupted_swap_is_finished(spark, rows, tmp_path, monkeypatch):
    from tickloom.streaming import ingest

    out, staged = str(tmp_path / "out"), str(tmp_path / "staged")
    merge_into_days(trades(rows, (1, 13, 9.0), (2, 0, 2.0)), out, str(tmp_path / "before"))
    with monkeypatch.context() as m:
        m.setattr(ingest, "_delete", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            merge_into_days(trades(rows, (1, 11, 1.0)), out, staged)
    merge_into_days(trades(rows, (1, 11, 1.0)), out, staged)
    assert held(spark, out) == [(1, 1, 1.0), (2, 1, 2.0)]


def zipped(spark, folder, name, *lines):
    fields = ", ".join(f"c{i} string" for i in range(6))
    packed = archives.pack_archives(spark.createDataFrame([tuple(line) for line in lines], fields), archives.F.lit(name))
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(packed.first()["content"])


def test_archives_are_streamed_as_they_land(spark, tmp_path):
    landing, out, report, progress = (tmp_path / n for n in ("landing", "out", "report", "progress"))
    symbols = spark.createDataFrame([("BTC", "USDT", "X")], "asset_id_base string, asset_id_quote string, exchange_id string")
    run = lambda: ingest_archive_stream(
        spark, str(landing), "futures_trade", symbols, str(out), str(report), str(progress)
    ).awaitTermination()
    noon = 1704110400000
    zipped(spark, landing, "BTCUSDT-trades-2024-01-01.zip", ("1", "10", "1", "10", str(noon), "false"), ("2", "11", "1", "11", str(noon), "true"))
    zipped(spark, landing, "ETHUSDT-trades-2024-01-01.zip", ("7", "10", "1", "10", str(noon), "false"))
    (landing / "BTCUSDT-trades-2024-01-02.zip").write_bytes(b"no zip")
    run()
    assert held(spark, str(out)) == [(1, 1, 10.0), (2, 1, 11.0)]
    zipped(spark, landing, "BTCUSDT-trades-2024-01-03.zip", ("2", "11", "1", "11", str(noon - 60_000), "true"), ("3", "5", "1", "5", str(noon), "true"))
    run()
    run()  # nothing new
    assert held(spark, str(out)) == [(1, 1, 10.0), (2, 1, 11.0), (3, 1, 5.0)]
    found = {r["path"].split("/")[-1]: r["status"] for r in spark.read.parquet(str(report)).collect()}
    assert found == {
        "BTCUSDT-trades-2024-01-01.zip": "ok",
        "ETHUSDT-trades-2024-01-01.zip": "unmatched",
        "BTCUSDT-trades-2024-01-02.zip": "error",
        "BTCUSDT-trades-2024-01-03.zip": "ok",
    }
