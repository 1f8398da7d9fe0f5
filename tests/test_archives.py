import io
import zipfile

import pytest

from tickloom.sources.archives import data_rows, outcomes, read_zip_csv, symbols_from_path

TRADES = ["1,10.5,2,21,1704067200000,true", "2,11,1,11,1704067260000,false", "2,11,1,11,1704067260000,false"]


def put(folder, name, lines, header=None):
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name.replace(".zip", ".csv"), "".join(f"{x}\n" for x in ([header] if header else []) + lines))


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing a+b"
    folder.mkdir()
    put(folder, "BTCUSDT-trades-2024-01-01.zip", TRADES, "id,price,qty,quote_qty,time,is_buyer_maker")
    put(folder, "ETHUSDT-trades-2024-01-01.zip", TRADES)
    put(folder, "XRPUSDT-trades-2024-01-01.zip", [])
    (folder / "ADAUSDT-trades-2024-01-01.zip").write_bytes(b"not a zip")
    # A member that breaks while being read: valid start, damaged middle.
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as z:
        z.writestr("DOGEUSDT-trades-2024-01-01.csv", "".join(f"{x}\n" for x in TRADES * 50_000))
    damaged = bytearray(buffer.getvalue())
    damaged[-2_000] ^= 0xFF
    (folder / "DOGEUSDT-trades-2024-01-01.zip").write_bytes(bytes(damaged))
    return str(folder)


def test_archives_and_their_outcomes(spark, landing):
    read = read_zip_csv(spark, landing, 6).persist()
    got = {r["symbol"]: r for r in outcomes(read).collect()}
    assert {s: r["status"] for s, r in got.items()} == {
        "BTCUSDT": "ok", "ETHUSDT": "ok", "XRPUSDT": "empty", "ADAUSDT": "error", "DOGEUSDT": "error",
    }
    assert got["BTCUSDT"]["rows"] == 4 and got["BTCUSDT"]["date"] == "2024-01-01"
    assert got["ADAUSDT"]["error"] and got["BTCUSDT"]["error"] is None
    # The damaged archive gave rows before it broke; none of them counts.
    assert read.where("status IS NULL AND path LIKE '%DOGE%'").count() > 0
    data = data_rows(read)
    assert data.count() == 7
    assert data.where("path LIKE '%DOGE%'").count() == 0
    read.unpersist()


def test_symbols_are_found_by_archive_name(spark, landing):
    symbols = spark.createDataFrame(
        [("BTC", "USDT", "X"), ("ADA", "USDT", "X")], "asset_id_base string, asset_id_quote string, exchange_id string"
    )
    named = symbols_from_path(data_rows(read_zip_csv(spark, landing, 6)), symbols)
    assert {r["asset_id_base"] for r in named.collect()} == {"BTC"}


def test_archives_above_the_limit_are_reported(spark, landing):
    read = read_zip_csv(spark, landing, 6, content_limit=0)
    got = outcomes(read).collect()
    assert len(got) == 5 and {r["status"] for r in got} == {"error"}
    assert all("above the limit" in r["error"] for r in got)
    assert data_rows(read).count() == 0


def test_unmatched_ambiguous_and_missing_archives(spark, landing):
    keys = "asset_id_base string, asset_id_quote string, exchange_id string"
    symbols = spark.createDataFrame(
        [("BTC", "USDT", "X"), ("BTC", "USDT", "X"), ("ETH", "USDT", "X"), ("ETH", "USDT", "Y"), ("ADA", "USDT", "X")], keys
    )
    expected = spark.createDataFrame(
        [("BTCUSDT-trades-2024-01-01.zip",), ("BTCUSDT-trades-2024-01-02.zip",)], "archive string"
    )
    read = read_zip_csv(spark, landing, 6)
    got = {(r["symbol"], r["date"]): r["status"] for r in outcomes(read, symbols, expected).collect()}
    assert got == {
        ("BTCUSDT", "2024-01-01"): "ok",
        ("ETHUSDT", "2024-01-01"): "ambiguous",
        ("XRPUSDT", "2024-01-01"): "unmatched",
        ("ADAUSDT", "2024-01-01"): "error",
        ("DOGEUSDT", "2024-01-01"): "error",
        ("BTCUSDT", "2024-01-02"): "missing",
    }
    assert symbols_from_path(data_rows(read), symbols).count() == 4  # BTC alone, once


def test_archives_are_packed_in_pieces_from_sorted_lines(spark):
    from pyspark.sql import functions as F

    from tickloom.sources.archives import pack_archives, unpack

    lines = [(name, f"{i:03}", 'a "b", c' if i % 2 else None) for i in range(57) for name in ("X", "Y", None)]
    table = spark.createDataFrame(lines, "name string, c0 string, c1 string").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        packed = pack_archives(table.select("c0", "c1", "name"), F.col("name"))
        # No group of rows is a frame of its own.
        assert "FlatMapGroups" not in packed._jdf.queryExecution().toString()
        got = packed.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r["path"] or "") for r in got) == ["", "X", "Y"]
    for r in got:
        assert r["length"] == len(r["content"])
        with zipfile.ZipFile(io.BytesIO(r["content"])) as archive:
            text = archive.read("lines.csv").decode().splitlines()
        assert text == [f'{i:03},"a ""b"", c"' if i % 2 else f"{i:03}," for i in range(57)]
    back = unpack(spark.createDataFrame([(r["path"], r["length"], bytes(r["content"])) for r in got if r["path"]], "path string, length long, content binary"), 2)
    assert back.where("status = 'ok'").agg(F.sum("rows")).first()[0] == 114
