"""Zipped CSV archives as DataFrames of text rows plus one outcome row per archive.

Spark lists the archives, reads them with its binary reader and spreads them over tasks; a
task unzips one at a time and streams it out in bounded chunks, so memory follows the zipped
size of one archive.  A cell may not exceed 2 GB: archives above ``CONTENT_LIMIT`` are
reported as errors that name the limit, and are not read some other way; ``jobs.ingest`` fails
on them unless its caller accepts that.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalar import KEYS

CONTENT_LIMIT = 1024 * 1024 * 1024
CHUNK_ROWS = 50_000
BROADCAST_PATHS = 100_000  # at about 200 bytes a path
_ABOVE = "bytes are above the limit of"


class ArchivesTooLarge(Exception):
    """Archives above the limit were left out."""


def scan_archives(spark: SparkSession, path: str, content_limit: int = CONTENT_LIMIT) -> DataFrame:
    """``path``, ``length`` and ``content`` of every ``*.zip`` below ``path``; the content is
    null above the limit."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    # The length filter is evaluated on the listing, before any content is read.  A task is
    # given files up to spark.sql.files.maxPartitionBytes in total, which bounds a batch.
    small = files.where(F.col("length") <= content_limit).select("path", "length", "content")
    large = files.where(F.col("length") > content_limit).select(
        "path", "length", F.lit(None).cast("binary").alias("content")
    )
    return small.unionByName(large)


def unpack(files: DataFrame, n_fields: int, content_limit: int = CONTENT_LIMIT) -> DataFrame:
    """Text rows ``c0..`` of the archives in ``files``, and outcome rows.

    ``status`` is null on a data row; on an archive's single outcome row it is ``ok``,
    ``empty`` or ``error``, with the message in ``error`` and the row count in ``rows``.
    Where the archives come from does not matter: a scan, a stream's batch, a table.
    """
    fields = [f"c{i}" for i in range(n_fields)]
    schema = ", ".join(
        ["path string", *[f"{c} string" for c in fields], "status string", "error string", "rows bigint"]
    )

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, length, content in zip(batch["path"], batch["length"], batch["content"]):
                if content is None:
                    error = f"{length} {_ABOVE} {content_limit} bytes"
                    yield _outcome(source, "error", error, 0, fields)
                else:
                    yield from _one_archive(source, content, fields)

    return files.select("path", "length", "content").mapInPandas(extract, schema)


def read_zip_csv(
    spark: SparkSession, path: str, n_fields: int, content_limit: int = CONTENT_LIMIT
) -> DataFrame:
    """Text and outcome rows of every ``*.zip`` below ``path``."""
    return unpack(scan_archives(spark, path, content_limit), n_fields, content_limit)


def pack_archives(lines: DataFrame, path: Column) -> DataFrame:
    """The reverse of :func:`unpack`: text rows ``c0..`` as zipped CSV archives, a row of
    ``path``, ``length`` and ``content`` per distinct ``path``, lines in order.

    An archive is one cell, so it meets in one task, like the file it stands for.  Spark sorts
    its lines; the task holds a batch of them and the archive's zipped bytes.
    """
    fields = [c for c in lines.columns if c.startswith("c") and c[1:].isdigit()]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current: _Zipped | None = None
        for batch in batches:
            # Paths are in order, so each takes one run of rows (nulls too).
            runs = (batch["path"] != batch["path"].shift()) & ~(batch["path"].isna() & batch["path"].shift().isna())
            for _, run in batch.groupby(runs.cumsum(), sort=False):
                name = None if pd.isna(run["path"].iloc[0]) else run["path"].iloc[0]
                if current is None or name != current.path:
                    if current is not None:
                        yield current.row()
                    current = _Zipped(name)
                current.add(run[fields])
        if current is not None:
            yield current.row()

    named = lines.select(path.alias("path"), *fields)
    ordered = named.repartition("path").sortWithinPartitions("path", *[F.col(c).asc_nulls_last() for c in fields])
    return ordered.mapInPandas(pack, "path string, length long, content binary")


class _Zipped:
    """An archive that grows by some lines at a time."""

    def __init__(self, path: str | None):
        self.path, self._out = path, io.BytesIO()
        self._archive = zipfile.ZipFile(self._out, "w", zipfile.ZIP_DEFLATED)
        # A fixed time, so that the same rows give the same bytes.
        member = zipfile.ZipInfo("lines.csv", (2000, 1, 1, 0, 0, 0))
        member.compress_type = zipfile.ZIP_DEFLATED
        self._text = self._archive.open(member, "w", force_zip64=True)

    def add(self, lines: pd.DataFrame) -> None:
        self._text.write(lines.to_csv(header=False, index=False).encode())

    def row(self) -> pd.DataFrame:
        self._text.close()
        self._archive.close()
        content = self._out.getvalue()
        return pd.DataFrame([{"path": self.path, "length": len(content), "content": content}])


def _outcome(path: str, status: str, error: str | None, rows: int, fields: list[str]) -> pd.DataFrame:
    return pd.DataFrame([{**dict.fromkeys(fields), "path": path, "status": status, "error": error, "rows": rows}])


def _one_archive(path: str, content: bytes, fields: list[str]) -> Iterator[pd.DataFrame]:
    rows, error = 0, None
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for member in archive.namelist():
                with archive.open(member) as text:
                    for chunk in pd.read_csv(
                        text,
                        header=None,
                        names=fields,
                        index_col=False,
                        dtype=str,
                        keep_default_na=False,
                        na_values=[""],
                        chunksize=CHUNK_ROWS,
                    ):
                        rows += len(chunk)
                        yield chunk.assign(path=path, status=None, error=None, rows=None)
    except pd.errors.EmptyDataError:
        pass
    except Exception as e:  # an unreadable archive is reported, not fatal
        error = f"{type(e).__name__}: {e}"
    status = "error" if error else "ok" if rows else "empty"
    yield _outcome(path, status, error, rows, fields)


def _file_name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def _pair() -> Column:
    """``<base><quote>``, the start of an archive's name."""
    return F.element_at(F.split(_file_name(), "-"), 1)


def _listed_pairs(symbols: DataFrame) -> DataFrame:
    """``_pair``, the number of listed symbols of that name, and the keys of one."""
    pair = F.concat("asset_id_base", "asset_id_quote").alias("_pair")
    distinct = symbols.select(pair, F.struct(*KEYS).alias("keys")).distinct()
    return distinct.groupBy("_pair").agg(F.count("*").alias("_symbols"), F.min("keys").alias("_keys"))


def symbols_from_path(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """Add the key columns, found by matching ``<base><quote>`` in the archive name.

    ``symbols`` holds the three keys per symbol.  A name that fits several symbols (two
    exchanges, or two ways to split it) is not guessed: such archives give no rows, and
    ``outcomes`` reports them.
    """
    listed = _listed_pairs(symbols).where("_symbols = 1").select("_pair", *[F.col(f"_keys.{k}") for k in KEYS])
    return rows.join(listed, _pair() == F.col("_pair"), "inner").drop("_pair")


def archive_period(path: str = "path"):
    """``yyyy-MM`` or ``yyyy-MM-dd`` at the end of an archive's name."""
    return F.regexp_extract(path, r"(\d{4}-\d{2}(?:-\d{2})?)\.zip$", 1)


def outcomes(rows: DataFrame, symbols: DataFrame | None = None, expected: DataFrame | None = None) -> DataFrame:
    """One row per archive: what became of it.

    With ``symbols``, archives that were read but fit no symbol are ``unmatched`` and those
    that fit several ``ambiguous``.  With ``expected`` (names in ``archive``), those that have
    not landed follow as ``missing``.
    """
    shown = (archive_period().alias("date"), _pair().alias("symbol"), "status", "error", "rows")
    found = rows.where(F.col("status").isNotNull()).select("path", *shown)
    if symbols is not None:
        fits = _listed_pairs(symbols).select(F.col("_pair").alias("symbol"), "_symbols")
        status = (
            F.when(F.col("status") == "error", "error")
            .when(F.col("_symbols").isNull(), "unmatched")
            .when(F.col("_symbols") > 1, "ambiguous")
            .otherwise(F.col("status"))
        )
        found = found.join(fits, "symbol", "left").withColumn("status", status).select(*found.columns)
    if expected is not None:
        names = expected.select(F.col("archive").alias("path")).distinct()
        absent = names.join(found.select(_file_name().alias("path")), "path", "left_anti")
        absent = absent.withColumns({"status": F.lit("missing"), "error": F.lit(None).cast("string")})
        found = found.unionByName(absent.withColumn("rows", F.lit(0).cast("bigint")).select("path", *shown))
    return found


def too_large(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """``path`` of the archives above the limit whose name fits a listed symbol."""
    left = rows.where((F.col("status") == "error") & F.col("error").contains(_ABOVE)).select("path", _pair().alias("_pair"))
    return left.join(_listed_pairs(symbols), "_pair", "left_semi").select("path")


def data_rows(rows: DataFrame, n_broken: int | None = None) -> DataFrame:
    """Rows of the archives that were read to the end.

    An archive that broke half-way contributes nothing, like one that cannot be opened.
    ``n_broken``, when known, spares the join or lets the short list be broadcast.
    """
    data = rows.where(F.col("status").isNull()).drop("status", "error", "rows")
    if n_broken == 0:
        return data
    broken = rows.where(F.col("status") == "error").select("path")
    if n_broken is not None and n_broken <= BROADCAST_PATHS:
        broken = F.broadcast(broken)
    return data.join(broken, "path", "left_anti")
