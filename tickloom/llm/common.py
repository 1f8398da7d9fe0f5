"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import scratch_path

#: Characters of text that a task works on at a time, whatever the size of an Arrow batch.
SLICE_CHARS = 4_000_000


def whole_text(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: cuts the lineage in a
    way that a lost executor cannot undo."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_CHARS
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about ``size`` bytes of text, or one row."""
    for batch in batches:
        lengths = np.array(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        piece = np.cumsum(lengths) // size
        edges = np.flatnonzero(np.diff(piece)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows]):
            if end > start:
                yield batch.slice(start, end - start)


def table_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
