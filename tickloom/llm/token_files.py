"""Token-id files: one id array per block, document boundaries in Elias-Fano code.

A file is Parquet of blocks, so it is written and committed by Spark on any store.  A block's
``payload`` is, little-endian: magic ``TKB1``, counts of documents, of null document ids and
of ids (uint64 each), bytes per id (uint64), then three parts, each after its length (uint64): the
boundaries (documents + 1 offsets into the id array), the document ids less the smallest
one, both in Elias-Fano code, and the ids.  Blocks are numbered within shards and shards
follow document id, so the offsets of a block's documents in the whole corpus are its own
offsets and the ids of the blocks before.

Ties of a document id are ordered by text; null ids come first; null texts count as empty;
an empty table gives empty files; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import slices, table_batch, whole_text
from tickloom.llm.tokens import encoder, with_end

MAGIC = b"TKB1"
BLOCK_IDS = 1 << 20
#: A position of the unary part is kept for each so many elements.
SAMPLE = 256


class EliasFano:
    """A non-decreasing sequence of integers in about 2 + log2(range / count) bits each.

    The low bits of each element are packed; the high bits are a bit vector with a one at
    (high part + index).  ``select`` starts at a sampled one and counts bits from there.
    """

    def __init__(self, count: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits = count, low_bits
        self.lows, self.highs, self.samples = lows, highs, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, np.uint32))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        lows = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, lows, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def _low(self, index: np.ndarray) -> np.ndarray:
        out = np.zeros(len(index), np.int64)
        for b in range(self.low_bits):
            at = index * self.low_bits + b
            out |= (self.lows[at >> 3] >> (at & 7) & 1).astype(np.int64) << b
        return out

    def select(self, i: int) -> int:
        """Element i, reading only the bits between two samples."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.highs[byte]) >> (at & 7) << (at & 7)
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.highs[byte])
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return (one - i << self.low_bits) + int(self._low(np.array([i]))[0])

    def select_all(self) -> np.ndarray:
        """All elements, for readers that want every offset."""
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little")) if self.count else np.empty(0, np.int64)
        index = np.arange(self.count)
        return (ones[: self.count] - index << self.low_bits) + self._low(index)

    def to_bytes(self) -> bytes:
        head = struct.pack("<4Q", self.count, self.low_bits, len(self.lows), len(self.highs))
        return head + self.lows.tobytes() + self.highs.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        count, low_bits, n_low, n_high = struct.unpack_from("<4Q", data)
        lows = np.frombuffer(data, np.uint8, n_low, 32)
        highs = np.frombuffer(data, np.uint8, n_high, 32 + n_low)
        return cls(count, low_bits, lows, highs, np.frombuffer(data, "<u4", -1, 32 + n_low + n_high))


def write_block(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """A block of documents in ascending id order (null ids first)."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    base = int(known[0]) if len(known) else 0
    edges = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    flat = np.concatenate(ids).astype(f"<u{width}")
    out = [MAGIC, struct.pack("<4Qq", len(ids), len(ids) - len(known), len(flat), width, base)]
    gaps = known.astype(np.uint64) - np.int64(base).astype(np.uint64)  # exact over the whole range
    for part in (EliasFano.encode(edges).to_bytes(), EliasFano.encode(gaps).to_bytes(), flat.tobytes()):
        out += [struct.pack("<Q", len(part)), part]
    return b"".join(out)


class Block:
    """A block read back: document ids, boundaries and ids."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token block")
        self.n_docs, self.n_null, self.n_ids, width, self.base = struct.unpack_from("<4Qq", payload, 4)
        at, parts = 44, []
        for _ in range(3):
            (size,) = struct.unpack_from("<Q", payload, at)
            parts.append(payload[at + 8 : at + 8 + size])
            at += 8 + size
        self.edges, self._docs = EliasFano.from_bytes(parts[0]), EliasFano.from_bytes(parts[1])
        self.ids = np.frombuffer(parts[2], f"<u{width}")

    def doc_ids(self) -> list[int | None]:
        # Gaps are modulo 2**64, so ids may span all of a long's range.
        known = self._docs.select_all().astype(np.uint64) + np.int64(self.base).astype(np.uint64)
        return [None] * self.n_null + known.astype(np.int64).tolist()

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.edges.select(i) : self.edges.select(i + 1)]


_BLOCKS = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]
)
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, block_ids: int = BLOCK_IDS) -> None:
    """Encodes every text and writes the blocks.  One shuffle: ranges of document id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        width = 2 if enc.vocabulary <= 1 << 16 else 4
        owners: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            payload = write_block(owners, ids, width)
            return table_batch(
                _BLOCKS, shard=[shard], block=[number], n_docs=[len(ids)], n_ids=[held], payload=[payload]
            )

        for batch in slices(batches):
            for doc, got in zip(batch["doc_id"].to_pylist(), with_end(enc.encode(batch["text"].to_pylist()))):
                owners.append(doc)
                ids.append(got)
                held += len(got)
                if held >= block_ids:
                    yield block()
                    owners, ids, held, number = [], [], 0, number + 1
        if ids:
            yield block()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(run, "shard int, block int, n_docs long, n_ids long, payload binary")
    # The ids are not worth a page dictionary; zstd packs their upper bytes.
    made.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: its place in the corpus, its length and the checksum of its ids."""
    blocks = spark.read.schema("shard int, block int, n_docs long, n_ids long, payload binary").parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    # One row per shard, as many as there were tasks.
    before = F.sum("shard_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = sizes.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    within = F.sum("n_ids").over(
        Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = blocks.select("shard", "block", F.coalesce(within, F.lit(0)).alias("block_start")).join(shards, "shard")
    starts = starts.select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("base"))
    placed = blocks.select("shard", "block", "payload").join(starts, ["shard", "block"]).select("base", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch["base"].to_pylist(), batch["payload"]):
                block = Block(payload.as_buffer().to_pybytes())
                edges = block.edges.select_all()
                ids = block.ids.astype("<u4")
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
                yield table_batch(
                    _READ, doc_id=block.doc_ids(), start=edges[:-1] + base, n_tokens=np.diff(edges), ids_crc32=crcs
                )

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
