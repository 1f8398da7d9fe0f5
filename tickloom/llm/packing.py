"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs n + n * n / balance (the linear layers and attention inside the
piece).  Each task gathers a group of documents, makes just as many sequences as the group's
tokens fill, and hands the pieces out in descending length, each to the sequence of lowest
cost that has room for it; when none has, the cheapest with any room takes what fits and
the rest goes back into the order.  The tokens beyond the last whole sequence fill sequences
whose lengths are powers of two, which need no padding.

Nothing is shuffled: a group lives in one task and holds at most ``group_tokens`` ids and
one document more.  Null texts count as empty, repeated rows are packed each, null ids stay
null, an empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tickloom.llm.common import slices, table_batch, whole_text
from tickloom.llm.tokens import encoder, with_end

CAPACITY = 2048
GROUP_TOKENS = 1 << 20
#: Length at which attention costs as much as the linear layers.
BALANCE = 1024.0

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def sequence_rooms(tokens: int, capacity: int = CAPACITY) -> np.ndarray:
    """Whole sequences, then powers of two for what is left."""
    whole, rest = divmod(tokens, capacity)
    small = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([capacity] * whole + small, dtype=np.int64)


def assign(lengths: list[int], capacity: int = CAPACITY, balance: float = BALANCE) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a group."""
    rooms = sequence_rooms(sum(lengths), capacity)
    left, costs = rooms.copy(), np.zeros(len(rooms))
    waiting = []
    for doc, n in enumerate(lengths):
        waiting += [(-min(capacity, n - at), doc, at) for at in range(0, n, capacity)]
    heapq.heapify(waiting)
    pieces = []
    while waiting:
        n, doc, at = heapq.heappop(waiting)
        n = -n
        fits = left >= n
        if not fits.any():
            fits = left > 0
        seq = int(np.argmin(np.where(fits, costs, np.inf)))
        took = min(n, int(left[seq]))
        pieces.append((doc, at, took, seq, int(rooms[seq] - left[seq])))
        left[seq] -= took
        costs[seq] += took + took * took / balance
        if took < n:
            heapq.heappush(waiting, (took - n, doc, at + took))
    return pieces


def _packed(ids: list[np.ndarray], doc_ids: list[int | None], first: int, capacity: int, balance: float):
    pieces = assign([len(x) for x in ids], capacity, balance)
    crcs = [zlib.crc32(ids[d][s : s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
    return table_batch(
        PIECES,
        doc_id=[doc_ids[p[0]] for p in pieces],
        start=[p[1] for p in pieces],
        length=[p[2] for p in pieces],
        ids_crc32=crcs,
        doc_tokens=[len(ids[p[0]]) for p in pieces],
        sequence_id=[first + p[3] for p in pieces],
        offset=[p[4] for p in pieces],
    ), max(p[3] for p in pieces) + 1


def pack_sequences(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    balance: float = BALANCE,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece.  ``sequence_id`` holds the task in its upper bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        next_id = TaskContext.get().partitionId() << 36
        ids: list[np.ndarray] = []
        owners: list[int | None] = []
        held = 0
        for batch in slices(batches):
            for doc, got in zip(batch["doc_id"].to_pylist(), with_end(encode(batch["text"].to_pylist()))):
                ids.append(got)
                owners.append(doc)
                held += len(got)
                if held >= group_tokens:
                    rows, used = _packed(ids, owners, next_id, capacity, balance)
                    yield rows
                    next_id, ids, owners, held = next_id + used, [], [], 0
        if ids:
            yield _packed(ids, owners, next_id, capacity, balance)[0]

    schema = ", ".join(f"{f.name} long" for f in PIECES)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, schema)
