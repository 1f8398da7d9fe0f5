"""Alignment of two tokenizers over a corpus: inverted bitmaps per linked id pair.

Tokens of A and B that share bytes of a text are linked.  The ends of both cut a text into
segments, each within one token of either side, so every segment is one link and there are as
many as distinct ends; ends that both have bound the groups.

A slice of rows gives, per linked id pair, a document bitmap over its rows with planes for the
multiplicity: plane p holds the rows whose number of links of the pair has bit p.  A plane is
a sorted array of row numbers or a bit vector, whichever is shorter.  Slices hold different
rows, so the popcounts of a pair's bitmaps (the planes OR-merged, for documents; weighted by
2**p, for links) add up to its counts in the corpus.  The counts then go back along the
postings: each bitmap adds its pair's score to the rows it holds.

Texts that are null, empty, or that a tokenizer does not give back byte by byte have no tokens
and zeros.  Ids may repeat or be null, as rows are told apart by place; an empty table gives
an empty result; other columns are not read.  A text longer than PIECE is aligned in pieces cut
at a single space between letters or digits, where tokens of both sides begin.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import slices, stored, table_batch, whole_text
from tickloom.llm.tokens import RunEncoder

PIECE = 1 << 16
#: Rows of a slice, so that row numbers in it take two bytes.
ROWS = 1 << 16
_CUT = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")

_MADE = pa.schema(
    [
        ("slice", pa.int64()),
        # One row per document ...
        ("row", pa.int32()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        # ... and one per pair of the slice.
        ("a", pa.int32()),
        ("b", pa.int32()),
        ("rows", pa.int32()),
        ("planes", pa.list_(pa.binary())),
    ]
)
_MADE_DDL = (
    "slice long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " a int, b int, rows int, planes array<binary>"
)


# --- the two tokenizers -------------------------------------------------------------


def _byte_of_letter() -> dict[str, int]:
    """The printable letter a byte-level vocabulary writes for each byte: bytes that print stand
    for themselves, the others take the code points from 256 on, in order."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class SideA:
    """A byte-level file; special tokens' names inside texts are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.runs = RunEncoder(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        names, letters = self.runs.library.get_vocab(with_added_tokens=True), _byte_of_letter()
        special = set(self.runs.special)
        self.bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes[i] = name.encode() if name in special else bytes(letters[c] for c in name)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        apart = {i for i, t in enumerate(texts) if any(s in t for s in self.runs.special)}
        rest = iter(self.runs.encode([t for i, t in enumerate(texts) if i not in apart]))
        return [
            np.array(self.plain.encode(t, add_special_tokens=False).ids, np.uint32) if i in apart else next(rest)
            for i, t in enumerate(texts)
        ]


class SideB:
    """A sentencepiece file; it adds the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.library.encode(texts, num_threads=1)]


class _Ids:
    """Decimal ids with each of the separators, as fixed-width cells for one look-up."""

    SEPARATORS = (b",", b"|", b";", b"")

    def __init__(self, count: int):
        self.count = count
        cells = [str(i).encode() + s for s in self.SEPARATORS for i in range(count)]
        self.cells = np.array(cells)
        self.lengths = np.array([len(c) for c in cells], np.int64)


class Aligner:
    """Both tokenizers of one Python worker."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = SideA(a_path), SideB(b_path)
        self.a_sizes = np.array([len(x) for x in self.a.bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b.bytes], np.int64)
        self.ids = _Ids(max(len(self.a.bytes), len(self.b.bytes)))

    def pieces(self, text: str, size: int) -> list[str]:
        out, start = [], 0
        while len(text) - start > size:
            cut = _CUT.search(text, start + size)
            if cut is None:
                break
            out.append(text[start : cut.start()])
            start = cut.end()
        return [*out, text[start:]]

    def align(self, texts: list[str], piece: int = PIECE) -> list[Aligned | None]:
        """Per text its alignment, or None without tokens."""
        split = [self.pieces(t, piece) if t else [] for t in texts]
        flat = [p for pieces in split for p in pieces]
        a_ids, b_ids = self.a.encode([" " + p for p in flat]), self.b.encode(flat)
        whole = []
        for text, a, b in zip(flat, a_ids, b_ids):
            want = (" " + text).encode()
            whole.append(_joined(self.a.bytes, a) == want and _joined(self.b.bytes, b) == want)
        out, at = [], 0
        for pieces in split:
            span = range(at, at + len(pieces))
            at += len(pieces)
            if not pieces or not all(whole[i] for i in span):
                out.append(None)
            else:
                out.append(Aligned(self, np.concatenate([a_ids[i] for i in span]), np.concatenate([b_ids[i] for i in span])))
        return out


def _joined(table: list[bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


class Aligned:
    """Links and groups of one text."""

    def __init__(self, made: Aligner, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        a_ends, b_ends = np.cumsum(made.a_sizes[self.a]), np.cumsum(made.b_sizes[self.b])
        ends = np.zeros((2, int(a_ends[-1]) + 1), bool)
        ends[0, a_ends] = True
        ends[1, b_ends] = True
        segments = np.flatnonzero(ends[0] | ends[1])
        both = np.flatnonzero(ends[0] & ends[1])
        self.n_links, self.n_groups = len(segments), len(both)
        self.pairs = self.a[np.searchsorted(a_ends, segments)] << 32 | self.b[np.searchsorted(b_ends, segments)]
        self.a_group, self.b_group = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
        self._ids = made.ids

    def digest(self) -> str:
        """SHA-256 of the groups: ids of A, a bar, ids of B; groups apart by semicolons."""
        a_of, b_of = np.bincount(self.a_group, minlength=self.n_groups), np.bincount(self.b_group, minlength=self.n_groups)
        first = np.concatenate([[0], np.cumsum(a_of + b_of)[:-1]])
        items = np.empty(len(self.a) + len(self.b), np.int64)
        a_at = first[self.a_group] + np.arange(len(self.a)) - (np.cumsum(a_of) - a_of)[self.a_group]
        b_at = (first + a_of)[self.b_group] + np.arange(len(self.b)) - (np.cumsum(b_of) - b_of)[self.b_group]
        items[a_at], items[b_at] = self.a, self.b
        n = self._ids.count
        items[first + a_of - 1] += n
        items[first + a_of + b_of - 1] += 2 * n
        items[-1] += n
        return hashlib.sha256(self._ids.cells[items].tobytes().replace(b"\0", b"")).hexdigest()


# --- bitmaps ------------------------------------------------------------------------


def vector_bytes(rows: int) -> int:
    return (rows + 7) // 8


def encode_planes(group: np.ndarray, row: np.ndarray, n_groups: int, rows: int) -> list[bytes]:
    """A compressed bitmap for each group; entries are ordered by group and row."""
    counts = np.bincount(group, minlength=n_groups)
    edges = np.concatenate([[0], np.cumsum(counts)])
    size = vector_bytes(rows)
    short = row.astype("<u2").tobytes()
    out = [short[2 * i : 2 * j] for i, j in zip(edges[:-1].tolist(), edges[1:].tolist())]
    dense = np.flatnonzero(2 * counts >= size)
    for part in np.array_split(dense, max(1, len(dense) * rows // (1 << 24))):
        bits = np.zeros((len(part), rows), bool)
        for i, g in enumerate(part):
            bits[i, row[edges[g] : edges[g + 1]]] = True
        packed = np.packbits(bits, axis=1, bitorder="little")
        for i, g in enumerate(part.tolist()):
            out[g] = packed[i].tobytes()
    return out


def decode_planes(planes: list[bytes], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Plane number and row of every entry."""
    size = vector_bytes(rows)
    lengths = np.array([len(p) for p in planes], np.int64)
    vectors = np.flatnonzero(lengths == size)
    arrays = np.flatnonzero(lengths != size)
    listed = np.frombuffer(b"".join(planes[i] for i in arrays), "<u2").astype(np.int64)
    owner = np.repeat(arrays, lengths[arrays] // 2)
    if len(vectors):
        bits = np.frombuffer(b"".join(planes[i] for i in vectors), np.uint8).reshape(len(vectors), size)
        at, row = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little", count=rows))
        owner, listed = np.concatenate([owner, vectors[at]]), np.concatenate([listed, row])
    return owner, listed


def popcounts(planes: list[list[bytes]], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (planes OR-merged) and links (planes weighted) of each posting."""
    documents, links = np.zeros(len(planes), np.int64), np.zeros(len(planes), np.int64)
    for i, (some, n) in enumerate(zip(planes, rows.tolist())):
        size, merged, listed = vector_bytes(n), 0, []
        for p, plane in enumerate(some):
            if len(plane) == size:
                vector = int.from_bytes(plane, "little")
                merged |= vector
                links[i] += vector.bit_count() << p
            else:
                links[i] += len(plane) // 2 << p
                if plane:
                    listed.append(plane)
        if merged:
            for row in {r for x in listed for r in np.frombuffer(x, "<u2").tolist()}:
                merged |= 1 << row
            documents[i] = merged.bit_count()
        elif len(listed) == 1:
            documents[i] = len(listed[0]) // 2
        elif listed:
            documents[i] = len(np.unique(np.frombuffer(b"".join(listed), "<u2")))
    return documents, links


# --- over the corpus ----------------------------------------------------------------

_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _posting_rows(aligned: list[Aligned | None], number: int) -> pa.RecordBatch | None:
    """The slice's postings: per pair the planes over its rows."""
    rows = len(aligned)
    held = [(i, x) for i, x in enumerate(aligned) if x is not None]
    if not held:
        return None
    row = np.repeat([i for i, _ in held], [x.n_links for _, x in held])
    pairs, pair = np.unique(np.concatenate([x.pairs for _, x in held]), return_inverse=True)
    entry, times = np.unique(pair * rows + row, return_counts=True)
    pair, row = entry // rows, entry % rows
    depth = int(times.max()).bit_length()
    made = []
    for p in range(depth):
        has = times >> p & 1 == 1
        made.append(encode_planes(pair[has], row[has], len(pairs), rows))
    highest = np.zeros(len(pairs), np.int64)
    np.maximum.at(highest, pair, times)
    planes = [[made[p][i] for p in range(h.bit_length())] for i, h in enumerate(highest.tolist())]
    return _batch(len(pairs), slice=np.full(len(pairs), number), a=pairs >> 32, b=pairs & 0xFFFFFFFF,
                  rows=np.full(len(pairs), rows), planes=planes)


def _batch(n: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _MADE]
    return pa.RecordBatch.from_arrays(arrays, schema=_MADE)


def align_rows(docs: DataFrame, a_path: str, b_path: str, piece: int = PIECE, slice_rows: int = ROWS) -> DataFrame:
    """Rows of two kinds: documents with what they show by themselves (``row`` set), and
    postings (``planes`` set).  Store the result; slices are numbered by the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for whole in slices(batches):
            for start in range(0, whole.num_rows, slice_rows):
                batch = whole.slice(start, slice_rows)
                aligned = made.align(batch["text"].to_pylist(), piece)
                got = [(len(x.a), len(x.b), x.n_groups, x.n_links, x.digest()) if x else (0, 0, 0, 0, "") for x in aligned]
                columns = dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), zip(*got)))
                n = len(aligned)
                yield _batch(n, slice=np.full(n, number), row=np.arange(n), doc_id=batch["doc_id"], **columns)
                postings = _posting_rows(aligned, number)
                if postings is not None:
                    yield postings
                number += 1

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, _MADE_DDL)


_COUNTED = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n_docs", pa.int64()), ("n_links", pa.int64())])
_SCORED = pa.schema([("slice", pa.int64()), ("row", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def pair_scores(postings: DataFrame) -> DataFrame:
    """Per id pair its documents and links in the corpus, and whether no other pair of its B
    id has more links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents, links = popcounts(batch["planes"].to_pylist(), batch["rows"].to_numpy())
            yield table_batch(_COUNTED, a=batch["a"], b=batch["b"], n_docs=documents, n_links=links)

    counted = postings.select("a", "b", "rows", "planes").mapInArrow(run, "a int, b int, n_docs long, n_links long")
    pairs = counted.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    # As many rows meet here as A has ids.
    best = F.max("n_links").over(Window.partitionBy("b"))
    return pairs.withColumn("is_best", F.col("n_links") == best)


def _scores_of_rows(scored: DataFrame) -> DataFrame:
    """Postings with their pair's score, summed per row of the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, best, total = None, None, None

        def out() -> pa.RecordBatch:
            row = np.arange(len(best))
            return table_batch(_SCORED, slice=np.full(len(row), number), row=row, n_best=best, count_sum=total)

        for batch in batches:
            of = batch["slice"].to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                part, rows = batch.slice(start, end - start), batch["rows"][start].as_py()
                if of[start] != number:
                    if number is not None:
                        yield out()
                    number, best, total = int(of[start]), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
                planes = part["planes"]
                sizes = planes.value_lengths().to_numpy()
                owner, row = decode_planes(planes.flatten().to_pylist(), rows)
                power = np.arange(len(sizes.repeat(sizes))) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                times = np.int64(1) << power[owner]
                posting = np.repeat(np.arange(len(sizes)), sizes)[owner]
                np.add.at(total, row, times * part["n_links"].to_numpy()[posting])
                np.add.at(best, row, times * np.array(part["is_best"], dtype=np.int64)[posting])
        if number is not None:
            yield out()

    # A slice is bounded, whatever pairs are frequent.
    placed = scored.repartition("slice").sortWithinPartitions("slice")
    return placed.mapInArrow(run, "slice long, row int, n_best long, count_sum long")


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, piece: int = PIECE, slice_rows: int = ROWS
) -> DataFrame:
    """Per document its tokens, groups and links, and how common its links are."""
    made = stored(align_rows(docs, a_path, b_path, piece, slice_rows), "alignment")
    postings = made.where("planes IS NOT NULL").select("slice", "a", "b", "rows", "planes")
    # The join with the scores splits frequent pairs by AQE; few pairs are broadcast by it.
    scored = postings.join(pair_scores(postings), ["a", "b"]).select("slice", "rows", "planes", "n_links", "is_best")
    sums = _scores_of_rows(scored)
    rows = made.where("planes IS NULL").drop("a", "b", "rows", "planes")
    joined = rows.join(sums, ["slice", "row"], "left")
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *filled, "groups_sha256")
