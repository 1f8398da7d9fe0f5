"""Line dedup on content-defined chunks of lines.

Words are the units, and where a line ends counts: a rolling hash runs over each CHUNK_WORDS
words in a row, and a chunk starts where it is the least of those in some LEAST_WORDS words.
So the same passage is cut alike wherever it stands, an insertion shifts only the chunks it
falls in, and any LEAST_WORDS words in a row hold at least one whole chunk.

A chunk is repeated if its hash occurs more than once in the whole corpus.  Each later
occurrence (by document id, then place) is extended to both sides as far as its bytes equal
those around the chunk's first occurrence, by as many words as a run of LEAST_WORDS can reach
beyond the chunk.  Where LEAST_WORDS words or more are equal, they are removed; shorter
repeats, such as single common lines, stay; where a text repeats itself without a gap (one word
over and over), the first LEAST_WORDS words stay.  Equal hashes of different bytes thus remove nothing.
A run is only looked for around the first occurrence of its chunks: where that copy was edited
close to a chunk, and no chunk covers the edit, or begins or ends there, a few words may stay.

Three passes over the texts: one counts hashes, one finds the occurrences of the repeated
ones, one removes.  Between the first two stands a bitmap of FILTER_BITS bits (16 MB whatever
the corpus) that keeps most chunks that occur once out of the second shuffle; those it lets
through are told apart exactly.  Occurrences meet the first one in a shuffle by hash; where a hash
is frequent, the first one is sent to them.  Another keeps the text around later occurrences out.  Where an
occurrence and the first one have the same neighbour, the neighbour brings the text beyond it.
A third one holds the documents with a later occurrence; only those are shuffled with their
texts, the others pass.  A full bitmap lets everything through, which costs time, not rows.

Null texts count as empty and become empty; a text nothing is removed from is unchanged, one
that is all repeats becomes empty, lines that lose all words go; rows of equal id and text are
treated alike; null ids come first; an empty table stays empty; other columns are kept, but
for columns named like the two that are added, which those replace.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tickloom.llm.common import slices, stored, whole_text

LEAST_WORDS = 40
FILTER_BITS = 1 << 27
#: Bytes of text hashed at a time: arrays with eight bytes for each are still in reach of a cache.
HASHED = 500_000

_BASE = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93
_BREAK = 0xA0761D6478BD642F
_LETTERS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_BLANK = b"\t\n\v\f\r "
_SPACE = np.zeros(256, bool)
_SPACE[list(_BLANK)] = True
#: Chunks of one hash in a row (one word over and over) start this many words apart.
_THIN = 12
#: A hash is frequent if it has this many occurrences and one in FREQUENT_PART of all.
FREQUENT = 10_000
FREQUENT_PART = 256


def chunk_words(least: int) -> int:
    return max(1, 2 * least // 5)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(31)
    x *= np.uint64(_MIX)
    return x ^ x >> np.uint64(29)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, kept for the longest text yet."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, length: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < length:
            both = (np.full(length, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
            cls.up, cls.down = (np.cumprod(x) for x in both)
        return cls.up[:length], cls.down[:length]


class Words:
    """The words of some texts, one after another, as places in their joined UTF-8 bytes."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8) if held is not None and len(held) else np.zeros(0, np.uint8)
        self.data = data[edges[0] : edges[-1]]
        self.edges = edges - edges[0]
        solid = ~_SPACE[self.data]
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = self.edges[(self.edges > 0) & (self.edges < len(solid))]
        first[inner] = solid[inner]  # a text starts and ends its own words
        last[inner - 1] = solid[inner - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        #: The word each text starts with, and in the end the number of words.
        self.begin = np.searchsorted(self.starts, self.edges)
        self.text = np.repeat(np.arange(len(self.edges) - 1), np.diff(self.begin))

    @cached_property
    def plain(self) -> tuple[bytes, list[int], list[int]]:
        """Bytes, starts and ends, as Python reads them fastest one by one."""
        return self.data.tobytes(), self.starts.tolist(), self.ends.tolist()

    def hashes(self) -> np.ndarray:
        """Of each word: the polynomial of its bytes, from running sums, mixed."""
        up, down = _Powers.of(len(self.data) + 1)
        terms, sums = _LETTERS[self.data], np.zeros(len(up), np.uint64)
        terms *= up[:-1]
        np.cumsum(terms, out=sums[1:])
        return _mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def breaks(self) -> np.ndarray:
        """Whether the word is the first of a line or text."""
        out = np.zeros(len(self.starts) + 1, bool)
        out[np.searchsorted(self.starts, np.flatnonzero(self.data == 10))] = True
        out[self.begin] = True
        return out[:-1]


def run_hashes(own: np.ndarray, breaks: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` words in a row, from the words' hashes and where lines start."""
    if len(own) < size:
        return np.zeros(0, np.uint64)
    mark = breaks.astype(np.uint64) * np.uint64(_BREAK)
    up, down = _Powers.of(len(own))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((own + mark) * up)])
    n = len(own) - size + 1
    return _mixed((sums[size:] - sums[:n]) * down[:n] - mark[:n])


def _over(of: np.ufunc, values: np.ndarray, size: int) -> np.ndarray:
    """The least or greatest of each ``size`` values in a row."""
    step = 1
    while 2 * step <= size:
        values = of(values[:-step], values[step:])
        step *= 2
    rest = size - step
    return of(values[:-rest], values[rest:]) if rest else values


def chunk_places(words: Words, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The words that chunks start with, in order, and the chunks' hashes."""
    size = chunk_words(least)
    if len(words.starts) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    short = run_hashes(words.hashes(), words.breaks(), size)
    span = least - size + 1
    low = _over(np.minimum, short, span)
    low[words.text[: len(low)] != words.text[least - 1 :]] = 0  # a run over two texts is none
    room = np.zeros(span - 1, np.uint64)
    chosen = _over(np.maximum, np.concatenate([room, low, room]), span) == short
    chosen &= short > 0
    place = np.arange(len(short)) - words.begin[words.text[: len(short)]]
    chosen[1:] &= ~(chosen[:-1] & (short[1:] == short[:-1])) | (place[1:] % _THIN == 0)
    at = np.flatnonzero(chosen)
    return at, short[at].view(np.int64)


def equal_words(words: Words, at: int, chunk: bytes, before: bytes, reach: int) -> tuple[int, int]:
    """The words around word ``at`` (of a single text) that equal, byte by byte, the words of
    ``chunk``, which starts there, and of ``before``, which ends there: first, after last."""
    data, starts, ends = words.plain
    start, top = starts[at], min(at + reach, len(starts))
    same = _prefix(data[start : ends[top - 1]], chunk)
    stop = bisect_right(ends, start + same, at, top)
    if stop > at and ends[stop - 1] - start == same < len(chunk) and chunk[same] not in _BLANK:
        stop -= 1
    bottom = max(at - reach, 0)
    same = _prefix(data[starts[bottom] : start][::-1], before[::-1])
    first = bisect_left(starts, start - same, bottom, at)
    if first < at and start - starts[first] == same < len(before) and before[-same - 1] not in _BLANK:
        first += 1
    return first, stop


def _prefix(one: bytes, other: bytes) -> int:
    """Bytes that both start with."""
    n = min(len(one), len(other))
    if one[:n] == other[:n]:
        return n
    a, b = np.frombuffer(one, np.uint8, n), np.frombuffer(other, np.uint8, n)
    return int((a != b).argmax())


def without(words: Words, gone: np.ndarray) -> str:
    """The (single) text without the words marked; lines that lose all words go."""
    data, starts, ends = words.data.tobytes(), words.starts, words.ends
    turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    out, done = [], 0
    for i, j in zip(turns[::2].tolist(), turns[1::2].tolist()):
        opens = i == 0 or b"\n" in data[ends[i - 1] : starts[i]]
        closes = j == len(starts) or b"\n" in data[ends[j - 1] : starts[j]]
        joint = b""
        if opens and closes:
            start, stop = data.rfind(b"\n", 0, starts[i]) + 1, data.find(b"\n", ends[j - 1]) + 1
            if not stop:
                start, stop = max(start - 1, done), len(data)
        elif opens:
            start, stop = starts[i], starts[j]
        elif closes:
            start, stop = ends[i - 1], ends[j - 1]
        elif b"\n" in data[starts[i] : starts[j]]:
            start, stop, joint = ends[i - 1], starts[j], b"\n"
        else:
            start, stop = starts[i], starts[j]
        out += [data[done:start], joint]
        done = stop
    left = b"".join([*out, data[done:]])
    return left.decode("utf-8") if left.strip() else ""


def _filter(repeated: DataFrame) -> np.ndarray:
    """A bitmap of the hashes; at most FILTER_BITS / 64 rows reach the driver."""
    at = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.expr("shiftleft(1L, CAST(hash & 63 AS INT))")
    rows = repeated.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = hashes.astype(np.int64) & np.int64(FILTER_BITS - 1)
    return bits[low >> 6] >> (low & 63) & 1 == 1


def _neighbours(at: np.ndarray, hashes: np.ndarray, text: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each chunk the words to the next one of its text, 0 if that starts more than ``reach``
    on, and a hash of both."""
    gap = np.zeros(len(at), np.int64)
    gap[:-1] = np.where((text[1:] == text[:-1]) & (at[1:] - at[:-1] <= reach), at[1:] - at[:-1], 0)
    both = hashes.view(np.uint64) * np.uint64(_BASE) + np.roll(hashes, -1).view(np.uint64)
    return gap, (_mixed(both + gap.astype(np.uint64)) >> np.uint64(33)).astype(np.int32)


_FOUND = (
    "doc_id long, key long, place int, hash long, next int, back int, "
    "core binary, after binary, near binary, far binary, mark int, next_mark int, back_mark int"
)


def _occurrences(rows: DataFrame, least: int) -> DataFrame:
    """``doc_id``, ``key``, ``place``, ``hash`` of the chunks whose hash may be repeated, with the
    text around: ``core`` reaches to the end of the next such chunk of the text, ``after`` beyond it,
    ``near`` back to the chunk before, ``far`` before that; ``next`` and ``back`` name those
    neighbours (null: none is close, so core and near are all).  ``mark`` tells the occurrence from
    others, ``next_mark`` and ``back_mark`` are those of the neighbours."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=HASHED):
            each, n = np.unique(chunk_places(Words(batch["text"]), least)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(n, pa.int64())], names=["hash", "n"])

    counted = rows.select("text").mapInArrow(count, "hash long, n long")
    repeated = counted.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash")
    shared = rows.sparkSession.sparkContext.broadcast(_filter(repeated))
    size = chunk_words(least)
    reach = least - size
    names = T.StructType.fromDDL(_FOUND).names

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=HASHED):
            words = Words(batch["text"])
            at, hashes = chunk_places(words, least)
            some = _held(shared.value, hashes)
            at, hashes = at[some], hashes[some]
            text = words.text[at]
            first, after = words.begin[text], words.begin[text + 1]
            gap, link = _neighbours(at, hashes, text, reach) if len(at) else (at, at.astype(np.int32))
            before = np.roll(gap, 1)
            thin = (gap > 0) & (hashes == np.roll(hashes, -1))
            stop = np.minimum(at + least + _THIN * (thin | np.roll(thin, 1)), after)
            start = np.maximum(at - reach, first)
            edges = [
                words.starts[start],
                words.starts[np.where(before > 0, at - before, start)],
                words.starts[at],
                words.ends[np.where(gap > 0, at + gap + size, stop) - 1],
                words.ends[stop - 1],
            ]
            data, edges = memoryview(words.data), [e.tolist() for e in edges]
            keys = batch["key"].to_numpy()[text].view(np.uint64)
            mark = _mixed(_mixed(keys + (at - first).astype(np.uint64)) + hashes.view(np.uint64))
            mark = (mark & np.uint64(FILTER_BITS - 1)).astype(np.int32)

            def part(i: int) -> pa.Array:
                return pa.array([bytes(data[a:b]) for a, b in zip(edges[i], edges[i + 1])], pa.binary())

            columns = [
                batch["doc_id"].take(pa.array(text)),
                batch["key"].take(pa.array(text)),
                pa.array(at - first, pa.int32()),
                pa.array(hashes, pa.int64()),
                pa.array(link, pa.int32(), mask=gap == 0),
                pa.array(np.roll(link, 1), pa.int32(), mask=before == 0),
                *(part(i) for i in (2, 3, 1, 0)),
                *(pa.array(np.roll(mark, i), pa.int32()) for i in (0, -1, 1)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return stored(rows.mapInArrow(find, _FOUND), "chunks")


def _places(found: DataFrame) -> DataFrame:
    """``first``: where each ``hash`` that is repeated occurs first; ``n``: how often it occurs."""
    own = F.struct("doc_id", "key", "place", "mark")
    least = found.groupBy("hash").agg(F.min(own).alias("first"), F.count("*").alias("n")).where("n > 1")
    return stored(least.select("hash", "first", "n"), "first-places")


def _frequent(places: DataFrame) -> list[int]:
    """The frequent hashes, FREQUENT_PART at most."""
    total = places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r[0] for r in places.where(F.col("n") >= max(FREQUENT, -(-total // FREQUENT_PART))).select("hash").collect()]


def _firsts(found: DataFrame, places: DataFrame) -> DataFrame:
    """The ``first`` occurrence of each ``hash``, with the text around.  A bitmap of those keeps the
    text of most others out of the shuffle; what it lets through loses to the first.  ``next`` and
    ``back`` stay where the neighbour is a first occurrence itself, so that whoever shares the
    chunk and the neighbour gets both from this text."""
    shared = found.sparkSession.sparkContext.broadcast(_filter(places.select(F.col("first.mark").alias("hash"))))
    names = found.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = shared.value
            for side in ("next", "back"):
                near = pa.array(_held(bits, batch[f"{side}_mark"].to_numpy()))
                linked = pc.if_else(near, batch[side], pa.scalar(None, pa.int32()))
                batch = batch.set_column(names.index(side), side, linked)
            yield batch.filter(pa.array(_held(bits, batch["mark"].to_numpy())))

    around = ["doc_id", "key", "place", "next", "back", "core", "after", "near", "far"]
    kept = found.mapInArrow(keep, _FOUND)
    return kept.groupBy("hash").agg(F.min(F.struct(*around)).alias("first"))


def _with_firsts(each: DataFrame, found: DataFrame, places: DataFrame) -> DataFrame:
    """``each`` occurrence with the first of its hash.  The occurrences of a frequent hash would all
    meet in one task; there the few first ones are sent to the occurrences instead."""
    frequent = _frequent(places)
    if not frequent:
        return each.join(_firsts(found, places), "hash")
    often = F.col("hash").isin(frequent)
    rest = each.where(~often).join(_firsts(found.where(~often), places), "hash")
    return rest.unionAll(each.where(often).join(F.broadcast(_firsts(found.where(often), places)), "hash"))


def removed_words(words: Words, key: int, hits: list[tuple[int, int, int, bytes, bytes]], least: int) -> np.ndarray:
    """Which words of a (single) text go: those in runs of ``least`` or more that equal the words
    around the first occurrences.  A hit: place, source, shift, chunk, before."""
    gone = np.zeros(len(words.starts), bool)
    size = chunk_words(least)
    runs: dict[tuple[int, int], tuple[int, int]] = {}

    def close(source: int, shift: int) -> None:
        a, b = runs.pop((source, shift))
        if b - a >= least:  # the first run of a text that repeats itself without a gap stays
            gone[a + max(0, least - shift if source == key else 0) : b] = True

    for place, source, shift, chunk, before in sorted(hits):
        if place >= len(gone):
            continue
        a, b = equal_words(words, place, chunk, before, least + _THIN)
        if b - place < size:
            continue
        with_ = (source, shift)
        if with_ in runs:
            if runs[with_][1] >= place + size:  # the run holds this chunk, so both are one
                a, b = min(a, runs[with_][0]), max(b, runs[with_][1])
            else:
                close(*with_)
        runs[with_] = (a, b)
    for with_ in list(runs):
        close(*with_)
    return gone


def _hit_rows(hits: pa.Array) -> Iterator[list[tuple[int, int, int, bytes, bytes]]]:
    """The hits of each row, none for null."""
    flat = hits.flatten()
    parts = [flat.field(i).to_pylist() for i in range(flat.type.num_fields)]
    ends = np.cumsum(hits.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
    for start, end in zip([0, *ends], ends):
        yield list(zip(*(p[start:end] for p in parts)))


def cleaned_rows(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``row`` (all columns but the text), ``text``, ``removed_chunks`` (runs of words) and
    ``removed_words`` of each document."""
    text = whole_text()
    id_ = docs["doc_id"].cast("long").alias("doc_id")
    key = F.xxhash64(id_, text).alias("key")
    found = _occurrences(docs.select(id_, key, text.alias("text")), least)
    places = _places(found)
    each = found.select("hash", "key", "place", "next", "back")  # the key is of the id and text
    itself = (F.col("key") == F.col("first.key")) & (F.col("place") == F.col("first.place"))
    later = _with_firsts(each, found, places).where(~itself)
    touched = each.select("hash", "key", "place").join(places.drop("n"), "hash").where(~itself)
    shared = docs.sparkSession.sparkContext.broadcast(_filter(touched.select(F.col("key").alias("hash"))))

    def unless(link: str, far: str) -> Column:
        """The text beyond a neighbour, but where both have the same one, which brings it itself."""
        return F.when(F.col(link) == F.col(f"first.{link}"), F.lit(b"")).otherwise(F.col(f"first.{far}"))

    # A set, as repeated rows share their key; a document's own chunks bound it.
    hit = F.struct(
        "place",
        F.col("first.key").alias("source"),
        (F.col("place") - F.col("first.place")).alias("shift"),
        F.concat("first.core", unless("next", "after")).alias("chunk"),
        F.concat(unless("back", "far"), "first.near").alias("before"),
    )
    hits = later.groupBy("key").agg(F.collect_set(hit).alias("hits"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, runs, counts = batch["text"].to_pylist(), [0] * batch.num_rows, [0] * batch.num_rows
            for i, (key, hits) in enumerate(zip(batch["key"].to_pylist(), _hit_rows(batch["hits"]))):
                if not hits:
                    continue
                words = Words(batch["text"].slice(i, 1))
                gone = removed_words(words, key, hits, least)
                if gone.any():
                    texts[i], counts[i] = without(words, gone), int(gone.sum())
                    runs[i] = int(gone[0]) + int((np.diff(gone.astype(np.int8)) == 1).sum())
            columns = [batch["row"], pa.array(texts, pa.string()), pa.array(runs, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "removed_chunks", "removed_words"])

    @arrow_udf("boolean")
    def may_repeat(keys: pa.Array) -> pa.Array:
        return pa.array(_held(shared.value, keys.to_numpy(zero_copy_only=False)))

    # The text travels once, so the row goes without it.
    rest = F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row")
    rows = docs.select(key, rest, text.alias("text"))
    whole = rows.where(may_repeat("key")).join(hits, "key", "left").select("row", "key", "text", "hits")
    added = ["removed_chunks", "removed_words"]
    schema = T.StructType([whole.schema["row"], whole.schema["text"], *(T.StructField(c, T.LongType()) for c in added)])
    unique = rows.where(~may_repeat("key")).select("row", "text", *(F.lit(0).cast("long").alias(c) for c in added))
    return whole.mapInArrow(remove, schema).unionAll(unique)


def remove_repeated_chunks(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """The documents with repeated passages removed from ``text``, and ``removed_chunks`` (runs
    of words) and ``removed_words``."""
    added = ["removed_chunks", "removed_words"]
    kept = [c for c in docs.columns if c.lower() not in added]
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in kept]
    return cleaned_rows(docs, least).select(*columns, *added)


def drop_repeated_passages(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """The documents with repeated passages removed from ``text``, their own columns alone;
    ``n_chars`` is brought up to date where the text changed."""
    columns = []
    for c in docs.columns:
        own = F.col(f"row.`{c}`")
        if c == "n_chars":
            own = F.when(F.col("removed_words") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(own)
        columns.append(F.col("text") if c == "text" else own.alias(c))
    return cleaned_rows(docs, least).select(*columns)
