"""MinHash fingerprints of whole texts.

A text's shingles are its runs of five words (all words, if there are fewer; words are split
at white space and lower-cased).  A fingerprint holds, for each of PERMUTATIONS functions
h(x) = (a * x + b) mod 2**64 from the multiply-shift universal family, the upper 32 bits of
the least h over the shingles; the share of equal values estimates the Jaccard likeness.
Texts without words share the fingerprint of all ones, and are alike 1.

``similar_documents`` joins bands of the signatures in Spark and links texts whose exact
Jaccard likeness reaches the threshold.  Null texts count as empty; repeated rows keep their
own rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import slices, table_batch, whole_text
from tickloom.llm.linking import fold, near_classes
from tickloom.llm.linking import likeness as weighted_likeness

SHINGLE_WORDS = 5
PERMUTATIONS = 128
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
_STEP = 1024  # shingles worked on at a time: the products then stay in the processor's cache

def _mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, for texts of growing length."""

    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    letters = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

    def __init__(self, length: int):
        self.up, self.down = (
            np.concatenate([np.ones(1, np.uint64), np.full(length, x, np.uint64)]).cumprod()
            for x in (self.base, self.inverse)
        )


_powers = _Powers(1 << 16)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word: the polynomial of its bytes, from running sums over the
    whole text, mixed."""
    global _powers
    data = np.frombuffer(" ".join(text.lower().split()).encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    if len(data) >= len(_powers.up):
        _powers = _Powers(2 * len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_powers.letters[data] * _powers.up[: len(data)])])
    spaces = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(data)]])
    return _mixed((sums[ends] - sums[starts]) * _powers.down[starts])


def shingle_hashes(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The hash of each run of ``size`` words, in order; of all words if there are fewer."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - size + 1 + i]
    return _mixed(total + np.uint64(size))


def permutations(count: int = PERMUTATIONS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, count, dtype=np.uint64)[:, None]


def least(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each permutation, as 64 bits; all ones over no shingles."""
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    room = np.empty((len(a), min(_STEP, len(shingles))), np.uint64)
    for at in range(0, len(shingles), _STEP):
        part = shingles[at : at + _STEP]
        values = room[:, : len(part)]
        np.multiply(a, part, out=values)
        np.add(values, b, out=values)
        np.minimum(out, values.min(axis=1), out=out)
    return out


def signature(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(32)).astype(np.uint32)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    return float((one == other).mean())


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the start of another."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def next_first(docs: DataFrame) -> DataFrame:
    """The documents dealt into ranges of descending id, with the first document of each
    range also at the end of the range before (``lent``), and that of the first range at
    the end of the last: ``bucket``, ``doc_id``, ``text``, ``lent``.

    The ranges come from approximate quantiles of the ids, a few numbers per task.  Null ids
    come last; ties are ordered by text.
    """
    spark = docs.sparkSession
    n = 3 * max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text().alias("text"))
    shares = [i / n for i in range(1, n)]
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 1000 * n).alias("cuts")).first()[0]
    cuts = sorted(set(cuts or []), reverse=True)
    if cuts:
        # The number of cuts at or above the id: 0 for the largest ids.
        where = F.array_size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c >= F.col("doc_id")))
        bucket = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(where)
    else:
        bucket = F.lit(0)
    placed = rows.withColumn("bucket", bucket.cast("int"))
    firsts = placed.groupBy("bucket").agg(F.max("doc_id").alias("first_id")).collect()  # one row per range
    if not firsts:
        return placed.withColumn("lent", F.lit(False))
    full = sorted(r.bucket for r in firsts)
    before = {b: full[i - 1] for i, b in enumerate(full)}  # the last range comes before the first
    ids = F.create_map(*(F.lit(x) for r in firsts for x in (r.bucket, r.first_id)))
    to = F.create_map(*(F.lit(x) for b, p in before.items() for x in (b, p)))
    own = F.struct(F.col("bucket"), F.lit(False).alias("lent"))
    lent = F.struct(to[F.col("bucket")].alias("bucket"), F.lit(True).alias("lent"))
    leads = ids[F.col("bucket")].eqNullSafe(F.col("doc_id"))
    places = F.when(leads, F.array(own, lent)).otherwise(F.array(own))
    return placed.select("doc_id", "text", F.explode(places).alias("place")).select("place.*", "doc_id", "text")


def fingerprint_documents(docs: DataFrame, count: int = PERMUTATIONS) -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and the likeness of the
    first to the second and to the next document's (descending id; after the last, the first)."""
    n = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(count)
        held: _Seen | None = None
        held_bucket, lent_to = None, None
        for batch in slices(batches):
            out: dict[str, list] = {f.name: [] for f in _OUT}
            columns = (batch[c].to_pylist() for c in ("bucket", "lent", "doc_id", "text"))
            for bucket, lent, doc, text in zip(*columns):
                if lent and lent_to == bucket:
                    continue  # ties of the first id: one of them is enough
                row = _Seen(doc, text, a, b)
                if held is not None and held_bucket == bucket:
                    _describe(out, held, row, a, b)
                held, held_bucket = None if lent else row, bucket
                lent_to = bucket if lent else lent_to
            yield table_batch(_OUT, **out)

    dealt = next_first(docs).repartition(n, "bucket")
    order = ("bucket", "lent", F.desc_nulls_last("doc_id"), "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    return dealt.sortWithinPartitions(*order).mapInArrow(run, schema + "near_edited double, near_next double")


class _Seen:
    """A document with its signature, and that of the shingles an edit of its end leaves."""

    def __init__(self, doc_id: int | None, text: str, a: np.ndarray, b: np.ndarray):
        self.doc_id, self.text, self.shingles = doc_id, text, shingle_hashes(text)
        kept = len(text[: len(text) - len(text) // 3].split()) - 1  # the last word may change
        self.safe = min(max(0, kept - SHINGLE_WORDS + 1), len(self.shingles))
        self.head = least(self.shingles[: self.safe], a, b)
        self.own = signature(np.minimum(self.head, least(self.shingles[self.safe :], a, b)))


def _describe(out: dict[str, list], row: _Seen, following: _Seen, a: np.ndarray, b: np.ndarray) -> None:
    changed = edited(row.text, following.text)
    other, n = shingle_hashes(changed), row.safe
    if np.array_equal(other[:n], row.shingles[:n]):
        new = signature(np.minimum(row.head, least(other[n:], a, b)))
    else:
        new = signature(least(other, a, b))
    out["doc_id"].append(row.doc_id)
    out["n_chars"].append(len(row.text))
    out["edited_sha256"].append(hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest())
    out["fingerprint"].append(row.own.astype(">u4").tobytes().hex())
    out["edited_fingerprint"].append(new.astype(">u4").tobytes().hex())
    out["near_edited"].append(likeness(row.own, new))
    out["near_next"].append(likeness(row.own, following.own))


def shingle_set(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles, each of weight 1; texts without words share one element."""
    hashes = np.unique(shingle_hashes(text))
    hashes = hashes if len(hashes) else np.zeros(1, np.uint64)
    return hashes, np.ones(len(hashes))


def jaccard(one: str, other: str) -> float:
    """Exact likeness of two texts' shingle sets; 1 for two texts without words."""
    return weighted_likeness(shingle_set(one), shingle_set(other))


def band_keys(text: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One key per band of BAND_ROWS signature values."""
    values = signature(least(shingle_hashes(text), a, b)).astype(np.uint64).reshape(-1, BAND_ROWS)
    return fold(values)


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``class_id`` and ``class_size``: documents chained by a Jaccard likeness of
    the threshold or more, found by joining signature bands."""
    a, b = permutations(BANDS * BAND_ROWS)
    return near_classes(docs, lambda text: band_keys(text, a, b), shingle_set, threshold)
