"""Near-duplicates by DartMinHash: sparse weighted signatures from hashed darts.

A text is a weighted set: its five-word shingles, weighted by how often they occur (all words
are one shingle in shorter texts; words are split at white space and lower-cased; texts
without words are all alike).  Each unit of an element's weight is a strip that hashed darts
hit at the times of a Poisson process which depends on the strip alone.  A text throws the
darts that come before a limit into its own strips; each dart belongs to one of the signature's
coordinates, and the earliest dart of a coordinate is its value.  Two texts agree in a
coordinate with the probability of their weighted Jaccard likeness, and the work is in
proportion to the strips and the darts, not to their product with the coordinates.

Bands of four coordinates are joined, and each candidate pair's exact weighted Jaccard
likeness decides.  At likeness 0.8, 32 bands miss a pair with a probability of 5e-8.
Null texts count as empty; repeated rows share a class; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.fingerprints import shingle_hashes
from tickloom.llm.linking import fold, likeness, near_classes

COORDINATES = 128
BAND_ROWS = 4
THRESHOLD = 0.8

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their counts."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return np.zeros(1, np.uint64), np.ones(1)
    elements, counts = np.unique(hashes, return_counts=True)
    return elements, counts.astype(float)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> np.uint64(11)) + np.uint64(1)) * 2.0**-53


def _strips(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash and a height (up to 1) for each started unit of weight."""
    units = np.ceil(weights).astype(np.int64)
    if units.max() == 1 and (weights == 1).all():
        return _mix(elements + _GOLDEN), weights
    first = np.repeat(np.cumsum(units) - units, units)
    level = np.arange(len(first)) - first
    heights = np.minimum(1.0, np.repeat(weights, units) - level)
    return _mix(np.repeat(elements, units) + (level.astype(np.uint64) + np.uint64(1)) * _GOLDEN), heights


def darts(strips: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strip index, time and hash of every dart up to the limit."""
    with np.errstate(over="ignore"):
        names = _mix(strips)
        times = -np.log(_uniform(names))
        hit = np.flatnonzero(times <= limit)
        index, when, which = [hit], [times[hit]], [names[hit]]
        columns = int(limit + 3 * limit**0.5 + 2)
        step = np.uint64(1)
        while len(hit):
            steps = step + np.arange(columns, dtype=np.uint64)
            names = _mix(strips[hit][:, None] + steps * _GOLDEN)
            later = when[-1] if len(when) == 1 else last
            times = later[:, None] + np.cumsum(-np.log(_uniform(names)), axis=1)
            row, column = np.nonzero(times <= limit)
            index.append(hit[row])
            when.append(times[row, column])
            which.append(names[row, column])
            more = times[:, -1] <= limit
            last, hit, step = times[more, -1], hit[more], step + np.uint64(columns)
    return np.concatenate(index), np.concatenate(when), np.concatenate(which)


def signature(elements: np.ndarray, weights: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The hash of the earliest dart of each coordinate; weights are positive."""
    strips, heights = _strips(elements, weights)
    limit = coordinates * (np.log(coordinates) + 2.0) / heights.sum()
    while True:
        index, when, which = darts(strips, limit)
        with np.errstate(over="ignore"):
            place = _mix(which + np.uint64(1))
        if (heights < 1).any():
            inside = _uniform(_mix(place)) <= heights[index]
            when, which, place = when[inside], which[inside], place[inside]
        coordinate = (place % np.uint64(coordinates)).astype(np.int64)
        order = np.argsort(-when, kind="stable")
        out = np.zeros(coordinates, np.uint64)
        found = np.zeros(coordinates, bool)
        out[coordinate[order]] = which[order]  # the earliest is written last
        found[coordinate] = True
        if found.all():
            return out
        limit *= 2  # a coordinate without a dart: throw more


def weighted_jaccard(one: str, other: str) -> float:
    """Exact likeness of two texts."""
    return likeness(weighted_shingles(one), weighted_shingles(other))


def band_keys(text: str) -> np.ndarray:
    return fold(signature(*weighted_shingles(text)).reshape(-1, BAND_ROWS))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``class_id`` and ``class_size`` of every row."""
    return near_classes(docs, band_keys, weighted_shingles, threshold)


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The document of each class with the least id (all columns, one row of it); rows without
    an id stay."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    kept = near_duplicates(docs, threshold).where("doc_id = class_id").select("doc_id").distinct()
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row)
    named = rows.join(kept, "doc_id")
    return named.dropDuplicates(["doc_id"]).select("row.*").union(rows.where("doc_id IS NULL").select("row.*"))
