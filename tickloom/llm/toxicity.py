"""Toxicity by the nearest labelled examples, found by exact TF-IDF cosine.

Terms are words and the first 3 to 7 letters of words.  Those that mark the label among the
labelled examples (log-likelihood ratio) form the vocabulary; inverse document frequencies
are counted over all documents.  The examples' vectors go into an inverted index cut into
blocks of examples, with the largest weight of each term in each block.  A query adds up its
terms' block maxima, visits blocks from the highest bound, and stops when no bound exceeds
the k-th best cosine: the k nearest are exact.  Their votes, weighted by cosine and pulled
towards the rate of all examples, pass through a logistic curve fitted on the examples' own
left-out votes; the nearest examples are the evidence.

Bounds, all parameters: at most EXAMPLES labelled rows (those with the least hash) are
learned from, TERMS terms are kept.  Scores of documents without any of the terms come from
such examples' rate.  Null texts count as empty; labels of repeated or unknown documents are
used once each; without labels every score is 0; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import slices, stored, table_batch, whole_text

EXAMPLES = 16_384
TERMS = 1024
NEIGHBOURS = 15
BLOCK = 32
FOLDS = 5
#: Votes that the overall rate counts for, and the least documents of a term.
PRIOR = 1.0
LEAST_DOCUMENTS = 3

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = range(3, 8)


def terms_of(words: set[str]) -> set[str]:
    """The words, and their beginnings marked with a star."""
    return words | {w[:n] + "*" for w in words for n in _PREFIXES if len(w) > n}


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _examples(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``doc_id``, ``text``, ``toxic``: a bounded set of labelled documents, none held out."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    present = docs.select(docs["doc_id"].cast("long").alias("doc_id")).distinct()
    chosen = known.join(present, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    chosen = stored(chosen, "chosen")  # at most ``limit`` rows of two numbers: small enough to broadcast
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text().alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    return stored(found, "examples")


def marking_terms(examples: DataFrame, terms: int = TERMS) -> list[str]:
    """The terms that most mark the label, by log-likelihood ratio."""
    schema = pa.schema([("term", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                seen[1 - toxic].update(terms_of(set(_WORD.findall(text.lower()))))
                if sum(map(len, seen)) > 1_000_000:
                    yield from flush(*seen)
        yield from flush(*seen)

    def flush(pos: Counter, neg: Counter) -> Iterator[pa.RecordBatch]:
        names = list(pos | neg)
        yield table_batch(schema, term=names, pos=[pos[t] for t in names], neg=[neg[t] for t in names])
        pos.clear(), neg.clear()

    totals = examples.agg(F.sum("toxic"), F.count("*")).first()
    n_pos = float(totals[0] or 0)
    n_neg = float(totals[1]) - n_pos
    if not n_pos or not n_neg:
        return []
    counted = examples.select("text", "toxic").mapInArrow(run, "term string, pos long, neg long")
    counted = counted.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    rate = (F.col("pos") + F.col("neg")) / (n_pos + n_neg)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    gain = part(F.col("pos"), rate * n_pos) + part(F.col("neg"), rate * n_neg)
    gain += part(n_pos - F.col("pos"), (1 - rate) * n_pos) + part(n_neg - F.col("neg"), (1 - rate) * n_neg)
    marks = counted.where((F.col("pos") >= LEAST_DOCUMENTS) & (F.col("pos") / n_pos > 2 * F.col("neg") / n_neg))
    best = marks.select("term", gain.alias("gain")).where("gain > 6").orderBy(F.desc("gain"), "term").limit(terms)
    return [r.term for r in best.collect()]  # at most ``terms`` rows


def count_terms(docs: DataFrame, terms: list[str], *columns: str) -> DataFrame:
    """``columns`` and the vocabulary's terms in each text with their counts, as arrays."""
    number = {t: i for i, t in enumerate(terms)}
    fields = [(f.name, f.dataType.simpleString()) for f in docs.select(*columns).schema]
    text_schema = ", ".join(f"`{n}` {t}" for n, t in fields) + ", term array<int>, tf array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        none: tuple[int, ...] = ()
        for batch in slices(batches):
            index, count = [], []
            for text in batch["text"].to_pylist():
                found: Counter = Counter()
                for word, n in Counter(_WORD.findall(text.lower())).items():
                    hits = known.get(word)
                    if hits is None:
                        hits = tuple(number[t] for t in terms_of({word}) if t in number) or none
                        if len(known) > 500_000:
                            known.clear()
                        known[word] = hits
                    for i in hits:
                        found[i] += n
                index.append(sorted(found))
                count.append([found[i] for i in index[-1]])
            extra = [pa.array(index, pa.list_(pa.int32())), pa.array(count, pa.list_(pa.int32()))]
            kept = [batch[c] for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, *extra], names=[*columns, "term", "tf"])

    return docs.select(*columns, "text").mapInArrow(run, text_schema)


@dataclass
class BlockMaxIndex:
    """Unit vectors of the examples in blocks, and the largest weight of each term in each."""

    matrix: np.ndarray  # example x term, float32
    labels: np.ndarray
    ids: np.ndarray
    maxima: np.ndarray  # term x block

    @classmethod
    def build(cls, matrix: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> BlockMaxIndex:
        # Examples with the same heaviest terms share blocks, which makes the bounds tight.
        heavy = np.argsort(-matrix, axis=1, kind="stable")[:, :3] if matrix.size else np.zeros((len(matrix), 0), int)
        order = np.lexsort((ids, *heavy.T[::-1]))
        matrix, labels, ids = matrix[order], labels[order], ids[order]
        starts = np.arange(0, len(matrix), BLOCK)
        maxima = np.maximum.reduceat(matrix, starts, axis=0).T if len(matrix) else np.zeros((matrix.shape[1], 0))
        return cls(matrix, labels, ids, np.ascontiguousarray(maxima))

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, leave: int | None = None) -> list[tuple[float, int, int]]:
        """The k nearest as (cosine, row); ties to the smaller id.  ``leave``: a row not to use."""
        bounds = weight @ self.maxima[term]
        best: list[tuple[float, int, int]] = []
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or len(best) == k and bounds[block] + 1e-6 < -best[-1][0]:
                break
            start = int(block) * BLOCK
            cosines = self.matrix[start : start + BLOCK, term] @ weight
            rows = [
                (-round(float(c), 6), int(self.ids[start + j]), start + j)
                for j, c in enumerate(cosines)
                if c > 0 and start + j != leave
            ]
            best = sorted(best + rows)[:k]
        return [(-c, i, row) for c, i, row in best]


@dataclass
class Scorer:
    """What scoring a document needs; a few megabytes whatever the size of the corpus."""

    index: BlockMaxIndex
    idf: np.ndarray
    rate: float  # of toxic examples
    bare: float  # of those among examples without any term
    slope: float = 1.0
    level: float = 0.0
    k: int = NEIGHBOURS

    def vector(self, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(tf)) * self.idf[term]
        return (weight / np.linalg.norm(weight)).astype(np.float32)

    def vote(self, term: np.ndarray, tf: np.ndarray, leave: int | None = None) -> tuple[float, list[int]]:
        """The pulled share of toxic votes, as log odds, and the nearest examples' ids."""
        near = self.index.nearest(term, self.vector(term, tf), self.k, leave)
        votes = sum(c for c, _, _ in near)
        toxic = sum(c for c, _, row in near if self.index.labels[row])
        share = (toxic + PRIOR * self.rate) / (votes + PRIOR)
        return float(np.log(share / (1 - share))), [i for _, i, _ in near]

    def score(self, term: np.ndarray, tf: np.ndarray) -> tuple[float, list[int]]:
        if not len(term):
            return self.bare, []
        odds, near = self.vote(term, tf)
        return float(1 / (1 + np.exp(-(self.slope * odds + self.level)))), near


def _calibrate(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0.1) and level of a logistic curve, by Newton steps with a weak pull to (1, 0)."""
    w = np.array([1.0, 0.0])
    x = np.column_stack([odds, np.ones_like(odds)])
    pull = np.diag([0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T * (p * (1 - p)) @ x + pull, x.T @ (p - labels) + pull @ (w - [1.0, 0.0]))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.1, float(w[0])), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES, terms: int = TERMS) -> tuple[Scorer | None, DataFrame]:
    """The scorer, and the stored term counts of all documents (``row``, ``doc_id``, ``term``,
    ``tf``).  No scorer if the labels do not hold both classes."""
    examples = _examples(docs, labels, limit)
    vocabulary = marking_terms(examples, terms)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text().alias("text"))
    counted = stored(count_terms(rows, vocabulary, "doc_id"), "terms")
    totals = examples.agg(F.avg("toxic"), F.count("*")).first()
    if not totals[1]:
        return None, counted
    rate = float(totals[0])
    if not vocabulary:
        empty = BlockMaxIndex.build(np.zeros((0, 1), np.float32), np.zeros(0, int), np.zeros(0, int))
        return Scorer(empty, np.ones(1), min(max(rate, 1e-6), 1 - 1e-6), rate), counted
    seen = counted.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()
    total, df = counted.count(), np.zeros(len(vocabulary))
    for r in seen:  # at most one row per term of the vocabulary
        df[r.term] = r.n
    idf = np.log((1 + total) / (1 + df)) + 1
    # At most ``limit`` examples of a few numbers each.
    made = count_terms(examples, vocabulary, "doc_id", "toxic").orderBy("doc_id").collect()
    with_terms = [r for r in made if r.term]
    bare = [r.toxic for r in made if not r.term]
    matrix = np.zeros((len(with_terms), len(vocabulary)), np.float32)
    scorer = Scorer(None, idf, rate, (sum(bare) + rate) / (len(bare) + 1))
    for i, r in enumerate(with_terms):
        matrix[i, r.term] = scorer.vector(np.array(r.term), np.array(r.tf))
    scorer.index = BlockMaxIndex.build(
        matrix, np.array([r.toxic for r in with_terms]), np.array([r.doc_id for r in with_terms])
    )
    by_id = {int(d): i for i, d in enumerate(scorer.index.ids)}
    if with_terms:
        odds = [scorer.vote(np.array(r.term), np.array(r.tf), by_id[r.doc_id])[0] for r in with_terms]
        scorer.slope, scorer.level = _calibrate(np.array(odds), np.array([r.toxic for r in with_terms], float))
    return scorer, counted


def score_documents(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES, terms: int = TERMS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``evidence`` (ids of the nearest
    examples, nearest first) of every document."""
    scorer, counted = fit(docs, labels, limit, terms)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", pa.list_(pa.int64()))])
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, evidence = [], []
            for term, tf in zip(batch["term"].to_pylist(), batch["tf"].to_pylist()):
                score, near = model.score(np.array(term, int), np.array(tf)) if model else (0.0, [])
                scores.append(score)
                evidence.append(near)
            yield table_batch(schema, doc_id=batch["doc_id"].to_pylist(), score=scores, evidence=evidence)

    scored = counted.mapInArrow(run, "doc_id long, score double, evidence array<long>")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose id no toxic score rejects, with all columns; rows without an id stay."""
    rejected = score_documents(docs, labels).where("predicted = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row)
    return rows.join(rejected, "doc_id", "left_anti").select("row.*")
