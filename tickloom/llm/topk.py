"""Exact top-k by inner product with no-random-access aggregation (NRA).

The candidates' components form one sorted list per dimension.  A query reads every list in
order, from the large end where its own component is positive and from the small end where
it is negative.  What it has read bounds each candidate's score: unread components lie
between the list's far end (lower bound) and the place reached (upper bound).  Reading stops
when at most FEW candidates per query still have an upper bound at or above the k-th best
lower bound; the scores of those are then resolved.

Candidates and queries are dealt into blocks; each pair of blocks is one row of work, whose
lists are read for all its queries together, in rounds of a share of the list.  The best k
of every block are merged by an aggregation that keeps k rows per query and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored, table_batch

K = 20
#: Vectors of a candidate block and of a query block.
CANDIDATES, QUERIES = 4096, 512
#: Shares of the lists that are read by the end of each round.
ROUNDS = (0.25, 0.5, 0.75, 1.0)
#: Candidates of a query whose scores are resolved without reading on.
FEW = 200


def quantised(column: Column) -> Column:
    """floor(64 * x) of each component as long; null if any component is null or not finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(column, lambda x: F.floor(x.cast("double") * 64)))


class Lists:
    """The sorted lists of a block: per dimension, candidates by component."""

    def __init__(self, values: np.ndarray, kind: type):
        self.values = values.astype(kind)
        self.order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, self.order, axis=0)

    def bounds(self, depth: int, largest_first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Each component after reading ``depth`` entries of its list: at least, at most."""
        n, dims = self.values.shape
        if largest_first:
            read, reached, end = self.order[n - depth :], self.sorted[n - depth], self.sorted[0]
        else:
            read, reached, end = self.order[:depth], self.sorted[depth - 1], self.sorted[n - 1]
        columns = np.arange(dims)
        near, far = np.tile(reached, (n, 1)), np.tile(end, (n, 1))
        near[read, columns] = far[read, columns] = self.values[read, columns]
        return (far, near) if largest_first else (near, far)


def nra(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int = K
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best candidates other than itself; ties to
    the smaller id.  ``queries`` and ``values`` are integers."""
    top = max(1, int(np.abs(queries).max(initial=0))) * max(1, int(np.abs(values).max(initial=0))) * values.shape[1]
    kind = np.float32 if top < 1 << 24 else np.float64
    slack = 0.0 if top < 1 << 53 else top * 2.0**-40  # sums of larger numbers are rounded
    whole = np.int64 if top < 1 << 62 else object
    lists, n = Lists(values, kind), len(values)
    up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    own = query_ids[:, None] == ids[None, :]
    waiting = np.arange(len(queries))
    found: list[tuple[int, np.ndarray]] = []
    for share in ROUNDS:
        depth = max(1, int(np.ceil(share * n)))
        (low_up, high_up), (low_down, high_down) = lists.bounds(depth, True), lists.bounds(depth, False)
        # A negative component of a query makes the largest value its worst.
        lower = up[waiting] @ low_up.T + down[waiting] @ high_down.T
        upper = up[waiting] @ high_up.T + down[waiting] @ low_down.T
        lower[own[waiting]] = upper[own[waiting]] = -np.inf
        if n > k:
            worst = np.partition(lower, n - k, axis=1)[:, n - k]
        else:
            worst = np.full(len(waiting), -np.inf)
        able = (upper >= worst[:, None] - slack) & ~own[waiting]
        done = (able.sum(axis=1) <= FEW) | (depth == n)
        found += [(int(q), np.flatnonzero(able[i])) for i, q in enumerate(waiting) if done[i]]
        waiting = waiting[~done]
        if not len(waiting):
            break
    out = []
    for q, near in found:
        scores = values[near].astype(whole) @ queries[q].astype(whole)
        best = sorted(zip((-scores).tolist(), ids[near].tolist()))[:k]
        out += [(int(query_ids[q]), c, -s) for s, c in best]
    columns = list(zip(*out)) or [(), (), ()]
    return tuple(columns)


_BLOCK = pa.schema(
    [("dims", pa.int32()), ("block", pa.int32()), ("ids", pa.list_(pa.int64())), ("flat", pa.list_(pa.int64()))]
)
_SCORES = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``dims``, ``block``, ``ids``, ``flat``: vectors of one dimension, about ``size`` a block.
    Rows are dealt by a hash of id and vector, so blocks stay near that size."""
    counts = rows.groupBy("dims").agg(F.ceil(F.count("*") / size).alias("blocks"))  # a row per dimension
    # A row's number in its task tells repeated rows apart.
    place = F.pmod(F.xxhash64("vec_id", "v", F.monotonically_increasing_id()), F.col("blocks")).cast("int")
    dealt = rows.join(counts, "dims").withColumn("block", place)
    gathered = dealt.groupBy("dims", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    ids = F.transform("rows", lambda r: r.vec_id).alias("ids")
    return gathered.select("dims", "block", ids, F.flatten(F.transform("rows", lambda r: r.v)).alias("flat"))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k best among the other ids.

    ``vectors`` has ``vec_id`` and ``v`` (longs).  Rows with a null id or vector take no part.
    A query meets vectors of its own dimension; a repeated query id counts once (its first
    vector in order), a repeated candidate once per different vector's best score.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").alias("v"), is_query.alias("q"))
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL").distinct().withColumn("dims", F.size("v"))
    rows = stored(rows, "vectors")
    asked = rows.where("q").groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dims", F.size("v"))
    candidates = stored(_blocks(rows.select("dims", "vec_id", "v"), CANDIDATES), "candidates")
    questions = _blocks(asked.select("dims", "vec_id", "v"), QUERIES)
    # Each block of queries is sent to each block of candidates, so a task's work is one
    # candidate block and there are as many tasks as such blocks.
    last = candidates.groupBy("dims").agg(F.max("block").alias("last"))
    sent = questions.join(last, "dims").select(
        "dims", F.explode(F.sequence(F.lit(0), "last")).alias("block"), F.col("ids").alias("query_ids"), F.col("flat").alias("query_flat")
    )
    work = sent.join(candidates, ["dims", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dims = batch["dims"][i].as_py()
                qid, qv, cid, cv = (
                    batch[c][i].values.to_numpy(zero_copy_only=False) for c in ("query_ids", "query_flat", "ids", "flat")
                )
                if not dims:
                    qv, cv, dims = np.zeros(len(qid), np.int64), np.zeros(len(cid), np.int64), 1
                got = nra(qid, qv.reshape(-1, dims), cid, cv.reshape(-1, dims), k)
                yield table_batch(_SCORES, query_id=got[0], vec_id=got[1], score=got[2])

    scored = work.mapInArrow(run, "query_id long, vec_id long, score long")
    best = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
