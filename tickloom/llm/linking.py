"""From band keys to classes of near-equal texts.

Equal texts are one node.  Nodes that share a band key form a bucket.  A bucket's members
are compared with its first member, which joins most of them into one component; only
buckets that still hold several components are looked at again, and there only pairs of
different components.  Up to SMALL members those pairs are rows.  Larger buckets are dealt
into blocks, and a task takes a pair of blocks: it counts what each member outside the
blocks' largest component shares with all others through an inverted index of their
shingles, and returns one link per component that it finds.  So the pairs of a large group
of copies are never rows, no task holds more than two blocks, and no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import slices, stored, table_batch, whole_text

#: Members of a bucket whose pairs are rows, and members of a block of a larger bucket.
SMALL = 16
BLOCK = 1024
#: Distinct elements of a text with their weights.
Bag = tuple[np.ndarray, np.ndarray]


def likeness(one: Bag, other: Bag) -> float:
    """Weighted Jaccard likeness: the sum of least weights over the sum of greatest."""
    (x, wx), (y, wy) = one, other
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = np.minimum(wx[i], wy[j]).sum()
    return float(least / (wx.sum() + wy.sum() - least))


def links_between(
    nodes: np.ndarray, roots: np.ndarray, bags: list[Bag], threshold: float
) -> list[tuple[int, int]]:
    """Links (a < b) between components: for each node outside the largest component, one per
    other component that has a node alike enough."""
    sizes = [len(x) for x, _ in bags]
    elements, place = np.unique(np.concatenate([x for x, _ in bags]), return_inverse=True)
    weights = np.concatenate([w for _, w in bags])
    owners = np.repeat(np.arange(len(bags)), sizes)
    order = np.argsort(place, kind="stable")
    owners, held = owners[order], weights[order]
    starts = np.searchsorted(place[order], np.arange(len(elements) + 1))
    totals = np.array([w.sum() for _, w in bags])
    names, number = np.unique(roots, return_counts=True)
    largest = names[np.argmax(number)]
    ends, out = np.cumsum(sizes), []
    for i in np.flatnonzero(roots != largest):
        own = place[ends[i] - sizes[i] : ends[i]]
        run = starts[own + 1] - starts[own]
        after = np.cumsum(run)
        at = np.repeat(starts[own] - (after - run), run) + np.arange(after[-1])
        least = np.minimum(held[at], np.repeat(bags[i][1], run))
        shared = np.bincount(owners[at], least, len(bags))
        alike = (shared / (totals + totals[i] - shared) >= threshold) & (roots != roots[i])
        _, first = np.unique(roots[alike], return_index=True)
        out += [(int(min(nodes[i], n)), int(max(nodes[i], n))) for n in nodes[alike][first]]
    return out


def fold(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per row of a matrix; the row's number counts too."""
    key = np.arange(len(values), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in values.T:
        key = (key ^ column) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
    return key


def _digest() -> Column:
    return F.sha2(whole_text(), 256)


def sketch_nodes(docs: DataFrame, keys_of: Callable[[str], np.ndarray]) -> DataFrame:
    """``node``, ``digest``, ``keys``: the distinct texts with their band keys, stored."""
    schema = pa.schema([("digest", pa.string()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            first = dict(zip(batch["digest"].to_pylist(), batch["text"].to_pylist()))
            yield table_batch(
                schema, digest=list(first), keys=[keys_of(t).astype(np.int64) for t in first.values()]
            )

    rows = docs.select(_digest().alias("digest"), whole_text().alias("text"))
    made = rows.mapInArrow(run, "digest string, keys array<long>").dropDuplicates(["digest"])
    # The numbers are fixed by being stored together with the digests.
    return stored(made.select(F.monotonically_increasing_id().alias("node"), "digest", "keys"), "nodes")


def _buckets(keyed: DataFrame) -> DataFrame:
    """``key``, ``node``, ``hub``, ``size`` of the buckets with several members."""
    sizes = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("size")).where("size > 1")
    return stored(keyed.join(sizes, "key"), "members")


def _pairs(left: Column, right: Column) -> tuple[Column, Column]:
    return F.least(left, right).alias("a"), F.greatest(left, right).alias("b")


def _verified(
    pairs: DataFrame, texts: DataFrame, bag_of: Callable[[str], Bag], threshold: float
) -> DataFrame:
    """The pairs (a < b) whose texts are alike enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "one"), "other"):
            good, last, bag = [], None, None
            for a, b, one, other in zip(*(batch[c].to_pylist() for c in ("a", "b", "one", "other"))):
                if one != last:
                    last, bag = one, bag_of(one)
                if likeness(bag, bag_of(other)) >= threshold:
                    good.append((a, b))
            yield table_batch(schema, a=[g[0] for g in good], b=[g[1] for g in good])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for nodes with an edge.

    Alternates two steps until nothing changes: every node links its larger neighbours, then
    its smaller ones, to the least node it sees.  Each step is an aggregation and a join.
    """

    def stars(rows: DataFrame, smaller: bool) -> DataFrame:
        both = rows.union(rows.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.where("b < a") if smaller else both
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = near.join(least, "a")
        moved = joined.where("b > a" if not smaller else "b <> m").select(F.col("m").alias("a"), "b")
        if smaller:
            moved = moved.union(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
        return moved.where("a <> b").select(*_pairs(F.col("a"), F.col("b"))).distinct()

    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())

    rows = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = state(rows)
    while True:
        rows = stored(stars(stars(rows, False), True), "edges")
        if before == (before := state(rows)):
            break
    found = rows.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return found.union(rows.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _settled(rows: DataFrame, texts: DataFrame, bag_of: Callable[[str], Bag], threshold: float) -> DataFrame:
    """Links between the components of large buckets (``key``, ``node``, ``root``, ``size``)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        nodes, roots = (group[c].to_numpy() for c in ("node", "root"))
        found = links_between(nodes, roots, [bag_of(t) for t in group["text"].to_pylist()], threshold)
        return pa.table({"a": [f[0] for f in found], "b": [f[1] for f in found]}, schema=schema)

    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = rows.select(
        "key", "node", "root", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    )
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    whole = dealt.select("key", "low", "high", "node", "root").join(texts, "node")
    return whole.groupBy("key", "low", "high").applyInArrow(run, "a long, b long").distinct()


def link(
    nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], bag_of: Callable[[str], Bag], threshold: float
) -> DataFrame:
    """``node`` and ``root`` of the nodes that some alike node was found for."""
    members = _buckets(nodes.select("node", F.explode("keys").alias("key")))
    texts = stored(texts_of(members.select("node").distinct()), "texts")
    stars = members.where("node <> hub").select(*_pairs(F.col("hub"), F.col("node"))).distinct()
    edges = stored(_verified(stars, texts, bag_of, threshold), "links")
    found = stored(components(edges), "components")
    placed = members.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_rows = stored(placed.join(mixed.where("low < high").select("key"), "key"), "open")
    small = open_rows.where(F.col("size") <= SMALL)
    left = small.select("key", F.col("node").alias("x"), F.col("root").alias("x_root"))
    right = small.select("key", F.col("node").alias("y"), F.col("root").alias("y_root"))
    crossed = left.join(right, "key").where("x < y AND x_root <> y_root").select(*_pairs(F.col("x"), F.col("y")))
    # Pairs with the bucket's first member have been looked at.
    crossed = crossed.distinct().join(stars, ["a", "b"], "left_anti")
    more = _verified(crossed, texts, bag_of, threshold)
    more = stored(more.union(_settled(open_rows.where(F.col("size") > SMALL), texts, bag_of, threshold)), "links")
    return found if more.isEmpty() else components(edges.union(more))


def near_classes(
    docs: DataFrame,
    keys_of: Callable[[str], np.ndarray],
    bag_of: Callable[[str], Bag],
    threshold: float,
) -> DataFrame:
    """``doc_id``, ``class_id`` (the least id of the class) and ``class_size`` of every row.

    Equal texts are always one class.  A class whose ids are all null has a null class id.
    """
    nodes = sketch_nodes(docs, keys_of)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), _digest().alias("digest"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        """One text of each node; the join can be split where a text has very many copies."""
        named = nodes.select("node", "digest").join(wanted, "node").select("node", "digest")
        texts = docs.select(_digest().alias("digest"), whole_text().alias("text"))
        held = stored(texts.join(named, "digest").select("node", "text"), "copies")
        return held.dropDuplicates(["node"])

    found = link(nodes.select("node", "keys"), texts_of, bag_of, threshold)
    known = nodes.select("node", "digest").join(found, "node", "left")
    known = known.select("digest", F.coalesce("root", "node").alias("root"))
    placed = stored(rows.join(known, "digest").select("doc_id", "root"), "placed")
    classes = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return placed.join(classes, "root").select("doc_id", "class_id", "class_size")
