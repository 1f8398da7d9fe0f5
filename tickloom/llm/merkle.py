"""A Merkle manifest of a table, with a proof for every row, by butterfly exchange.

A row's leaf is the digest of its fields; the leaves of a source, in order of document id, form
a tree of FANOUT children a node; the roots of the sources form another above it.

Leaves are numbered within their source and cut into aligned partitions of FANOUT**DEPTH, whose
subtrees need no other partition.  Above that, partitions swap roots round by round: in round
r, those of an aligned group that agree in all ternary digits but digit r.  Each member hashes
the group's root itself, so after the last round every partition holds the source's root and
the siblings on the way to it, and nothing is handed down again.  A group's last subtree may
hold fewer partitions than the others; these then also send in the place of those it lacks.

Leaves with one id are ordered by their digest, null ids and the null source come first, nulls
in fields are written ``-``; equal rows are interchangeable; an empty table gives an empty
result; columns besides the five are not read.  A row whose id is null is never tampered with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored

FANOUT = 3
#: A partition has FANOUT**DEPTH leaves: 729, some 100 KB.
DEPTH = 6
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<place:int,others:array<string>>"


# --- leaves -------------------------------------------------------------------------


def _framed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[_framed(f) for f in fields]).cast("binary"), 256)


def tampered(doc_id: Column) -> Column:
    """Whether the check deletes line ends from the row's text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """Source, id, leaf, and the leaf after tampering (null where nothing is tampered with)."""
    fields = {c: docs[c].cast("long") if c in ("doc_id", "n_chars") else docs[c].cast("string") for c in _FIELDS}
    cut = fields | {"text": F.translate(fields["text"], "\n", "")}
    return docs.select(
        fields["source"].alias("source"),
        fields["doc_id"].alias("doc_id"),
        leaf(*fields.values()).alias("leaf"),
        F.when(tampered(fields["doc_id"]), leaf(*cut.values())).alias("cut_leaf"),
    )


# --- numbering ----------------------------------------------------------------------


def _numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with ``place`` within their group, and ``size`` per group.

    Rows are dealt by ranges and counted per task; equal keys are spread by their place in
    the input, so no key fills a task.  The second result has a row per group.
    """
    keyed = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(*group, *order, "tie").sortWithinPartitions(*group, *order)
    held = stored(ranged.drop("tie").withColumn("at", F.monotonically_increasing_id()), name)
    # The upper bits of ``at`` are the task, the lower 33 the row in it.
    task = F.shiftright("at", 33).alias("task")
    runs = held.groupBy(*group, task).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # A row per group and task that holds some of it: groups are ranges, so about as many as
    # there are groups and tasks together, and as many as there are tasks in one window.
    before = Window.partitionBy(*group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(*group, "task", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    sizes = runs.groupBy(*group).agg(F.sum("n").alias("size"))
    placed = _join(held.withColumn("task", task), starts, [*group, "task"])
    return placed.withColumn("place", F.col("start") + F.col("at") - F.col("first")).drop("start", "at", "first", "task"), sizes


def _join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which nulls match."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = " AND ".join(f"`{c}` <=> `_r_{c}`" for c in on)
    return left.join(renamed, F.expr(same)).drop(*[f"_r_{c}" for c in on])


# --- trees --------------------------------------------------------------------------


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes: list[str], depth: int | None) -> list[list[str]]:
    """All levels of a tree, leaves first: ``depth`` steps up, or up to a single node."""
    out = [nodes]
    while len(out) <= depth if depth is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([digest(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def path(tree: list[list[str]], i: int) -> list[tuple[int, list[str]]]:
    """Per level of the tree but the last: place in its run and the others of the run."""
    out = []
    for nodes in tree[:-1]:
        first = i - i % FANOUT
        run = nodes[first : first + FANOUT]
        out.append((i - first, run[: i - first] + run[i - first + 1 :]))
        i //= FANOUT
    return out


def fold(node: str, steps) -> str:
    """The root that a node and its siblings give."""
    for place, others in steps:
        node = digest([*others[:place], node, *others[place:]])
    return node


def _partitions(
    placed: DataFrame, sizes: DataFrame, group: Sequence[str], entry: Sequence[str], depth: int, name: str
) -> DataFrame:
    """One row per partition of leaves: its entries in order, its root, and the steps to it
    (null: as many as there are)."""
    width = FANOUT**depth
    part = F.floor(F.col("place") / width).cast("long").alias("part")
    gathered = placed.groupBy(*group, part).agg(F.sort_array(F.collect_list(F.struct("place", *entry))).alias("entries"))
    joined = _join(gathered, sizes.withColumn("parts", F.ceil(F.col("size") / width).cast("long")), group).drop("size")
    joined = joined.withColumn("depth", F.when(F.col("parts") > 1, F.lit(depth)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = []
            for entries, steps in zip(batch["entries"], batch["depth"].to_pylist()):
                roots.append(levels(entries.values.field("leaf").to_pylist(), steps)[-1][0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())], [*batch.schema.names, "root"])

    return stored(joined.mapInArrow(run, f"{kinds}, root string"), name)


def butterfly(parts: DataFrame, group: Sequence[str], rounds: int) -> DataFrame:
    """Swaps roots for ``rounds`` rounds; ``upper`` gathers the steps above each partition and
    ``root`` ends as the group's.  A round is one shuffle of a row per partition, in groups of
    at most FANOUT."""
    held = parts.select(*group, "part", "parts", "root").withColumn("upper", F.expr(f"CAST(array() AS array<{_STEP}>)"))
    for r in range(rounds):
        size = FANOUT**r
        # Subtree of this round, partitions it holds, and the place within it.
        held = held.selectExpr("*", f"part div {size} AS subtree", f"part % {size} AS within").selectExpr(
            "*", f"least({size}, parts - subtree * {size}) AS holds"
        )
        # A short subtree's partitions also send as the ones it lacks; only the first copy,
        # the partition's own, receives.  Groups that have their root pass through.
        last = f"IF(parts <= {size}, within, {size - 1}L)"
        sent = held.selectExpr("*", f"explode(sequence(within, {last}, holds)) AS place")
        swapped = sent.groupBy(*group, F.expr(f"subtree div {FANOUT}").alias("above"), "place").agg(
            F.sort_array(F.collect_list(F.struct("subtree", "root"))).alias("run"),
            F.collect_list(
                F.when(F.col("place") == F.col("within"), F.struct("part", "parts", "upper", "subtree", "root"))
            ).alias("receivers"),
        )
        out = swapped.select(*group, "run", F.explode("receivers").alias("x")).select(*group, "run", "x.*")
        mine = f"named_struct('place', CAST(subtree % {FANOUT} AS INT), 'others', transform(filter(run, e -> e.subtree <> subtree), e -> e.root))"
        done = f"parts <= {size}"  # a single node remains: the root stays
        held = out.selectExpr(
            *group,
            "part",
            "parts",
            f"IF({done}, root, sha2(CAST(array_join(transform(run, e -> e.root), '') AS BINARY), 256)) AS root",
            f"IF({done}, upper, concat(upper, array({mine}))) AS upper",
        )
    return held


def _rounds(sizes: DataFrame, depth: int) -> int:
    """Rounds that the largest group needs."""
    most = sizes.agg(F.max("size")).first()[0] or 0
    parts, rounds = -(-most // FANOUT**depth), 0
    while FANOUT**rounds < parts:
        rounds += 1
    return rounds


def forest(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], entry: Sequence[str], depth: int, name: str
) -> DataFrame:
    """Per partition of a group's leaves: entries (the columns ``entry``, with the node in
    ``leaf``), steps above the partition, the group's root."""
    placed, sizes = _numbered(rows, group, order, name)
    parts = _partitions(placed, sizes, group, entry, depth, f"{name}-partitions")
    swapped = stored(butterfly(parts, group, _rounds(sizes, depth)), f"{name}-proofs").drop("parts")
    return _join(parts.drop("root"), swapped, [*group, "part"])


# --- manifest -----------------------------------------------------------------------

_OUT = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.string()) for c in ("source", "leaf", "subroot", "root", "proof_sha256", "folded_root")]
    + [("verified", pa.bool_())]
)
_SOURCE = pa.schema(
    [
        ("source", pa.string()),
        ("subroot", pa.string()),
        ("root", pa.string()),
        ("source_steps", pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))]))),
    ]
)


def _steps(value) -> list[tuple[int, list[str]]]:
    return [(s["place"], s["others"]) for s in value]


def _sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions of the tree of sources, a row per source."""
    for batch in batches:
        for row in batch.to_pylist():
            tree = levels([e["leaf"] for e in row["entries"]], row["depth"])
            upper = _steps(row["upper"])
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "source": e["source"],
                        "subroot": e["leaf"],
                        "root": row["root"],
                        "source_steps": [{"place": p, "others": o} for p, o in [*path(tree, i), *upper]],
                    }
                    for i, e in enumerate(row["entries"])
                ],
                schema=_SOURCE,
            )


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            entries = row["entries"]
            tree = levels([e["leaf"] for e in entries], row["depth"])
            above = [*_steps(row["upper"]), *_steps(row["source_steps"])]
            out = []
            for i, e in enumerate(entries):
                steps = [*path(tree, i), *above]
                folded = fold(e["cut_leaf"] or e["leaf"], steps)
                out.append(
                    {
                        "doc_id": e["doc_id"],
                        "source": row["source"],
                        "leaf": e["leaf"],
                        "subroot": row["subroot"],
                        "root": row["root"],
                        "proof_sha256": digest([x for _, others in steps for x in others]),
                        "folded_root": folded,
                        "verified": folded == row["root"],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=_OUT)


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Every row's leaf, the root of its source and of the table, its proof, and what the proof
    gives after tampering."""
    trees = forest(leaves(docs), ["source"], ["doc_id", "leaf"], ["doc_id", "leaf", "cut_leaf"], depth, "leaves")
    trees = trees.withColumnRenamed("root", "subroot")
    subroots = trees.where("part = 0").select("source", F.col("subroot").alias("leaf")).withColumn("all", F.lit(0))
    tops = forest(subroots, ["all"], ["source"], ["source", "leaf"], depth, "sources")
    tops = tops.mapInArrow(
        _sources, f"source string, subroot string, root string, source_steps array<{_STEP}>"
    )
    joined = _join(trees, tops.drop("subroot"), ["source"])
    return joined.mapInArrow(
        _proofs,
        "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string,"
        " folded_root string, verified boolean",
    )
