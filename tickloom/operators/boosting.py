"""Regularised second-order boosting in DataFrame operations.

Squared error, so a row's gradient is forecast minus label and its curvature 1.  Inputs are
binned once.  Each level of a tree is one aggregation: gradient sum and row count per node,
input and bin, combined before the shuffle, so what is shuffled and what the splits are chosen
from depends on nodes, inputs and bins, not on rows.  A split gains
GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2); both sides are tried for missing values
and the better one is kept with the split; a leaf is worth -G / (H + l2) times the learning rate.

Gradients are summed as integers of a fixed unit, so a retried task or another partitioning gives
the same tree.  Ties go to the first input, the lowest cut, and missing values to the right.
Rows without a label are left out; no labelled row at all, or inputs of one value, give a model
without splits.  Only splits and leaves (2 ** depth a tree) reach the driver.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.constants import MODEL_PARAMS, PREDICTION
from tickloom.functions.sqltext import q
from tickloom.session import ensure_checkpoint_dir

#: Not a bin: the value is null or NaN.
MISSING = -1


@dataclass(frozen=True)
class Split:
    """Values below ``cut`` go left, to node 2n, others right, to 2n + 1."""

    input: int
    bin: int
    cut: float
    missing_left: bool
    gain: float


@dataclass
class Tree:
    splits: dict[int, Split] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def sql(self, goes_left: Callable[[Split], str], leaf: Callable[[int], str], node: int = 1) -> str:
        """The tree as nested conditions."""
        if node not in self.splits:
            return leaf(node)
        left, right = (self.sql(goes_left, leaf, n) for n in (2 * node, 2 * node + 1))
        return f"IF({goes_left(self.splits[node])}, {left}, {right})"


@dataclass
class BoostedTrees:
    inputs: list[str]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def predict(self, df: DataFrame, name: str = PREDICTION) -> DataFrame:
        """The rows with a forecast; an input that is null or NaN goes the side learned for it."""

        def goes_left(split: Split) -> str:
            x = f"CAST({q(self.inputs[split.input])} AS DOUBLE)"
            below = "true" if split.cut == math.inf else f"{x} < {_double(split.cut)}"
            return f"IF({x} IS NULL OR isnan({x}), {str(split.missing_left).lower()}, {below})"

        values = [t.sql(goes_left, lambda n, t=t: _double(t.leaves.get(n, 0.0))) for t in self.trees]
        return df.withColumn(name, F.expr(" + ".join([_double(self.base), *values])))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> BoostedTrees:
        held = json.loads(text)
        trees = [
            Tree({int(n): Split(**s) for n, s in t["splits"].items()}, {int(n): v for n, v in t["leaves"].items()})
            for t in held["trees"]
        ]
        return cls(held["inputs"], held["base"], trees)


def _double(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def quantile_cuts(df: DataFrame, inputs: Sequence[str], bins: int = 255) -> list[list[float]]:
    """Cuts between ``bins`` bins of about as many rows, per input; one pass, mergeable sketches."""
    named = df.select(*[F.col(q(c)).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)])
    found = named.approxQuantile(named.columns, [i / bins for i in range(1, bins)], 1 / (4 * bins))
    return [sorted({c for c in cuts if math.isfinite(c)}) for cuts in found]


def binned(df: DataFrame, inputs: Sequence[str], cuts: Sequence[Sequence[float]], label: str) -> DataFrame:
    """``bins`` (how many cuts each value reaches), ``y``, and ``id`` to draw samples by."""
    values = [F.col(q(c)).cast("double") for c in inputs]
    rows = df.where(F.col(q(label)).isNotNull() & ~F.isnan(F.col(q(label)).cast("double")))
    rows = rows.select(
        F.col(q(label)).cast("double").alias("y"),
        F.xxhash64(q(label), *values).alias("id"),
        *[F.when(~F.isnan(v), v).alias(f"x{i}") for i, v in enumerate(values)],
    )
    used = [i for i, c in enumerate(cuts) if c]
    if used:
        rows = Bucketizer(
            inputCols=[f"x{i}" for i in used],
            outputCols=[f"b{i}" for i in used],
            splitsArray=[[-math.inf, *cuts[i], math.inf] for i in used],
            handleInvalid="keep",
        ).transform(rows)
    bins = [
        (F.when(F.col(f"x{i}").isNull(), MISSING).otherwise(F.col(f"b{i}")) if cuts[i] else F.lit(MISSING)).cast("int")
        for i in range(len(inputs))
    ]
    return rows.select("id", "y", F.array(*bins).alias("bins"))


def histogram(rows: DataFrame, chosen: Sequence[int]) -> DataFrame:
    """``g`` and ``h`` per ``node``, ``input`` and ``bin``, of rows with node, g and bins."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("input"), F.col("bins")[i].alias("bin")) for i in chosen]))
    pairs = rows.select("node", "g", each.alias("at")).select("node", "g", "at.input", "at.bin")
    return pairs.groupBy("node", "input", "bin").agg(F.sum("g").alias("g"), F.count("*").alias("h"))


def best_splits(hist: DataFrame, unit: float, l2: float, min_rows: int) -> DataFrame:
    """The split of most gain per node, of those that leave ``min_rows`` on both sides."""
    frame = "PARTITION BY node, input"
    seen = hist.selectExpr(
        "node", "input", "bin",
        f"sum(g) OVER ({frame}) AS g", f"sum(h) OVER ({frame}) AS h",
        f"sum(IF(bin = {MISSING}, g, 0)) OVER ({frame}) AS gm", f"sum(IF(bin = {MISSING}, h, 0)) OVER ({frame}) AS hm",
        f"sum(IF(bin = {MISSING}, 0, g)) OVER ({frame} ORDER BY bin) AS gb",
        f"sum(IF(bin = {MISSING}, 0, h)) OVER ({frame} ORDER BY bin) AS hb",
    ).where(f"bin <> {MISSING}")
    sides = "inline(array(struct(false AS missing_left, gb AS gl, hb AS hl), struct(true AS missing_left, gb + gm AS gl, hb + hm AS hl)))"
    tried = seen.selectExpr("node", "input", "bin", "g", "h", sides).where(f"hl >= {min_rows} AND h - hl >= {min_rows}")

    def part(g: str, h: str) -> str:
        return f"(CAST({g} AS DOUBLE) / {_double(unit)}) * (CAST({g} AS DOUBLE) / {_double(unit)}) / ({h} + {_double(l2)})"

    gain = f"{part('gl', 'hl')} + {part('(g - gl)', '(h - hl)')} - {part('g', 'h')}"
    ranked = tried.selectExpr("node", "input", "bin", "missing_left", f"{gain} AS gain").where("gain > 0")
    order = F.struct("gain", -F.col("input"), -F.col("bin"), ~F.col("missing_left"))
    return ranked.groupBy("node").agg(F.max_by(F.struct("input", "bin", "missing_left", "gain"), order).alias("best"))


def fit(
    df: DataFrame,
    inputs: Sequence[str],
    label: str,
    trees: int = MODEL_PARAMS["trees"],
    depth: int = MODEL_PARAMS["depth"],
    learning_rate: float = MODEL_PARAMS["learning_rate"],
    l2: float = MODEL_PARAMS["l2"],
    min_rows: int = 20,
    input_fraction: float = MODEL_PARAMS["feature_fraction"],
    row_fraction: float = MODEL_PARAMS["bagging_fraction"],
    redraw: int = MODEL_PARAMS["bagging_freq"],
    seed: int = MODEL_PARAMS["seed"],
    cuts: Sequence[Sequence[float]] | None = None,
    unit: float | None = None,
) -> BoostedTrees:
    """Boosted trees on ``inputs``.  Each tree sees a share of the inputs; the share of the rows is
    drawn anew every ``redraw`` trees, by a hash of the row, so equal rows are drawn together.

    ``cuts`` are quantiles unless given.  ``unit`` is the number of steps a gradient of 1 has, as
    many as the sums can hold unless given."""
    ensure_checkpoint_dir(df.sparkSession)
    cuts = quantile_cuts(df, inputs) if cuts is None else cuts
    rows = binned(df, inputs, cuts, label).checkpoint()
    n, largest = rows.agg(F.count("*"), F.max(F.abs("y"))).first()
    if not n:
        return BoostedTrees(list(inputs), 0.0)
    # A forecast stays between the labels or close beyond, so a gradient below four times the largest.
    unit = unit or 2.0 ** min(40, 60 - math.ceil(math.log2(max(n * largest * 4, 1e-9))))
    steps = f"CAST(floor(({{}}) * {_double(unit)} + 0.5D) AS BIGINT)"
    base = rows.agg(F.sum(F.expr(steps.format("y")))).first()[0] / n / unit
    model = BoostedTrees(list(inputs), base)
    rows = rows.withColumn("f", F.lit(base))
    usable = [i for i, c in enumerate(cuts) if c]
    for t in range(trees if usable else 0):
        chosen = sorted(random.Random(seed * 1_000_003 + t).sample(usable, math.ceil(input_fraction * len(usable))))
        draw = F.pmod(F.xxhash64("id", F.lit(seed), F.lit(t // redraw)), F.lit(1 << 20))
        drawn = rows.where(draw < F.lit(round(row_fraction * (1 << 20)))).withColumn("g", F.expr(steps.format("f - y")))
        tree = Tree()

        def goes_left(s: Split) -> str:
            return f"IF(bins[{s.input}] = {MISSING}, {str(s.missing_left).lower()}, bins[{s.input}] <= {s.bin})"

        for level in range(depth):
            # Only nodes of this level are open: the others found no split before.
            at = drawn.withColumn("node", F.expr(tree.sql(goes_left, str))).where(F.col("node") >= 1 << level)
            found = best_splits(histogram(at, chosen), unit, l2, min_rows).collect()
            for node, best in found:
                edges = [*cuts[best["input"]], math.inf]
                tree.splits[node] = Split(best["input"], best["bin"], edges[best["bin"]], best["missing_left"], best["gain"])
            if not found:
                break
        node = F.expr(tree.sql(goes_left, str))
        for r in drawn.groupBy(node.alias("node")).agg(F.sum("g").alias("g"), F.count("*").alias("h")).collect():
            tree.leaves[r["node"]] = -(r["g"] / unit) / (r["h"] + l2) * learning_rate
        model.trees.append(tree)
        step = tree.sql(goes_left, lambda n: _double(tree.leaves.get(n, 0.0)))
        rows = rows.withColumn("f", F.expr(f"f + {step}"))
        if t % redraw == redraw - 1:  # cuts the lineage, and what is computed again per level
            rows = rows.checkpoint()
    return model
