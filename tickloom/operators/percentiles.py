"""Exact interpolated percentiles per group by distributed selection.

One way for groups of every size, of which no task ever holds one:

Rows are dealt once, by group and one of DEALS numbers that rows get by turns, so a large group
goes to many tasks.

1. A value's cell is its sign and its logarithm in CELLS steps an octave, an order-preserving
   number, so cells hold disjoint ranges; 2**_PART_BITS neighbouring cells are a part.  Rows are
   counted per group and part, combining on the map side.  The counts, running over the parts
   of a group, tell which parts hold the wanted ranks, two for each at most.
2. The rows of those parts alone are counted per group and cell, combining on the map side; the
   counts leave the cells that hold the wanted ranks: of a large group some ten-thousandth.
3. The rows of those cells alone are counted per value, combining on the map side, and dealt by
   group and value, so neither a large group nor a frequent value fills a task.  The values are
   ranked, each cell by itself.

Wanted parts and cells, a narrow row a group, are dealt the same way and looked up in a hash table
of those a task meets, which holds groups, never rows; so no rows are sorted, however many groups
there are.  So a task counts at most the parts of its groups (CELLS >> _PART_BITS for each doubling between
the smallest and largest value, however many rows or different values), and meets at most the
cells of a part or the different values of a cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.sqltext import q

#: Cells an octave.
CELLS = 1 << 12
# Cells of a part, as a power of two.
_PART_BITS = 8
#: Tasks that a group is dealt to, at most; a power of two.
DEALS = 16
# More than the cell of any number: a double's binary exponent is at least -1,074.
_OFFSET = 1_100 * CELLS
_INFINITE, _NAN = 1 << 40, 1 << 41


def cell(x: str) -> str:
    """Order-preserving cell number; NaN is above all numbers."""
    size = f"CAST(floor(log2(abs({x})) * {CELLS}) AS BIGINT) + {_OFFSET}L"
    return (
        f"CASE WHEN isnan({x}) THEN {_NAN}L WHEN abs({x}) = DOUBLE('Infinity') THEN CAST(sign({x}) AS BIGINT) * {_INFINITE}L"
        f" WHEN {x} > 0 THEN {size} WHEN {x} < 0 THEN -({size}) ELSE 0L END"
    )


def _over(keys: Sequence[str], order: str | None = None) -> str:
    by = f" ORDER BY {order}" if order else ""
    return f"(PARTITION BY {', '.join(map(q, keys))}{by})"


def _match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which null keys match, as they do in groups."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    same = " AND ".join(f"{q(k)} <=> {q(f'_r_{k}')}" for k in on)
    return left.join(renamed, F.expr(same)).drop(*[f"_r_{k}" for k in on])


def _inside(each: DataFrame, kept: DataFrame, number: str, numbered: Mapping[str, Column]) -> DataFrame:
    """Rows whose part or cell is among those kept of their group."""
    held = kept.groupBy("_group").agg(F.collect_set(number).alias("_held"))
    dealt = F.explode(F.lit(list(range(DEALS))).cast("array<int>"))
    held = held.select(F.col("_group").alias("_of"), "_held", dealt.alias("_number")).hint("shuffle_hash")
    # A group is a struct: never null itself, and null keys inside are equal.
    found = each.join(held, F.expr("_group = _of AND _deal = _number"))
    # Without coalesce, Spark would put a filter on the number below the dealing of one use only.
    inside = f"coalesce(array_contains(_held, {number}), false)"
    return found.withColumns(numbered).where(inside).drop("_of", "_held", "_number")


def percentiles(
    rows: DataFrame, keys: Sequence[str], value: str, subsets: Mapping[str, str | None], probs: Sequence[float]
) -> DataFrame:
    """Per group and subset (name -> condition on the row, None for all rows) an array
    ``_p_{name}`` of the continuous percentiles of ``value``; its entries are null where the
    subset has no value, and a group without any value has no row."""
    group, parts_of, cells_of = ["_group"], ["_group", "_part"], ["_group", "_part", "_cell"]
    tags = range(len(subsets))
    counts = [F.expr(f"sum(_n{t}) AS _n{t}") for t in tags]
    ranks = [(t, i, f"({p}D * (_of{t} - 1))") for t in tags for i, p in enumerate(probs)]
    # Both ranks that are interpolated may lie in the part or cell.
    holds = [f"_n{t} > 0 AND ceil({at}) >= _upto{t} - _n{t} AND floor({at}) < _upto{t}" for t, _, at in ranks]
    any_rank = " OR ".join(f"({h})" for h in holds)

    # Zero has one sign here, as values are grouped.
    ones = [f"IF({c}, 1, 0) AS _n{t}" if c else f"1 AS _n{t}" for t, c in enumerate(subsets.values())]
    whole = f"struct({', '.join(map(q, keys))}) AS _group"
    each = rows.where(f"{value} IS NOT NULL").selectExpr(whole, f"{value} + 0D AS _x", *ones)
    # Read once, used three times: all uses need the same columns of the dealt rows, so cells
    # are computed after the joins.
    each = each.withColumn("_deal", F.expr(f"CAST(monotonically_increasing_id() & {DEALS - 1} AS INT)"))
    each = each.repartition("_group", "_deal")
    numbered = {"_cell": F.expr(cell("_x")), "_part": F.expr(f"shiftright({cell('_x')}, {_PART_BITS})")}

    running = [f"sum(_n{t}) OVER {_over(group, '_part')} AS _upto{t}" for t in tags]
    totals = [f"sum(_n{t}) OVER {_over(group)} AS _of{t}" for t in tags]
    before = [f"_upto{t} - _n{t} AS _before{t}" for t in tags]
    known = [*before, *[f"_of{t}" for t in tags]]
    parts = each.withColumn("_part", numbered["_part"]).groupBy(*parts_of).agg(*counts)
    parts = parts.selectExpr("*", *running, *totals).where(any_rank).selectExpr(*parts_of, *known)
    cells = _inside(each, parts, "_part", numbered).groupBy(*cells_of).agg(*counts)

    running = [f"_before{t} + sum(_n{t}) OVER {_over(parts_of, '_cell')} AS _upto{t}" for t in tags]
    counted = _match(cells, parts, parts_of).selectExpr("*", *running)
    chosen = counted.where(any_rank).selectExpr(*cells_of, *known)
    values = _inside(each, chosen, "_cell", numbered).groupBy(*cells_of, "_x").agg(*counts)

    upto = [f"_before{t} + sum(_n{t}) OVER {_over(cells_of, '_x')} AS _upto{t}" for t in tags]
    ranked = _match(values, chosen, cells_of).selectExpr("*", *upto)
    picked = [f"max(_of{t}) AS _of{t}" for t in tags]
    for t, i, at in ranks:
        for name, rank in (("lo", f"floor({at})"), ("hi", f"ceil({at})")):
            there = f"_n{t} > 0 AND {rank} >= _upto{t} - _n{t} AND {rank} < _upto{t}"
            picked.append(f"max(CASE WHEN {there} THEN _x END) AS _{name}{t}_{i}")
    found = ranked.groupBy("_group").agg(*[F.expr(x) for x in picked])
    shown = {t: [] for t in tags}
    for t, i, at in ranks:
        share, lo, hi = f"({at} - floor({at}))", f"_lo{t}_{i}", f"_hi{t}_{i}"
        shown[t].append(f"CASE WHEN {share} = 0D THEN {lo} ELSE (1D - {share}) * {lo} + {share} * {hi} END")
    unpacked = [f"_group.{q(k)} AS {q(k)}" for k in keys]
    return found.selectExpr(*unpacked, *[f"array({', '.join(shown[t])}) AS {q(f'_p_{s}')}" for t, s in enumerate(subsets)])
