"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Targets.  Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ...; they share the
words of all documents by weight, a target stops at REPEATS times its source's words, and
the excess is shared again until no target is above.  That has a closed form: one level of
words per weight, found by running sums over the sources ordered by the weight at which
they fill up.

Sampling.  A document is due target / source words copies.  The whole copies are certain;
the rest is its inclusion probability p.  Documents are ranked by u / (1 - u) over
p / (1 - p), with u a hash of the document, and taken in that order while their words fit
what the source still needs.  What is still missing is offered again, in the same order, to
the documents that fit into it; in the last round one document may overshoot if that brings the
source closer to its target.

The order is found without sorting a source: ranks are counted in steps, the step that
crosses the need is found on the counts, and only its rows are ordered, so a source with a
third of all rows is no task of its own.  Reruns agree.  Null texts have no words; documents
without words are never drawn; rows of equal id, source and text are drawn together; an
empty table gives no rows.  Null ids are allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored

WEIGHTS = (1, 2, 3)
REPEATS = 3
#: Steps that the ranks of a source are counted in.
STEPS = 4096
#: Times that what is missing is offered again.
ROUNDS = 3
SEED = 7

_RUNNING = (Window.unboundedPreceding, Window.currentRow)


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of each source; one row per source is ordered,
    never the documents."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place - 1) % len(WEIGHTS) + 1).cast("double")
    total = F.sum("source_size").over(Window.partitionBy())
    weighed = sources.withColumn("weight", weight).withColumn("total", total)
    cap = F.col("source_size") * float(REPEATS)
    order = Window.orderBy(F.col("source_size") * float(REPEATS) / F.col("weight"), F.asc_nulls_last("source"))
    spent = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # The words per weight if this source and all that fill up later are not yet full.
    levels = weighed.withColumn("level", (F.col("total") - spent) / left)
    # Levels rise while sources fill up and fall from there on.
    level = F.max("level").over(Window.partitionBy())
    share = F.least(cap, F.coalesce(level * F.col("weight"), cap))
    return levels.select("source", "source_size", share.alias("target"))


def _pareto_rank(share: Column) -> Column:
    """u / (1 - u) over p / (1 - p), brought into (0, 1) by x / (1 + x), which keeps the order."""
    odds = F.col("u") / (1 - F.col("u")) * (1 - share) / share
    return odds / (1 + odds)


def _draw(rows: DataFrame, needs: DataFrame, closer: bool) -> DataFrame:
    """``tie`` of the rows taken: in the order of ``rank`` while ``size`` fits the
    source's ``need``; with ``closer``, the row that crosses it too if that comes closer."""
    placed = rows.withColumn("step", F.least(F.floor(F.col("rank") * STEPS), F.lit(STEPS - 1)))
    counts = placed.groupBy("source", "step").agg(F.sum("size").alias("words"))
    by_step = Window.partitionBy("source").orderBy("step")  # STEPS rows of a source at most
    counts = counts.withColumn("upto", F.sum("words").over(by_step.rowsBetween(*_RUNNING)))
    edges = counts.join(needs, counts["source"].eqNullSafe(needs["source"])).where("upto >= need")
    edges = edges.groupBy(counts["source"]).agg(
        F.min(F.struct("step", (F.col("upto") - F.col("words")).alias("held"), "need")).alias("edge")
    )
    edges = edges.select(F.col("source").alias("edge_source"), "edge")
    matched = placed.join(edges, F.col("source").eqNullSafe(F.col("edge_source")), "left")
    whole = matched.where("edge IS NULL OR step < edge.step").select("tie")
    crossing = matched.where("step = edge.step")
    by_rank = Window.partitionBy("source", "step").orderBy("rank", "tie").rowsBetween(*_RUNNING)
    crossing = crossing.withColumn("upto", F.col("edge.held") + F.sum("size").over(by_rank))
    over = F.col("upto") - F.col("edge.need")
    fits = over <= 0
    if closer:
        fits |= over < F.col("size") - over
    return whole.union(crossing.where(fits).select("tie"))


def document_key(docs: DataFrame) -> Column:
    """Tells documents apart, and rows of equal id, source and text not."""
    return F.xxhash64(docs["doc_id"], docs["source"], docs["text"])


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``tie`` (the document's key), ``doc_id``, ``source``, ``size``, ``source_size``, ``target``,
    ``copies`` and ``taken`` of every document."""
    sized = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        word_count(docs["text"].cast("string")).alias("size"),
        document_key(docs).alias("tie"),
    )
    sized = stored(sized, "sizes")
    shares = targets(sized).withColumnRenamed("source", "share_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(ratio + 1e-12), F.lit(REPEATS))
    shares = shares.withColumn("whole", whole).withColumn("share", F.greatest(ratio - whole, F.lit(0.0)))
    shares = stored(shares, "shares")  # a row per source
    same_source = F.col("source").eqNullSafe(F.col("share_source"))
    drawable = (F.col("share") > 1e-12) & (F.col("size") > 0) & (F.col("whole") < REPEATS)
    # 53 bits of a hash, never 0 or 1.
    u = (F.shiftrightunsigned(F.xxhash64("tie", F.lit(seed)), 11) + 0.5) * F.lit(2.0**-53)
    units = sized.groupBy("tie", "source").agg(F.sum("size").alias("size")).withColumn("u", u)
    rows = units.join(shares, same_source).where(drawable).select("source", "tie", "size", _pareto_rank(F.col("share")).alias("rank"))
    rows = stored(rows, "ranks")
    need = F.col("target") - F.col("whole") * F.col("source_size")
    needs = shares.select(F.col("share_source").alias("source"), need.alias("need"))
    drawn = []
    for last in [False] * ROUNDS + [True]:
        needs = needs.where("need >= 0.5")
        takers = needs.select(F.col("source").alias("need_source"), "need")
        offered = rows.join(takers, F.col("source").eqNullSafe(F.col("need_source"))).where(
            "size < 2 * need" if last else "size <= need"
        )
        got = stored(_draw(offered.select(rows.columns), needs, last), "drawn")
        drawn.append(got)
        taken = rows.join(got, "tie").groupBy("source").agg(F.sum("size").alias("words"))
        taken = taken.withColumnRenamed("source", "taken_source")
        needs = needs.join(taken, F.col("source").eqNullSafe(F.col("taken_source")), "left")
        needs = stored(needs.select("source", (F.col("need") - F.coalesce("words", F.lit(0))).alias("need")), "needs")
        if last or needs.where("need >= 0.5").isEmpty():
            break
        rows = stored(rows.join(got, "tie", "left_anti"), "ranks")
    chosen = reduce(DataFrame.union, drawn).select("tie", F.lit(1).alias("extra"))
    out = sized.join(shares, same_source).join(chosen, "tie", "left")
    copies = (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("long")
    return out.select(
        "tie",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mix_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all columns.  Documents
    without words are kept once, as they take nothing."""
    times = mix(docs, seed).select("tie", F.when(F.col("size") > 0, F.col("copies")).otherwise(1).alias("times"))
    times = times.distinct().where("times > 0")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = docs.select(document_key(docs).alias("tie"), row).join(times, "tie")
    return keyed.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")
