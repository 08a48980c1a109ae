"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, -ln(u) / weight, u from a hash of its id. A source's
target is met by complete epochs first, each taking all its documents; what is left is filled
by the documents with the smallest keys, their sizes summed in key order up to the budget.

The sum in key order is taken in two steps, so that no task holds a source: sizes are added
up by key ranges, the range in which the budget runs out is found from those sums, and only
that range is sorted. What a document is given then depends on its own key and on one row for
its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripline.llm.common import staged

SIZE_PATTERN = "[^\\x20\\x09-\\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix per word of all sources, and most epochs of one source.
SHARE, MOST_EPOCHS = 1.5, 2
SEED = "mix"
#: Documents of a key range; only one range of a source is sorted.
RANGE_ROWS = 50_000
#: Sources, or labels, up to which their table is broadcast; beyond, they are joined by shuffle.
BROADCAST_ROWS = 500_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a narrow table only after counting that it has few rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def quality_weights(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``mix_weight``: 2 for labelled good, 0.5 for labelled bad, else 1.

    A column of that name is replaced.
    """
    best = labels.groupBy(F.col(key).alias("__key")).agg(F.max("quality").alias("__quality"))
    best = bounded(best.where(F.col("__key").isNotNull()))
    quality = F.col("__quality")
    weight = F.when(quality == 1, 2.0).when(quality == 0, 0.5).otherwise(1.0)
    joined = docs.join(best, docs[key] == best["__key"], "left")
    return joined.withColumn("mix_weight", weight).drop("__key", "__quality")


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, size, target)`` from ``(source, size)``: the budget shared by weight.

    Where a share would pass ``MOST_EPOCHS`` times a source's size it stops there and the rest
    is shared again. The level (words per unit of weight) at which that ends is found directly:
    in the order of limit by weight, the level that holds if all before a source are at their
    limits rises until the rest can take their shares and falls after; its maximum is the one.
    One row per source passes through these windows.
    """
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(place, F.lit(len(WEIGHTS))) + 1)
    ranked = sizes.withColumn("w", weight).withColumn("most", MOST_EPOCHS * F.col("size"))
    ranked = ranked.withColumn("budget", SHARE * F.sum("size").over(everything))
    ranked = ranked.withColumn("all_w", F.sum("w").over(everything))
    order = W.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    held, held_w = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("most", "w"))
    ranked = ranked.withColumn("level", (F.col("budget") - held) / (F.col("all_w") - held_w))
    ranked = ranked.withColumn("final", F.max("level").over(everything))
    target = F.least(F.col("most").cast("double"), F.col("final") * F.col("w"))
    return ranked.select("source", "size", target.alias("target"))


def mix(
    docs: DataFrame,
    weight: Column | None = None,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``(row, mix)``: every row of ``docs`` whole, and size, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the whole document and ``taken`` is copies times
    size. The document at which the budget runs out is taken if that comes nearer to the
    target than leaving it. The same rows give the same mix, however they are partitioned.

    Null or empty text has size 0; a null source is a source of its own, last in order. Rows
    that agree in key, source and size are one unit of the order: all or none. A null key
    draws by the text instead. A null or non-positive weight counts as 1. An empty table gives
    no rows.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(SIZE_PATTERN)), F.lit(0)).cast("long")
    name = F.coalesce(F.col(key).cast("string"), F.md5(F.col(text)), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{SEED}|"), name)), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    weighs = F.lit(1.0) if weight is None else F.when(weight > 0, weight).otherwise(1.0)
    drawn = F.struct(
        size.alias("size"),
        (-F.log(u) / weighs).alias("draw"),
        name.alias("tie"),
    )
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(F.col(source).alias("source"), drawn.alias("own"), whole)
    narrow = staged(rows.select("source", "own.*"), "mix")
    sources = narrow.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    spread = F.greatest(F.lit(1), F.ceil(F.col("n") / range_rows)).cast("long").alias("ranges")
    plan = targets(sources.select("source", "size")).withColumnRenamed("source", "s")
    plan = sources.join(plan.select("s", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    epochs = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("long")
    plan = plan.select("source", "size", "target", spread, epochs.alias("epochs"))
    plan = plan.withColumn("left", F.col("target") - F.col("epochs") * F.col("size"))
    plan = staged(plan.withColumnsRenamed({"source": "of", "size": "source_size"}), "mix_sources")
    side = bounded(plan)

    ranged = narrow.join(side, F.col("source").eqNullSafe(F.col("of")))
    in_range = F.floor((1 - F.exp(-F.col("draw"))) * F.col("ranges"))
    ranged = ranged.withColumn("range", F.least(in_range, F.col("ranges") - 1))
    sums = ranged.groupBy("of", "left", "range").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(
        W.partitionBy("of").orderBy("range").rowsBetween(W.unboundedPreceding, W.currentRow)
    ) - F.col("words")
    cut = sums.withColumn("before", before).where("before < left and before + words >= left")
    cut = cut.groupBy("of").agg(F.min("range").alias("cut_range"), F.min("before").alias("before"))
    cut = cut.withColumnRenamed("of", "cut_of")
    last = ranged.join(
        bounded(cut), F.col("of").eqNullSafe(F.col("cut_of")) & (F.col("range") == F.col("cut_range"))
    )
    units = last.groupBy("of", "left", "before", "cut_range", "draw", "tie").agg(F.sum("size").alias("size"))
    upto = F.col("before") + F.sum("size").over(
        W.partitionBy("of").orderBy("draw", "tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    units = units.withColumn("upto", upto)
    fits = (F.col("upto") <= F.col("left")) | (F.col("upto") - F.col("left") <= F.col("left") - (F.col("upto") - F.col("size")))
    cut_at = F.max(F.when(fits, F.struct("draw", "tie")))
    cuts = units.groupBy("of", "cut_range").agg(cut_at.alias("cut")).withColumnRenamed("of", "cut_of")
    plan = plan.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left").drop("cut_of")
    side = bounded(staged(plan, "mix_plan").select(F.struct("*").alias("plan")))

    joined = rows.join(side, F.col("source").eqNullSafe(F.col("plan.of")))
    draw = F.col("own.draw")
    where = F.least(F.floor((1 - F.exp(-draw)) * F.col("plan.ranges")), F.col("plan.ranges") - 1)
    chosen = (where < F.col("plan.cut_range")) | (
        (where == F.col("plan.cut_range"))
        & (F.struct(draw.alias("draw"), F.col("own.tie").alias("tie")) <= F.col("plan.cut"))
    )
    copies = F.col("plan.epochs") + F.when(chosen, 1).otherwise(0)
    out = F.struct(
        F.col("own.size"),
        F.col("plan.source_size"),
        F.col("plan.target"),
        copies.alias("copies"),
        (copies * F.col("own.size")).alias("taken"),
    )
    return joined.select("row", out.alias("mix"))


def mixed(docs: DataFrame, weight: Column | None = None, **columns: str) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns as they were.

    The column ``mix_weight`` of ``quality_weights`` is left out.
    """
    taken = mix(docs, weight, **columns).where("mix.copies > 0")
    each = F.explode(F.array_repeat(F.lit(0), F.col("mix.copies").cast("int")))
    return taken.select("row", each.alias("copy")).select("row.*").drop("mix_weight")
