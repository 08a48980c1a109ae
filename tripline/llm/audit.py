"""Filter interaction audit by the Hart-Mas-Colell potential.

Filters that drop documents form a game: a coalition S of filters removes v(S) documents, those
that fail any of its filters. Documents are reduced to a mask of the filters they fail and counted
by part and mask; v follows for all coalitions from these few counts. The potential is defined by
recursion, P(S) = (v(S) + sum over i in S of P(S without i)) / |S|, and the Shapley value of filter
i, its mean removal over all orders, is P(all) - P(all without i). A step of an order that applies
filter i after the filters S removes v(S with i) - v(S): every step of every order is a difference
of two coalitions, and no order is ever run over the documents.
"""

from __future__ import annotations

import json
import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WORD_GAP = "[\\x20\\x09-\\x0D]+"
#: The filters of ``failures`` and, last, the one for repeated texts.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT = 50, 65, 5
#: What is counted of the documents a coalition removes.
MEASURES = ("n", "good", "toxic")
#: Values a null key is dealt out by, so that the rows without a key do not meet in one task.
SPREAD = 1009


def failures(text: Column) -> dict[str, Column]:
    """Conditions under which a text (not null) fails a filter, by the filter's letter.

    A: few words; B: few of them different; C: many capital letters; D: signs of markup.
    """
    words = F.array_remove(F.split(text, WORD_GAP), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < MIN_WORDS,
        "B": 100 * n_distinct < MIN_DISTINCT_PERCENT * n_words,
        "C": 100 * capitals.cast("long") > MAX_CAPITALS_PERCENT * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def mask_counts(
    docs: DataFrame,
    labels: DataFrame,
    conditions: dict[str, Column] | None = None,
    text: str = "text",
    key: str = "doc_id",
    part: str = "source",
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and by the filters they fail.

    Bit i of ``mask`` is the i-th of ``conditions`` and the bit after them tells a text identical
    to that of a row with a smaller key anywhere in the table. Texts are read once, where they lie;
    a row of them is its SHA-256, key, part and mask. Rows are counted by key first and by text
    second, both with partial sums, so a text that a third of all rows share is a row per task.
    Whether a text is a repeat then needs only the least key of it.

    A null text counts as an empty one, a null part as the empty string. Null keys are smaller
    than none and have no smaller one; they match no label. Rows with the smallest key of a text
    are no repeats, all of them if that row is repeated. Of several labels of one key any that says
    1 counts. An empty table gives no rows. Other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    conditions = failures(whole) if conditions is None else conditions
    mask = F.lit(0)
    for bit, failed in enumerate(conditions.values()):
        mask = mask + F.when(failed, 1 << bit).otherwise(0)
    spread = F.when(F.col(key).isNull(), F.monotonically_increasing_id() % SPREAD).otherwise(0)
    rows = docs.select(
        F.col(key).alias("id"),
        spread.alias("spread"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"),
    )
    told = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    told = told.withColumn("spread", F.lit(0).cast("long"))
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    flagged = rows.join(told, ["id", "spread"], "left").select(*rows.columns, *flags)
    by_key = flagged.groupBy("id", "spread", "digest", "part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    by_text = by_key.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("id").alias("least"),
        F.min_by("n", "id").alias("n_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )
    # One row for each part and label of a text, however many documents have it.
    first = F.col("least") == F.min("least").over(W.partitionBy("digest"))
    single = F.col("n_null") + F.when(first, F.col("n_least")).otherwise(0)
    repeated = F.lit(1 << len(conditions))
    both = F.array(
        F.struct(F.col("mask"), F.col("single").alias("n")),
        F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - F.col("single")).alias("n")),
    )
    counted = by_text.withColumn("single", single).select("part", "good", "toxic", F.inline(both)).where("n > 0")

    def those(flag: str) -> Column:
        return F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).alias(flag)

    return counted.groupBy("part", "mask").agg(those("good"), those("toxic"), F.sum("n").alias("n"))


def coalition_values(counts: DataFrame, n_filters: int) -> DataFrame:
    """``(part, n, good, toxic)``: what every coalition removes, an array by its bit mask."""
    def removed(measure: str) -> Column:
        sums = (f"sum(if((mask & {s}) <> 0, {measure}, 0))" for s in range(1 << n_filters))
        return F.expr(f"array({', '.join(sums)})").alias(measure)

    arrays = [removed(m) for m in MEASURES]
    return counts.groupBy("part").agg(F.sum("n").alias("all"), *arrays)


def scale(n_filters: int) -> int:
    """A multiple of all denominators of the potential, which are sizes of coalitions."""
    return math.lcm(*range(1, n_filters + 1))


def potentials(values: DataFrame, n_filters: int, measure: str = "n") -> DataFrame:
    """``values`` with ``potential``, an array by coalition, times ``scale(n_filters)``: integers.

    One select a level: the coalitions of k filters follow from those of k - 1.
    """
    out = values.withColumn("p0", F.lit(0).cast("long"))
    for size in range(1, n_filters + 1):
        level = []
        for s in (s for s in range(1 << n_filters) if s.bit_count() == size):
            smaller = " + ".join(f"p{s ^ 1 << i}" for i in range(n_filters) if s >> i & 1)
            level.append(F.expr(f"({scale(n_filters)} * {measure}[{s}] + {smaller}) div {size}").alias(f"p{s}"))
        out = out.select("*", *level)
    every = [f"p{s}" for s in range(1 << n_filters)]
    return out.withColumn("potential", F.array(*every)).drop(*every)


def steps(values: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every step of every order of the filters, by part, from ``coalition_values``.

    ``kept`` after the step, ``removed`` by it, ``redundant``: failing its filter but removed
    before, ``unique_fails``: failing no other filter, ``good_lost`` and ``toxic_lost``: removed by
    it and labelled so, ``shapley``: removed by its filter, over all orders.
    """
    n, bit = len(filters), {name: 1 << i for i, name in enumerate(filters)}
    everything = (1 << n) - 1
    walk = []
    for order in map("".join, permutations(filters)):
        before = 0
        for step, name in enumerate(order, 1):
            walk.append({"filter_order": order, "step": step, "own": bit[name], "before": before})
            before |= bit[name]
    kind = "array<struct<filter_order: string, step: int, own: int, before: int>>"
    rows = potentials(values, n).select("*", F.inline(F.from_json(F.lit(json.dumps(walk)), kind)))

    def gained(measure: str) -> str:
        return f"({measure}[before | own] - {measure}[before])"

    orders = math.factorial(n) // scale(n)
    columns = {
        "kept": "all - n[before | own]",
        "removed": gained("n"),
        "redundant": f"n[own] - {gained('n')}",
        "unique_fails": f"n[{everything}] - n[{everything} ^ own]",
        "good_lost": gained("good"),
        "toxic_lost": gained("toxic"),
        "shapley": f"{orders} * (potential[{everything}] - potential[{everything} ^ own])",
    }
    return rows.select(
        "part", "filter_order", "step", *(F.expr(e).cast("long").alias(name) for name, e in columns.items())
    )


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """All orders of the five filters over ``docs``: the rows of ``steps``, 600 a part.

    Edge cases are those of ``mask_counts``.
    """
    counts = mask_counts(docs, labels, **columns)
    return steps(coalition_values(counts, len(FILTERS)))
