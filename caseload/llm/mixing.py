"""Mixing sources to target weights.

Tokens (words) are summed per source, a repetition rate follows from the
source's target, and every document is emitted ``floor(rate)`` times plus one
hash-seeded Bernoulli copy whose probability is the rate's fraction.

Plan: one scan derives the narrow rows (id, source, size, hash) which are
written once.  All per-source work runs on partial aggregates, so a source
with a third of the rows shuffles one row per task.  The per-source table (one
row per source) is what the documents are joined with; Spark broadcasts it
only below its own size threshold and splits a hot source's rows otherwise.

Edge cases: a null source is a source of its own and comes last; a null text
has size 0; a source without words has target 0 and no copies; repeated rows
are documents of their own that draw alike (the draw hangs on ``doc_id``
alone); an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseload.llm.common import whole_text, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: Draws per document; each source takes the one whose total comes nearest to its target.
ROTATIONS = 16
#: A draw is a number of so many bits.
DRAW_BITS = 48


def _draw() -> Column:
    """A number below 2 ** DRAW_BITS from a digest of the id."""
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return F.conv(F.substring(key, 1, DRAW_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, draw) of every document."""
    return docs.select("doc_id", "source", word_count(whole_text()).alias("size"), _draw().alias("draw"))


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt by weight,
    a target stopping at ``cap`` times its source, the excess dealt again.

    Sources are filled in the order of cap per weight: the first source that
    the water level leaves below its cap fixes the level of all later ones.
    The windows see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    per = per.withColumn("weight", weight).withColumn("limit", cap * F.col("source_size"))
    every = Window.partitionBy()
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = ((share * F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    per = per.withColumn("level", level).withColumn("full", F.col("limit") / F.col("weight") <= F.col("level"))
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    return per.select("source", "source_size",
                      F.when(F.col("full"), F.col("limit").cast("double"))
                      .otherwise(final * F.col("weight")).alias("target"))


def _copies(rotation: Column) -> Column:
    """floor(rate) plus the Bernoulli copy of the given rotation of the draw."""
    top = 1 << DRAW_BITS
    turned = (F.col("draw") + rotation * F.lit(top // ROTATIONS)) % F.lit(top)
    frac = F.col("rate") - F.floor("rate")
    return F.floor("rate") + F.when(turned < frac * F.lit(float(top)), 1).otherwise(0)


def rates(sizes: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """(source, source_size, target, rate, rotation): one row per source.

    A rotation shifts all draws of a source by the same amount, so any
    rotation draws each document with the same probability; the one whose
    words come nearest to the target is kept (the smallest of equals).
    """
    goal = targets(sizes, weights, share, cap).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    goal = written(goal, "mix-targets")
    drawn = sizes.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).select(
        "d.source", "size", "draw", "rate", "target")
    sums = drawn.groupBy("source", "target", "rate").agg(
        *[F.sum(F.col("size") * _copies(F.lit(j))).alias(f"t{j}") for j in range(ROTATIONS)])
    misses = F.array(*[F.struct(F.abs(F.col(f"t{j}") - F.col("target")), F.lit(j)) for j in range(ROTATIONS)])
    best = sums.select(F.col("source").alias("s"), F.array_min(misses)["col2"].alias("rotation"))
    return goal.join(best, goal["source"].eqNullSafe(best["s"])).drop("s")


def taken(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    sizes = written(sized(docs), "mix-sizes")
    per = written(rates(sizes, **how), "mix-rates")
    return sizes.alias("d").join(per.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * _copies(F.col("rotation"))).cast("long").alias("taken"),
        _copies(F.col("rotation")).cast("int").alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, one row per copy taken."""
    per = written(rates(written(sized(docs), "mix-sizes"), **how), "mix-rates").select(
        F.col("source").alias("__source"), "rate", "rotation")
    names = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col("source").alias("__s"),
                      _draw().alias("draw"))
    joined = own.join(per, own["__s"].eqNullSafe(per["__source"]))
    copies = joined.select(
        "__row", F.explode(F.array_repeat(F.lit(1), _copies(F.col("rotation")).cast("int"))).alias("__copy"))
    return copies.select(*[F.col("__row")[c].alias(c) for c in names])
