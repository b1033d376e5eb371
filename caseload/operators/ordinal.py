"""Document ordinals (``_id``) without funnelling a group into one task.

A plain ``row_number() over (order by ...)`` moves every row into a single
partition, and ``partition by diagnosis`` moves a whole diagnosis -- possibly
a third of all rows -- into one task.  Instead:

1. range-partition and sort by ``(group..., order...)`` (``orderBy``: sampled
   bounds, evenly sized partitions, hot groups spread over several);
2. tag each row with ``monotonically_increasing_id()``, which encodes the
   partition index (upper 31 bits) and the position inside the sorted
   partition (lower 33 bits);
3. count rows per (partition, group) -- at most #partitions + #groups rows --
   and turn the counts into per-group offsets with a window over that tiny
   table;
4. ordinal = offset of the group in earlier partitions + position in this
   partition - first position of the group in this partition.

The tagged rows are read twice (counts and the final join), and the two
reads must see the same positions.  Re-deriving them is not safe: column
pruning gives each read its own upstream shuffles, whose sampled range bounds
can differ, and a recomputation after executor loss could differ too.  So the
tagged rows are materialised once with a reliable ``checkpoint()`` into the
shared checkpoint folder and both reads use that copy.

The offsets (at most #partitions + #groups rows) are written as a table, so
their size is known when the join is planned and Spark broadcasts them below
its own threshold: the checkpointed rows are then not moved again.  The join
is null-safe, so a null group is a group like any other.

The sort key must be a total order (ties would make positions depend on the
shuffle's arrival order); callers append tie-breaking columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseload.session import checkpoint_root, work_dir

_POS_BITS = 33


def with_ordinal(df: DataFrame, order_by: Sequence[str], group_by: Sequence[str] = (),
                 name: str = "_id") -> DataFrame:
    """``df`` plus a 0-based bigint ``name`` counting rows in ``order_by``
    order, restarting for every ``group_by`` group (global when empty)."""
    group_by, order_by = list(group_by), list(order_by)
    checkpoint_root(df.sparkSession)
    mid = F.monotonically_increasing_id()
    tagged = (df.orderBy(*group_by, *order_by)
                .withColumn("_mid", mid)
                .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
                .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
                .checkpoint(eager=True))
    counts = tagged.groupBy("_pid", *group_by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = (Window.partitionBy(*group_by).orderBy("_pid")
               .rowsBetween(Window.unboundedPreceding, -1)) if group_by else \
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    path = work_dir(df.sparkSession, "offsets")
    (counts.select(F.col("_pid").alias("_at"), *[F.col(c).alias(f"_at_{c}") for c in group_by], "_first",
                   F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before")).write.parquet(path))
    offsets = df.sparkSession.read.parquet(path)
    same = F.col("_pid") == F.col("_at")
    for c in group_by:
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    joined = tagged.join(offsets, same)
    return (joined.withColumn(name, (F.col("_before") + F.col("_pos") - F.col("_first")).cast("bigint"))
                  .select(*df.columns, name))
