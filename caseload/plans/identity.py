"""Document ids that stay (K1): an append-only table of the numbers given out.

Numbering a table anew at every build gives its documents other ids as soon as
one comes or goes.  Here a build numbers only the documents that have no number
yet: per diagnosis they follow the last number given, in the order of their
keys.  A document keeps its number, also while it is away.

``path/build=<n>/`` holds the numbers of build n and counts once it is complete
(``_SUCCESS``).  The new documents alone are sorted (``operators.ordinal``);
the next number of a diagnosis is a partial maximum, and the numbers are joined
by their keys, so a hot diagnosis is spread like any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.operators.ordinal import with_ordinal
from caseload.session import delete_path, hadoop_path, path_exists


def _builds(spark: SparkSession, path: str) -> dict[int, bool]:
    """build -> whether it is complete."""
    if not path_exists(spark, path):
        return {}
    fs, p = hadoop_path(spark, path)
    return {int(st.getPath().getName().removeprefix("build=")): bool(fs.exists(st.getPath().suffix("/_SUCCESS")))
            for st in fs.listStatus(p) if st.getPath().getName().startswith("build=")}


def given(spark: SparkSession, path: str, keys: Sequence[str] = ("practitioner",)) -> DataFrame:
    """``diagnosis, *keys, _id`` of every document that has a number."""
    schema = ", ".join(f"{c} string" for c in ("diagnosis", *keys)) + ", _id bigint"
    folders = [f"{path.rstrip('/')}/build={n}" for n, whole in sorted(_builds(spark, path).items()) if whole]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def with_lasting_id(rows: DataFrame, path: str, keys: Sequence[str] = ("practitioner",)) -> DataFrame:
    """``rows`` plus their ``_id``; those that have none yet get one first.
    A document is what the diagnosis and the keys name (none of them null):
    rows that repeat them share an id."""
    spark, own = rows.sparkSession, ["diagnosis", *keys]
    builds = _builds(spark, path)
    number = 1 + max((n for n, whole in builds.items() if whole), default=-1)
    known = given(spark, path, keys)
    new = rows.select(*own).distinct().join(known, own, "left_anti")
    last = known.groupBy("diagnosis").agg(F.max("_id").alias("_last"))
    numbered = with_ordinal(new, list(keys), ["diagnosis"]).join(last, "diagnosis", "left")
    target = f"{path.rstrip('/')}/build={number}"
    delete_path(spark, target)                                  # of a build that ended while it wrote this
    numbered.select(*own, (F.col("_id") + F.coalesce(F.col("_last") + 1, F.lit(0))).alias("_id")).write.parquet(target)
    return rows.join(given(spark, path, keys), own)
