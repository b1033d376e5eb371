"""Running totals as an append-only delta table.

Layout below ``path``::

    batch_id=<n>/attempt=<k>/diagnosis=<d>/part-*.parquet   one delta per folded batch
    _snapshots/over=<m>-<n>/diagnosis=<d>/...               compacted sum of the batches m to n
    _practitioners/part-*.parquet                           practitioners that the last whole run served

A batch is written into a new attempt folder and counts once that folder is
complete (``_SUCCESS``); only then are its older attempts removed.  So a
replayed batch (at-least-once ``foreachBatch``, a re-run job) replaces its
delta, and readers see the old or the new delta whole, never a part and never
neither.  Reading sums the complete snapshots and the deltas above them.
Snapshots are tiered: a compaction folds the deltas and those snapshots just
before them that span no more batches than what is folded so far, like the
carries of a binary counter.  So there are at most about log2(batches)
snapshots, and a batch is rewritten as often: rewriting n batches costs n log n.
A batch that a snapshot already holds cannot be replaced: writing it again is
an error, or -- for a stream, which only ever repeats itself -- a no-op.
``diagnosis`` is a partition column: one diagnosis slice is read by partition
pruning.  Everything is distributed Parquet; the driver lists folders, one per
batch since the last snapshot.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from caseload.session import delete_path, hadoop_path, path_exists

SNAPSHOTS = "_snapshots"
PRACTITIONERS = "_practitioners"


def merge_counts(old: DataFrame, new: DataFrame, keys, metric: str) -> DataFrame:
    """Union of two totals, summed per key."""
    return fold([old, new], keys, metric)


def fold(parts, keys, metric: str) -> DataFrame:
    """Fold any number of totals into one: a union and a single aggregation,
    whatever their number."""
    keys = list(keys)
    rows = reduce(DataFrame.unionByName, [p.select(*keys, metric) for p in parts])
    return rows.groupBy(*keys).agg(F.sum(metric).cast("bigint").alias(metric))


def _schema(keys, metric: str) -> StructType:
    return StructType([*[StructField(k, StringType()) for k in keys if k != "diagnosis"],
                       StructField(metric, LongType()), StructField("diagnosis", StringType())])


def _numbered(spark: SparkSession, path: str, prefix: str, complete: bool = False) -> dict[int, str]:
    """number -> folder of the folders ``<prefix><number>`` below ``path``."""
    if not path_exists(spark, path):
        return {}
    fs, p = hadoop_path(spark, path)
    out = {}
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(prefix) and (not complete or fs.exists(st.getPath().suffix("/_SUCCESS"))):
            out[int(name.removeprefix(prefix))] = st.getPath().toString()
    return out


def append_delta(spark: SparkSession, totals: DataFrame, path: str, batch_id: int,
                 replay: bool = False) -> bool:
    """K1: write ``totals`` as the delta of ``batch_id``, in place of an older one.

    Rebalanced by diagnosis first (AQE splits a hot diagnosis over several
    tasks and merges small partitions), so each task writes few folders.
    Returns False if a snapshot already holds the batch and ``replay`` says
    that the totals are the same; without ``replay`` that is an error.
    """
    root = path.rstrip("/")
    upto = latest_snapshot(spark, root)
    if upto is not None and batch_id <= upto:
        if replay:
            return False
        raise ValueError(f"batch {batch_id} is part of the snapshot up to {upto} and cannot be replaced")
    target = f"{root}/batch_id={int(batch_id)}"
    older = _numbered(spark, target, "attempt=")
    attempt = max(older, default=-1) + 1
    (totals.hint("rebalance", "diagnosis").write.mode("errorifexists")
           .partitionBy("diagnosis").parquet(f"{target}/attempt={attempt}"))
    for folder in older.values():
        delete_path(spark, folder)
    return True


def snapshots(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    """(first batch, last batch) -> folder of the complete snapshots, without
    those whose batches a larger one holds (left by a crash in a compaction)."""
    root = f"{path.rstrip('/')}/{SNAPSHOTS}"
    found = {}
    if path_exists(spark, root):
        fs, p = hadoop_path(spark, root)
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("over=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
                first, last = name.removeprefix("over=").split("-")
                found[int(first), int(last)] = st.getPath().toString()
    return {(a, b): f for (a, b), f in sorted(found.items())
            if not any(x <= a and b <= y and (x, y) != (a, b) for x, y in found)}


def latest_snapshot(spark: SparkSession, path: str) -> int | None:
    """The last batch that a snapshot holds."""
    return max((last for _, last in snapshots(spark, path)), default=None)


def parts(spark: SparkSession, path: str) -> dict[int, str]:
    """last batch -> folder of every snapshot and every delta above them, in order."""
    found = {last: f for (_, last), f in snapshots(spark, path).items()} | deltas(spark, path)
    return dict(sorted(found.items()))


def deltas(spark: SparkSession, path: str) -> dict[int, str]:
    """batch_id -> folder of its newest complete delta, above the newest snapshot."""
    root = path.rstrip("/")
    upto = latest_snapshot(spark, root)
    out = {}
    for batch, folder in _numbered(spark, root, "batch_id=").items():
        attempts = _numbered(spark, folder, "attempt=", complete=True)
        if attempts and (upto is None or batch > upto):
            out[batch] = attempts[max(attempts)]
    return out


def read_delta(spark: SparkSession, folder: str, keys, metric: str) -> DataFrame:
    return spark.read.schema(_schema(list(keys), metric)).parquet(folder)


def read_totals(spark: SparkSession, path: str, keys, metric: str,
                diagnosis: str | None = None, only: DataFrame | None = None) -> DataFrame:
    """Current totals = snapshots + newer deltas, summed.

    ``diagnosis`` reads one slice, ``only`` (a table with a column
    ``diagnosis``) the slices it names; both prune partitions.
    """
    keys = list(keys)
    rows = [read_delta(spark, f, keys, metric) for f in parts(spark, path).values()]
    if not rows:
        return spark.createDataFrame([], _schema(keys, metric)).select(*keys, metric)
    if diagnosis is not None:
        rows = [p.where(F.col("diagnosis") == F.lit(diagnosis)) for p in rows]
    if only is not None:
        rows = [p.join(only.select("diagnosis"), "diagnosis", "left_semi") for p in rows]
    return fold(rows, keys, metric)


def diagnoses_of(spark: SparkSession, path: str, keys, metric: str, practitioners: DataFrame | None = None) -> DataFrame:
    """The diagnoses stored for the given practitioners, or all."""
    keys = list(keys)
    rows = [read_delta(spark, f, keys, metric).select("practitioner", "diagnosis") for f in parts(spark, path).values()]
    if practitioners is not None:
        rows = [p.join(practitioners.select("practitioner"), "practitioner", "left_semi") for p in rows]
    return reduce(DataFrame.unionByName, [p.select("diagnosis").distinct() for p in rows]).distinct()


def served_practitioners(spark: SparkSession, path: str) -> DataFrame | None:
    """The practitioners that the last run joined; None before the first run
    and after one that did not end."""
    folder = f"{path.rstrip('/')}/{PRACTITIONERS}"
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        return None
    return spark.read.schema("practitioner string, full_name string, email string, hospital string").parquet(folder)


def keep_practitioners(practitioners: DataFrame, path: str) -> None:
    """Store the practitioners that the served table now has."""
    practitioners.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{PRACTITIONERS}")


def forget_practitioners(spark: SparkSession, path: str) -> bool:
    """Before the served table changes: if the run fails, the next one serves every diagnosis anew."""
    return delete_path(spark, f"{path.rstrip('/')}/{PRACTITIONERS}")


def compact(spark: SparkSession, path: str, keys, metric: str,
            merge: Callable[[dict[int, DataFrame]], DataFrame] | None = None) -> int | None:
    """K5: fold every delta, and the snapshots that their number carries over
    to, into one snapshot; then drop what it replaced.

    ``merge`` makes one table of the parts, given by their last batches; they
    are summed by default.  The new snapshot is complete (``_SUCCESS``) before
    anything old is removed, and the parts it holds are passed over as soon as
    it is, so a crash at any point leaves readable state.
    """
    root = path.rstrip("/")
    new = deltas(spark, root)
    if not new:
        return latest_snapshot(spark, root)
    first, last, folded = min(new), max(new), dict(new)
    known = snapshots(spark, root)
    for a, b in sorted(known, reverse=True):
        if b - a > last - first:
            break
        first, folded[b] = a, known[a, b]
    rows = {batch: read_delta(spark, f, keys, metric) for batch, f in sorted(folded.items())}
    totals = fold(list(rows.values()), keys, metric) if merge is None else merge(rows)
    (totals.hint("rebalance", "diagnosis")
           .write.mode("overwrite").partitionBy("diagnosis").parquet(f"{root}/{SNAPSHOTS}/over={first}-{last}"))
    for batch, folder in _numbered(spark, root, "batch_id=").items():
        if batch <= last:
            delete_path(spark, folder)
    fs, p = hadoop_path(spark, f"{root}/{SNAPSHOTS}")
    for st in fs.listStatus(p):
        a, b = map(int, st.getPath().getName().removeprefix("over=").split("-"))
        if first <= a and b <= last and (a, b) != (first, last):
            delete_path(spark, st.getPath().toString())
    return last


def clear(spark: SparkSession, path: str) -> bool:
    """K6: drop the whole state table."""
    return delete_path(spark, path)
