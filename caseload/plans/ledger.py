"""Which files have been folded (S3): a ledger next to the state.

``_ledger/batch=<n>`` lists the files of batch n: path, length, time.  It is
written whole before the batch is folded, so a run that ended early is found
-- its batch has no complete delta -- and repeated with the same files; the
delta of a batch replaces itself.  A folder may thus be given again and again:
files that are in the ledger are not folded twice, new ones become the next
batch.  A folded file that has changed since is an error, since its old lines
cannot be told from the new ones.

The listing is a DataFrame (no file is opened) and compared with the ledger by
an anti-join; the driver holds the new files of one batch, as it does to read
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.plans import state
from caseload.session import delete_path, hadoop_path, path_exists

LEDGER = "_ledger"
_FILES = "path string, length bigint, time timestamp"


def listing(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``path, length, time`` of every file below the folders."""
    if not folders:
        return spark.createDataFrame([], _FILES)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
            .select("path", "length", F.col("modificationTime").alias("time")))


def batches(spark: SparkSession, state_path: str) -> list[int]:
    """The batches that the ledger holds whole."""
    root = f"{state_path.rstrip('/')}/{LEDGER}"
    if not path_exists(spark, root):
        return []
    fs, p = hadoop_path(spark, root)
    return sorted(int(st.getPath().getName().removeprefix("batch=")) for st in fs.listStatus(p)
                  if st.getPath().getName().startswith("batch=") and fs.exists(st.getPath().suffix("/_SUCCESS")))


def folded(spark: SparkSession, state_path: str) -> DataFrame:
    """``batch, path, length, time`` of every file in the ledger."""
    if not batches(spark, state_path):
        return spark.createDataFrame([], f"batch int, {_FILES}")
    return spark.read.schema(f"{_FILES}, batch int").parquet(f"{state_path.rstrip('/')}/{LEDGER}")


def next_batch(spark: SparkSession, folders: list[str], state_path: str) -> tuple[int, list[str]]:
    """(batch id, its files): the last batch if it was not folded to the end,
    else all files that no batch has.  No files: there is nothing to do."""
    known = batches(spark, state_path)
    done = state.deltas(spark, state_path)
    upto = state.latest_snapshot(spark, state_path)
    if known and known[-1] not in done and (upto is None or known[-1] > upto):
        return known[-1], _paths(spark, state_path, known[-1])
    batch = 1 + max([*known, *done, -1 if upto is None else upto], default=-1)
    have = folded(spark, state_path)
    files = listing(spark, folders)
    changed = files.join(have, "path").where((files["length"] != have["length"]) | (files["time"] != have["time"]))
    if row := changed.select("path").first():
        raise ValueError(f"{row['path']} has changed since it was folded")
    target = f"{state_path.rstrip('/')}/{LEDGER}/batch={batch}"
    delete_path(spark, target)                                  # of a run that ended while it wrote this
    files.join(have, "path", "left_anti").write.parquet(target)
    return batch, _paths(spark, state_path, batch)


def forget(spark: SparkSession, state_path: str, batch: int) -> None:
    """Drop a batch that has no files."""
    delete_path(spark, f"{state_path.rstrip('/')}/{LEDGER}/batch={batch}")


def _paths(spark: SparkSession, state_path: str, batch: int) -> list[str]:
    rows = spark.read.schema(_FILES).parquet(f"{state_path.rstrip('/')}/{LEDGER}/batch={batch}").select("path").collect()
    return sorted(r["path"] for r in rows)
