"""Session helpers: one place for the configuration the engine relies on.

Scale notes (100 TB of encounter text on ~1000 executors):

* ``spark.sql.shuffle.partitions`` is only the *upper* bound under AQE; the
  adaptive coalescer merges small post-shuffle partitions.  At full scale set
  it so that one partition of the widest shuffle (the patient-case shuffle,
  about one row per encounter) stays below ~200 MB, e.g. 8000-20000.
* ``spark.sql.files.maxPartitionBytes`` keeps text splits at 128 MB; NDJSON
  must stay uncompressed or use a splittable codec to be split at all.
* ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is 16 MB unless the user
  names another size: AQE merges partitions up to it, and what a task sorts or
  aggregates is some twenty times its compressed shuffle bytes.  With Spark's
  64 MB a task holds over a gigabyte of parsed rows once the input is large.
  AQE only merges, so a shuffle begins with as many partitions as that size
  calls for (``bound_tasks``); with ``spark.sql.shuffle.partitions`` alone they
  would grow with the input once that number is too small.
* Skewed keys: partial aggregation collapses hot keys map-side; AQE skew join
  splits hot join partitions.
* Broadcasts: Spark broadcasts a side only when its size estimate (static
  statistics, or the materialised shuffle size under AQE) is below the
  broadcast threshold and sort-merges otherwise.  There are no hints.
* State stores of streams are RocksDB: their size is bounded by disk, not heap.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

TASK_BYTES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SET_HERE = "caseload.initialPartitionNum"

#: Compressed bytes of the widest shuffle for each byte of input tables, at most (up to 1.8 measured, tables of the read columns only).
SHUFFLED = 4

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    TASK_BYTES[0]: TASK_BYTES[1],
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "caseload", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` / ``shuffle_partitions`` default to ``local[$CASELOAD_CPUS]``
    style values only when given; on a cluster leave them ``None`` so the
    submitting environment decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def bound_tasks(spark: SparkSession, input_bytes: int = 0) -> None:
    """Small shuffle partitions in a session of others, unless it names their
    size; and for that many bytes of input as many to begin with as keep them
    that small, unless it names their number."""
    if spark.conf.get(TASK_BYTES[0], None) is None:
        spark.conf.set(*TASK_BYTES)
    ours = spark.conf.get(_SET_HERE, None)
    if spark.conf.get(FIRST_PARTITIONS, None) != ours:
        return
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(TASK_BYTES[0]))
    needed = math.ceil(SHUFFLED * input_bytes / size)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(FIRST_PARTITIONS, str(needed))
        spark.conf.set(_SET_HERE, str(needed))
    elif ours is not None:
        spark.conf.unset(FIRST_PARTITIONS)
        spark.conf.unset(_SET_HERE)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Uses the directory the cluster names in ``spark.checkpoint.dir`` (or one
    already set on the context).  Only in local mode, where driver and
    executors are one process, a fresh local folder stands in for it; on a
    cluster executors would each write to their own disk, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="caseload-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def work_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder below the checkpoint root (never reused).

    The folders of a session lie in one folder, which the session owns: it is
    removed when the driver's JVM ends (``clear_work`` removes it earlier).
    """
    return f"{_session_work(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def _session_work(spark: SparkSession) -> str:
    path = f"{checkpoint_root(spark).rstrip('/')}/work/{spark.sparkContext.applicationId}"
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return path


def clear_work(spark: SparkSession) -> bool:
    """Remove every work folder of this session; tables read from them are gone."""
    return delete_path(spark, _session_work(spark))


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) for ``path`` using the session's Hadoop config."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively remove ``path`` (a state table being cleared)."""
    fs, p = hadoop_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files at or below ``path`` (metadata only); 0 if there is none."""
    fs, p = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def list_files(spark: SparkSession, path: str) -> list[str]:
    """All data files below ``path`` (metadata only, nothing is read)."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith(("_", ".")):
            out.append(st.getPath().toString())
    return sorted(out)

