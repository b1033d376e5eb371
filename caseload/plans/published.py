"""A published table: replaced diagnosis by diagnosis, switched at once (K2, K7).

Layout below ``path``::

    data/version=<n>-<attempt>/diagnosis=<d>/part-*.parquet   what one build wrote
    _manifests/<n>/part-*.parquet                             live version of each diagnosis

A build writes its rows into a version folder of its own and a manifest into a
folder that no reader looks at; then one atomic rename, which fails if number
``n`` is taken, makes the manifest the newest.  Until then readers see the old
table whole, afterwards the new one, and of two builds at the same time the
second fails instead of mixing with the first.  Readers resolve the newest
manifest first and keep reading the versions that it names: those of the last
``KEEP`` manifests stay, older ones and what crashed builds left go after the
switch.

An incremental build writes only the diagnoses it touches; all others stay in
the versions that hold them.  Once ``VERSIONS`` versions are live, a build
takes over the live diagnoses of all but the largest, so a read never opens
more, and a diagnosis is rewritten about once in that many builds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caseload.session import delete_path, hadoop_path, path_exists

#: Live versions of a table at most, and manifests whose versions stay for readers that began before a switch.
VERSIONS, KEEP = 16, 2
_MANIFEST = "diagnosis string, version string, of bigint"


def current(spark: SparkSession, path: str) -> int | None:
    """The number of the newest manifest."""
    return max(_numbers(spark, path), default=None)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in _folders(spark, f"{path.rstrip('/')}/_manifests") if name.isdigit())


def _folders(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    fs, p = hadoop_path(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)]


def manifest(spark: SparkSession, path: str, number: int) -> DataFrame:
    """``diagnosis, version, of``: the version that holds a diagnosis, and how many diagnoses that wrote."""
    return spark.read.schema(_MANIFEST).parquet(f"{path.rstrip('/')}/_manifests/{number}")


def _live(spark: SparkSession, path: str, number: int) -> dict[str, tuple[int, int]]:
    """version -> (diagnoses that are live, diagnoses it wrote): a row per version, VERSIONS at most."""
    found = manifest(spark, path, number).groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.max("of").alias("of"))
    return {r["version"]: (r["n"], r["of"]) for r in found.collect()}


def _versions(spark: SparkSession, path: str, names: list[str], schema: StructType) -> DataFrame:
    data = f"{path.rstrip('/')}/data"
    return (spark.read.schema(StructType([*schema.fields, StructField("version", StringType())]))
            .option("basePath", data).parquet(*[f"{data}/version={v}" for v in names]))


def read(spark: SparkSession, path: str, schema: StructType, but: list[str] = ()) -> DataFrame:
    """The table that is live now, without the versions in ``but``."""
    number = current(spark, path)
    if number is None:
        raise FileNotFoundError(f"no table is published at {path}")
    live = {v: n for v, n in _live(spark, path, number).items() if v not in but}
    whole = [v for v, (n, of) in live.items() if n == of]
    partly = [v for v in live if v not in whole]
    rows = spark.createDataFrame([], schema)
    if whole:
        rows = _versions(spark, path, whole, schema).select(*schema.names)
    if partly:
        of = manifest(spark, path, number).select(F.col("diagnosis").alias("_d"), F.col("version").alias("_v"))
        part = _versions(spark, path, partly, schema)
        part = part.join(of, (F.col("version") == F.col("_v")) & F.col("diagnosis").eqNullSafe(F.col("_d")), "left_semi")
        rows = rows.unionByName(part.select(*schema.names)) if whole else part.select(*schema.names)
    return rows


def publish(rows: DataFrame, path: str, touched: DataFrame | None = None, max_records_per_file: int | None = None) -> int:
    """Replace the table by ``rows``, or with ``touched`` (a table with a
    column ``diagnosis``) those diagnoses; gives the manifest's number.

    The ``rebalance`` hint shuffles by diagnosis, so each task writes few
    folders, and AQE splits a hot diagnosis over several tasks; unlike a range
    partitioning it needs no sampling pass over its input.
    """
    spark, root = rows.sparkSession, path.rstrip("/")
    before = current(spark, root)
    number = 0 if before is None else before + 1
    version = f"{number}-{uuid.uuid4().hex[:12]}"
    folder = f"{root}/data/version={version}"
    _write(rows, folder, "errorifexists", max_records_per_file)
    taken: list[str] = []
    if touched is not None and before is not None:
        gone = touched.select("diagnosis").unionByName(_diagnoses(spark, folder)).distinct()
        live = _live(spark, root, before)
        if len(live) >= VERSIONS:
            largest = max(live, key=lambda v: live[v])
            taken = [v for v in live if v != largest]
            moved = read(spark, root, rows.schema, but=[largest])
            _write(moved.join(gone, moved["diagnosis"].eqNullSafe(gone["diagnosis"]), "left_anti"), folder, "append",
                   max_records_per_file)
    new = _diagnoses(spark, folder).withColumn("version", F.lit(version))
    entries = new.withColumn("of", F.lit(new.count()).cast("bigint"))
    if touched is not None and before is not None:
        old = manifest(spark, root, before).where(~F.col("version").isin(taken) if taken else F.lit(True))
        entries = entries.unionByName(old.join(gone, old["diagnosis"].eqNullSafe(gone["diagnosis"]), "left_anti"))
    draft = f"{root}/_manifests/draft-{version}"
    entries.write.parquet(draft)
    _switch(spark, draft, f"{root}/_manifests/{number}")
    clean(spark, root)
    return number


def _write(rows: DataFrame, folder: str, mode: str, max_records_per_file: int | None) -> None:
    out = rows.hint("rebalance", "diagnosis").write.mode(mode)
    if max_records_per_file:
        out = out.option("maxRecordsPerFile", max_records_per_file)
    out.partitionBy("diagnosis").parquet(folder)


def _diagnoses(spark: SparkSession, folder: str) -> DataFrame:
    """The diagnoses of a version, from its folders' names."""
    return spark.read.schema("diagnosis string").parquet(folder).distinct()


def _switch(spark: SparkSession, draft: str, name: str) -> None:
    """Rename the draft to the name, which no other build may have taken."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    old, new = jvm.org.apache.hadoop.fs.Path(draft), jvm.org.apache.hadoop.fs.Path(name)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(old, new, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))


def clean(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove the manifests before the last ``keep``, the versions that none of
    these names, and drafts of builds that ended before their switch."""
    root = path.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers:
        return
    named = {v for n in numbers[-keep:] for v in _live(spark, root, n)}
    for n in numbers[:-keep]:
        delete_path(spark, f"{root}/_manifests/{n}")
    for folder, prefix, known in ((f"{root}/data", "version=", named), (f"{root}/_manifests", "draft-", set())):
        for name in _folders(spark, folder):
            version = name.removeprefix(prefix)
            # a version of a higher number is being written
            if name.startswith(prefix) and version not in known and int(version.split("-")[0]) <= numbers[-1]:
                delete_path(spark, f"{folder}/{name}")
