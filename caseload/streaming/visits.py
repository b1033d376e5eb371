"""Structured Streaming over arriving encounter files.

T1 ``visit_counts``: a streaming aggregation (state store keyed by
practitioner/diagnosis, checkpointed) in ``update`` mode.  Each micro-batch's
updated totals are written by ``foreachBatch`` as a delta of that batch
(``plans.state`` layout); the current total of a key is the value from its
latest batch.  A replayed batch replaces its own delta, so output is
exactly-once.  Give the session the RocksDB state store (``session.DEFAULT_CONF``):
the pairs then live on disk, not on the heap.

T2 ``patient_cases``: distinct patients cannot be counted by a streaming
aggregation without event time (``count(distinct)`` is rejected and nested
aggregations need watermarks), and a ``collect_set`` of patients would grow
state with every patient.  Instead each micro-batch computes its cases per
(practitioner, diagnosis, patient) and appends them to the delta state table
(``plans.state``) under its batch id; patients and visits are derived on
read.  Idempotent for the same reason as T1.  ``run_served`` goes on to the
served table, and both can set malformed lines aside batch by batch.

A run without a checkpoint numbers its batches from 0 again, and files may
fall into other batches than before; so it refuses to write next to what an
earlier run left, unless ``fresh=True`` says to clear that first.

Both take all files that are there, or ``max_files_per_trigger`` at a time
(one file per batch reproduces folding file by file), and run with
``availableNow`` for bounded catch-up, or any other trigger for a long-running
job; every ``compact_every`` batches the deltas are folded into a snapshot, so
neither the folders nor the reads grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.operators import aggregate, extract
from caseload.plans import job, state
from caseload.session import delete_path, path_exists
from caseload.sources import lines as line_src

COMPACT_EVERY = 20


def _lines(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(input_dir).select("value", F.col("_metadata.file_path").alias("file_path"))


def _start(spark: SparkSession, checkpoint: str, out: str, fresh: bool) -> None:
    if path_exists(spark, checkpoint):
        return
    if path_exists(spark, out):
        if not fresh:
            raise ValueError(f"{out} holds the output of another run, but there is no checkpoint at {checkpoint}; "
                             "pass fresh=True to clear it")
        delete_path(spark, out)


def run_visit_counts(spark: SparkSession, input_dir: str, checkpoint: str, sink: str,
                     max_files_per_trigger: int | None = None, trigger: dict | None = None,
                     on_malformed: str = "quarantine", fresh: bool = False, compact_every: int = COMPACT_EVERY):
    """Start (and, with the default ``availableNow`` trigger, finish) the
    running visit count; returns the finished ``StreamingQuery``."""
    _start(spark, checkpoint, sink, fresh)
    counts = aggregate.visit_counts(
        extract.encounters(_lines(spark, input_dir, max_files_per_trigger), on_malformed))

    def write_batch(df: DataFrame, batch_id: int) -> None:
        state.append_delta(spark, df, sink, batch_id, replay=True)
        if batch_id % compact_every == compact_every - 1:
            compact_visit_counts(spark, sink)

    q = (counts.writeStream.outputMode("update")
               .option("checkpointLocation", checkpoint)
               .foreachBatch(write_batch)
               .trigger(**(trigger or {"availableNow": True}))
               .start())
    if not trigger:
        q.awaitTermination()
    return q


PAIR = ["practitioner", "diagnosis"]


def _latest(parts: dict[int, DataFrame]) -> DataFrame:
    """Per key, the count of its latest part."""
    rows = reduce(DataFrame.unionByName, [p.withColumn("batch_id", F.lit(batch).cast("bigint")) for batch, p in parts.items()])
    return rows.groupBy(*PAIR).agg(F.max_by("n_visits", "batch_id").alias("n_visits"))


def read_visit_counts(spark: SparkSession, sink: str) -> DataFrame:
    """Current totals of T1: per key, the count of its latest batch (a
    snapshot counts as the last batch that it holds)."""
    folders = state.parts(spark, sink)
    if not folders:
        return spark.createDataFrame([], "practitioner string, diagnosis string, n_visits bigint")
    return _latest({batch: state.read_delta(spark, f, PAIR, "n_visits") for batch, f in folders.items()})


def compact_visit_counts(spark: SparkSession, sink: str) -> int | None:
    """Fold T1's per-batch updates into a snapshot (``state.compact``): the latest count of each key."""
    return state.compact(spark, sink, PAIR, "n_visits", _latest)


def run_patient_cases(spark: SparkSession, input_dir: str, checkpoint: str, state_path: str,
                      max_files_per_trigger: int | None = None, trigger: dict | None = None,
                      fresh: bool = False, compact_every: int = COMPACT_EVERY, rejects_path: str | None = None):
    """Fold cases per (practitioner, diagnosis, patient) batch by batch.
    With ``rejects_path`` malformed lines go to its folder ``batch_id=N``, from the same scan."""
    _start(spark, checkpoint, state_path, fresh)

    def write_batch(lines: DataFrame, batch_id: int) -> None:
        state.append_delta(spark, _batch_totals(lines, "patients", rejects_path, batch_id), state_path, batch_id, replay=True)
        if batch_id % compact_every == compact_every - 1:
            compact_patient_cases(spark, state_path)

    return _each_batch(_lines(spark, input_dir, max_files_per_trigger), checkpoint, write_batch, trigger)


def run_served(spark: SparkSession, input_dir: str, practitioner_paths, checkpoint: str, state_path: str, results_path: str,
               metrics: str = "patients", max_files_per_trigger: int | None = None, trigger: dict | None = None,
               fresh: bool = False, compact_every: int = COMPACT_EVERY, rejects_path: str | None = None,
               duplicates: str = "keep"):
    """From arriving files to the served table: every batch is folded into the
    state, and the diagnoses that it touches -- or that other practitioner
    records touch, which are read anew for each batch -- are joined with the
    practitioners and replaced in the table, switched at once (J1, K2)."""
    _start(spark, checkpoint, state_path, fresh)

    def write_batch(lines: DataFrame, batch_id: int) -> None:
        prac = extract.practitioners(line_src.read_lines(spark, practitioner_paths), duplicates=duplicates)
        job.fold_and_serve(spark, _batch_totals(lines, metrics, rejects_path, batch_id), prac, results_path, state_path,
                           batch_id, metrics, compact_every, replay=True)

    return _each_batch(_lines(spark, input_dir, max_files_per_trigger), checkpoint, write_batch, trigger)


def _batch_totals(lines: DataFrame, metrics: str, rejects_path: str | None, batch_id: int) -> DataFrame:
    """The totals of a batch; its rejects are written if there is a place for them."""
    if rejects_path is None:
        return job.totals(lines, metrics)
    totals, bad = job.split_batch(lines, metrics, "quarantine")
    bad.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/batch_id={batch_id}")
    return totals


def _each_batch(lines: DataFrame, checkpoint: str, write_batch: Callable[[DataFrame, int], None], trigger: dict | None):
    q = (lines.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(write_batch)
              .trigger(**(trigger or {"availableNow": True}))
              .start())
    if not trigger:
        q.awaitTermination()
    return q


def read_rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """``value, file_path, module, batch_id`` of the lines that a stream or ``job.run_folder`` set aside."""
    return spark.read.schema("value string, file_path string, module string, batch_id bigint").parquet(rejects_path)


CASE_KEYS = ["practitioner", "diagnosis", "patient"]


def compact_patient_cases(spark: SparkSession, state_path: str) -> int | None:
    """Fold T2's per-batch case deltas into one snapshot (``state.compact``)."""
    return state.compact(spark, state_path, CASE_KEYS, "n_cases")


def read_patient_counts(spark: SparkSession, state_path: str) -> DataFrame:
    """Current ``practitioner, diagnosis, n_patients, n_visits`` of T2."""
    cases = state.read_totals(spark, state_path, CASE_KEYS, "n_cases")
    return aggregate.visits_and_patients(cases)
