"""The batch build: encounter and practitioner files -> served results.

One plan for all files and all diagnoses: line scan -> ``from_json`` ->
partial/final aggregation -> practitioner join -> Parquet partitioned by
diagnosis.  Optionally folds the batch into a delta state table first, so a
sequence of runs (one per arriving file set) accumulates totals; a re-run of a
``batch_id`` replaces its own delta.  Such a run reads and rewrites only the
diagnoses that its batch touches and those of practitioners whose records are
new, changed or gone since the last run, and every ``compact_every`` batches
the deltas become a snapshot, tiered as ``plans.state`` says.  So its cost
follows the batch, and over n batches the history is rewritten log n times;
only a run with other practitioner records looks their ids up in all stored
totals.  Without ``--batch-id`` a ledger of folded files tells which are new.

    python -m caseload.plans.job --root <input folder> --results <out> \\
        [--state <state folder> --batch-id N] [--metrics visits|patients] \\
        [--rejects <folder>] [--on-malformed quarantine|sentinel]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caseload.operators import aggregate, enrich, extract
from caseload.plans import ledger, serve, state
from caseload.schemas import RESULTS, RESULTS_TWO_METRICS
from caseload.session import work_dir
from caseload.sources import lines as line_src

COMPACT_EVERY = 20
PAIR = ["practitioner", "diagnosis"]
CASE_KEYS = ["practitioner", "diagnosis", "patient"]


def totals(encounter_lines: DataFrame, metrics: str = "visits",
           on_malformed: str = "quarantine") -> DataFrame:
    """Per-batch totals: visits per pair, or cases per (pair, patient)."""
    if metrics == "visits":
        return aggregate.visit_counts(extract.encounters(encounter_lines, on_malformed))
    return aggregate.patient_cases(extract.encounters(encounter_lines, on_malformed, require_patient=True))


def keys_of(metrics: str) -> tuple[list[str], str]:
    """The keys and the metric of the totals that a job keeps."""
    if metrics not in ("visits", "patients"):
        raise ValueError(f"metrics must be 'visits' or 'patients', not {metrics!r}")
    return (PAIR, "n_visits") if metrics == "visits" else (CASE_KEYS, "n_cases")


def split_batch(encounter_lines: DataFrame, metrics: str, on_malformed: str,
                observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(totals, rejected lines) of a batch by one scan: both outcomes are
    written once, split by partition, and read from there."""
    keys, metric = keys_of(metrics)
    spark, path = encounter_lines.sparkSession, work_dir(encounter_lines.sparkSession, "outcomes")
    tallied = extract.tallied(encounter_lines, keys, metric, on_malformed, metrics == "patients", observation)
    tallied.write.partitionBy("outcome").parquet(path)
    stored = spark.read.schema(tallied.schema).parquet(path)
    accepted = stored.where(F.col("outcome") == extract.ACCEPTED).select(*keys, metric)
    return accepted, extract.rejected_lines(stored, "encounter", metric)


def split_practitioners(lines: DataFrame, on_malformed: str, duplicates: str) -> tuple[DataFrame, DataFrame]:
    """(practitioners, rejected lines), likewise."""
    spark, path = lines.sparkSession, work_dir(lines.sparkSession, "outcomes")
    found = extract.outcomes(lines, "practitioner", on_malformed)
    found.write.partitionBy("outcome").parquet(path)
    stored = spark.read.schema(found.schema).parquet(path)
    accepted = extract.one_record(stored.where(F.col("outcome") == extract.ACCEPTED), duplicates)
    return accepted, extract.rejected_lines(stored, "practitioner")


def build(spark: SparkSession, encounter_paths, practitioner_paths, results_path: str, *,
          metrics: str = "visits", on_malformed: str = "quarantine",
          state_path: str | None = None, batch_id: int | None = None,
          rejects_path: str | None = None, duplicates: str = "keep",
          compact_every: int = COMPACT_EVERY, observation: Observation | None = None) -> DataFrame:
    """Run the build; returns the written results table (read back).  With
    ``rejects_path`` each line is still scanned and parsed once, and an
    ``observation`` then holds how many encounter lines were accepted and rejected."""
    keys, metric = keys_of(metrics)
    if state_path is not None and batch_id is None:
        raise ValueError("batch_id is required with state_path")
    enc_lines = line_src.read_lines(spark, encounter_paths)
    prac_lines = line_src.read_lines(spark, practitioner_paths)
    if rejects_path is not None:
        t, bad = split_batch(enc_lines, metrics, on_malformed, observation)
        prac, bad_prac = split_practitioners(prac_lines, on_malformed, duplicates)
        bad.unionByName(bad_prac).write.mode("overwrite").partitionBy("module").parquet(rejects_path)
    else:
        t = totals(enc_lines, metrics, on_malformed)
        prac = extract.practitioners(prac_lines, on_malformed, duplicates=duplicates)
    if state_path is not None:
        fold_and_serve(spark, t, prac, results_path, state_path, batch_id, metrics, compact_every)
    else:
        serve.write_results(enrich.enrich(_served(t, metrics), prac), results_path)
    return results(spark, results_path, metrics)


def results(spark: SparkSession, results_path: str, metrics: str) -> DataFrame:
    """The served table of a job with these metrics."""
    return serve.read_results(spark, results_path, schema=RESULTS if metrics == "visits" else RESULTS_TWO_METRICS)


def _served(totals: DataFrame, metrics: str) -> DataFrame:
    return aggregate.visits_and_patients(totals) if metrics == "patients" else totals


def fold_and_serve(spark: SparkSession, totals: DataFrame, practitioners: DataFrame, results_path: str, state_path: str,
                   batch_id: int, metrics: str, compact_every: int = COMPACT_EVERY, replay: bool = False) -> None:
    """Fold a batch's totals into the state and serve the diagnoses that it,
    or other practitioner records, touch.  ``replay``: a stream may repeat a
    batch that a snapshot holds; its totals are there already."""
    keys, metric = keys_of(metrics)
    path = work_dir(spark, "practitioners")  # parsed once: compared, joined and stored
    practitioners.write.parquet(path)
    prac = spark.read.schema(practitioners.schema).parquet(path)
    touched = _fold_batch(spark, totals, prac, state_path, batch_id, keys, metric, replay)
    t = _served(state.read_totals(spark, state_path, keys, metric, only=touched), metrics)
    state.forget_practitioners(spark, state_path)
    serve.write_results(enrich.enrich(t, prac), results_path, touched)
    state.keep_practitioners(prac, state_path)
    if len(state.deltas(spark, state_path)) >= compact_every:
        state.compact(spark, state_path, keys, metric)


def run_folder(spark: SparkSession, root: str, results_path: str, state_path: str, *, metrics: str = "visits",
               rejects_path: str | None = None, encounter_marker: str = line_src.ENCOUNTER_MARKER,
               practitioner_marker: str = line_src.PRACTITIONER_MARKER, **options) -> DataFrame:
    """Build from a folder that files keep arriving in: what the ledger does
    not hold becomes the next batch, whose rejects go to a folder of its own.
    Without new files, and with the practitioners as they were, nothing is done."""
    routed = line_src.route_paths(spark, root, encounter_marker, practitioner_marker)
    batch, files = ledger.next_batch(spark, routed["encounter"], state_path)
    if not files:
        ledger.forget(spark, state_path, batch)
        prac = extract.practitioners(line_src.read_lines(spark, routed["practitioner"]),
                                     options.get("on_malformed", "quarantine"), options.get("duplicates", "keep"))
        served = state.served_practitioners(spark, state_path)
        if served is None or not _changed(spark, served, prac).isEmpty():
            keys, metric = keys_of(metrics)
            fold_and_serve(spark, spark.createDataFrame([], state._schema(keys, metric)), prac, results_path, state_path,
                           batch, metrics)
        return results(spark, results_path, metrics)
    return build(spark, files, routed["practitioner"], results_path, metrics=metrics, state_path=state_path, batch_id=batch,
                 rejects_path=rejects_path and f"{rejects_path.rstrip('/')}/batch_id={batch}", **options)


def _fold_batch(spark: SparkSession, totals: DataFrame, practitioners: DataFrame, state_path: str, batch_id: int,
                keys, metric: str, replay: bool = False) -> DataFrame:
    """Append the batch's delta; gives the diagnoses that it touches, those of
    a delta that it replaces and of other practitioner records included, as a
    written table (small, so reading the state by it prunes partitions)."""
    path = work_dir(spark, "touched")
    old = state.deltas(spark, state_path).get(batch_id)
    if old is not None:
        state.read_delta(spark, old, keys, metric).select("diagnosis").distinct().write.mode("append").parquet(path)
    if state.append_delta(spark, totals, state_path, batch_id, replay):
        new = state.read_delta(spark, state.deltas(spark, state_path)[batch_id], keys, metric)
    else:
        new = totals  # in a snapshot already
    new.select("diagnosis").distinct().write.mode("append").parquet(path)
    served = state.served_practitioners(spark, state_path)
    if served is None:
        state.diagnoses_of(spark, state_path, keys, metric).write.mode("append").parquet(path)
    else:
        changed = _changed(spark, served, practitioners)
        if not changed.isEmpty():
            state.diagnoses_of(spark, state_path, keys, metric, changed).write.mode("append").parquet(path)
    # the comparison holds for every diagnosis; Spark prunes partitions only by a side that has a filter
    return spark.read.schema("diagnosis string").parquet(path).where(F.col("diagnosis") >= "")


def _changed(spark: SparkSession, old: DataFrame, new: DataFrame) -> DataFrame:
    """The practitioners whose records (all of an id, if kept) are new, other or gone, as a written table."""
    path = work_dir(spark, "changed")
    columns = ["practitioner", *enrich.DETAIL_COLS]
    both = old.select(*columns, F.lit(-1).alias("n")).unionByName(new.select(*columns, F.lit(1).alias("n")))
    (both.groupBy(*columns).agg(F.sum("n").alias("n")).where(F.col("n") != 0)
         .select("practitioner").distinct().write.parquet(path))
    return spark.read.schema("practitioner string").parquet(path)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--root", required=True, help="folder holding encounter and practitioner files")
    ap.add_argument("--results", required=True)
    ap.add_argument("--state")
    ap.add_argument("--batch-id", type=int)
    ap.add_argument("--metrics", default="visits", choices=["visits", "patients"])
    ap.add_argument("--rejects")
    ap.add_argument("--on-malformed", default="quarantine", choices=["quarantine", "sentinel"])
    ap.add_argument("--duplicates", default="keep", choices=["keep", "latest"],
                    help="practitioner ids found more than once: keep all records or the last file's")
    ap.add_argument("--encounter-marker", default=line_src.ENCOUNTER_MARKER)
    ap.add_argument("--practitioner-marker", default=line_src.PRACTITIONER_MARKER)
    a = ap.parse_args(argv)
    from caseload.session import get_session
    spark = get_session()
    if a.state and a.batch_id is None:
        run_folder(spark, a.root, a.results, a.state, metrics=a.metrics, rejects_path=a.rejects,
                   encounter_marker=a.encounter_marker, practitioner_marker=a.practitioner_marker,
                   on_malformed=a.on_malformed, duplicates=a.duplicates)
        return
    routed = line_src.route_paths(spark, a.root, a.encounter_marker, a.practitioner_marker)
    build(spark, routed["encounter"], routed["practitioner"], a.results, metrics=a.metrics,
          on_malformed=a.on_malformed, state_path=a.state, batch_id=a.batch_id, rejects_path=a.rejects,
          duplicates=a.duplicates)


if __name__ == "__main__":
    main()
