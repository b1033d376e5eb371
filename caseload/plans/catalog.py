"""Registered queries: one per operator group of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the given tables (SURVEY 7.3 mapping).

Queries that write (sinks, state, streams, routed files) use a fresh folder
below the session's checkpoint root per call.  Some fuzzy queries ask for the
plain Levenshtein distance, the ``*_transposed`` ones and the searches over
the indexed table use the default, transposition-aware one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.functions import text
from caseload.operators import aggregate, enrich, extract, search
from caseload.schemas import RESULTS_TWO_METRICS
from caseload.plans import identity, job, serve, state
from caseload.session import work_dir
from caseload.sources import lines as line_src
from caseload.sources import star
from caseload.streaming import visits as stream

PAIR = ["practitioner", "diagnosis"]
CASE_KEYS = ["practitioner", "diagnosis", "patient"]

# Fixed query parameters of the registered search queries.
SLICE_DIAGNOSIS = "cold widget"
SEARCH_WITH_DIAGNOSIS = ("q1", "Cold Wigdet", "suplier", "eurpoe")
SEARCH_WITHOUT_DIAGNOSIS = ("q1", "", "supplier 000000042", "asai")
SOFT_QUERIES = [
    ("s1", "cold wigdet", "suplier 000000042", "europe"),
    ("s2", "hot rod", "supplier 000000001", "nowhere"),
    ("s3", "", "suplier 000000007", "asia"),
    ("s4", "", "", "amrica"),
    ("s5", "qqqq zzzz", "xxxx", "yyyy"),
    ("s6", "", "", ""),
]
CAPPED_EXPANSIONS = 5


# ---------------------------------------------------------------- helpers

def encounters(spark: SparkSession, sf: str, require_patient: bool = False) -> DataFrame:
    return extract.encounters(star.encounter_lines(spark, sf), require_patient=require_patient)


def practitioners(spark: SparkSession, sf: str) -> DataFrame:
    return extract.practitioners(star.practitioner_lines(spark, sf))


def results(spark: SparkSession, sf: str) -> DataFrame:
    """The served table: visit totals joined with practitioner details."""
    return enrich.enrich(aggregate.visit_counts(encounters(spark, sf)), practitioners(spark, sf))


def served_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results written as the served table (partitioned by diagnosis) and
    read back: searches run against the stored table, as a search service
    would, instead of re-deriving it in every branch of their plan."""
    path = work_dir(spark, "served")
    serve.write_results(results(spark, sf), path)
    return serve.read_results(spark, path)


def _slice_totals(spark: SparkSession, sf: str, keys, metric: str) -> list[DataFrame]:
    """The totals of each input slice, as tables written by one scan."""
    lines = star.encounter_lines(spark, sf)
    path = work_dir(spark, "slices")
    parsed = extract.encounters(lines, require_patient="patient" in keys, keep=("slice",))
    parsed.groupBy("slice", *keys).agg(F.count(F.lit(1)).alias(metric)).write.partitionBy("slice").parquet(path)
    rows = spark.read.schema(", ".join(f"{k} string" for k in keys) + f", {metric} bigint, slice int").parquet(path)
    return [rows.where(F.col("slice") == i).drop("slice") for i in range(star.N_SLICES)]


def diagnosis_queries(spark: SparkSession, sf: str) -> DataFrame:
    """One query per distinct part name: upper-cased, third letter dropped."""
    p = star.table(spark, sf, "part").select("p_name").distinct()
    typo = F.upper(F.concat(F.substring("p_name", 1, 2), F.substring("p_name", 4, 1000)))
    return p.select(F.concat(F.lit("d:"), F.col("p_name")).alias("query_id"), typo.alias("diagnosis"),
                    F.lit("").alias("full_name"), F.lit("").alias("hospital"))


def name_queries(spark: SparkSession, sf: str) -> DataFrame:
    """One query per supplier: its name with the double 'p' halved."""
    s = star.table(spark, sf, "supplier")
    name = F.regexp_replace(F.lower(F.regexp_replace("s_name", "#", " ")), "pp", "p")
    return s.select(F.concat(F.lit("s:"), F.col("s_suppkey").cast("string")).alias("query_id"),
                    F.lit("").alias("diagnosis"), name.alias("full_name"), F.lit("").alias("hospital"))


def hospital_queries(spark: SparkSession, sf: str) -> DataFrame:
    """One query per nation: its hospital text with the second letter dropped."""
    n = star.table(spark, sf, "nation").alias("n")
    r = star.table(spark, sf, "region").alias("r")
    h = F.concat(F.lower(F.col("r_name")), F.lit("-"), F.lower(F.col("n_name")))
    typo = F.concat(F.substring(h, 1, 1), F.substring(h, 3, 1000))
    return (n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
             .select(F.concat(F.lit("n:"), F.col("n_nationkey").cast("string")).alias("query_id"),
                     F.lit("").alias("diagnosis"), F.lit("").alias("full_name"), typo.alias("hospital")))


def turned(value: Column) -> Column:
    """The text with its second and third characters turned round."""
    return F.concat(F.substring(value, 1, 1), F.substring(value, 3, 1), F.substring(value, 2, 1),
                    F.substring(value, 4, 1000))


def turned_queries(spark: SparkSession, sf: str) -> DataFrame:
    """The diagnoses, names and hospitals of the tables with two characters
    turned round, as the fields of one query for each."""
    p = star.table(spark, sf, "part").select("p_name").distinct()
    s = star.table(spark, sf, "supplier")
    name = F.lower(F.regexp_replace("s_name", "#", " "))
    n, r = star.table(spark, sf, "nation"), star.table(spark, sf, "region")
    hospital = F.concat(F.lower(F.col("r_name")), F.lit("-"), F.lower(F.col("n_name")))
    none = F.lit("")
    return (p.select(F.concat(F.lit("d:"), F.col("p_name")).alias("query_id"), turned(F.col("p_name")).alias("diagnosis"),
                     none.alias("full_name"), none.alias("hospital"))
            .unionByName(s.select(F.concat(F.lit("s:"), F.col("s_suppkey").cast("string")).alias("query_id"),
                                  none.alias("diagnosis"), turned(name).alias("full_name"), none.alias("hospital")))
            .unionByName(n.join(r, n.n_regionkey == r.r_regionkey).select(
                F.concat(F.lit("n:"), F.col("n_nationkey").cast("string")).alias("query_id"),
                none.alias("diagnosis"), none.alias("full_name"), turned(hospital).alias("hospital"))))


def batch_queries(spark: SparkSession, sf: str) -> DataFrame:
    """The diagnosis queries and the nation (hospital) queries together: a
    table of queries that grows with the data."""
    d = diagnosis_queries(spark, sf)
    h = hospital_queries(spark, sf)
    return d.unionByName(h)


def _matches(spark, sf, queries, fields, cap=None, transpositions=False):
    fz = {f: search.FUZZINESS[f] for f in fields}
    res = served_results(spark, sf)
    terms = search.query_terms(queries, fields)
    return search.expand_terms(terms, search.vocabulary(res, fields), fz, cap, transpositions)


# ---------------------------------------------------------------- queries

def q_parse_encounters(spark, sf):
    return encounters(spark, sf, require_patient=True)


def q_parse_practitioners(spark, sf):
    return practitioners(spark, sf)


def q_malformed_sentinel(spark, sf):
    enc = extract.encounters(star.encounter_lines(spark, sf, damaged=True), on_malformed="sentinel")
    return aggregate.visit_counts(enc)


def q_malformed_quarantine(spark, sf):
    return extract.rejects(star.encounter_lines(spark, sf, damaged=True)).select("value", "module")


def q_practitioner_sentinel(spark, sf):
    return extract.practitioners(star.practitioner_lines(spark, sf, damaged=True), on_malformed="sentinel")


def q_practitioner_quarantine(spark, sf):
    """What is kept and what is set aside, with the module it came from."""
    lines = star.practitioner_lines(spark, sf, damaged=True)
    kept = extract.practitioners(lines).select(F.col("practitioner").alias("value"), F.lit("kept").alias("module"))
    return kept.unionByName(extract.rejects(lines, module="practitioner").select("value", "module"))


def q_visit_counts(spark, sf):
    return aggregate.visit_counts(encounters(spark, sf))


def q_merge_visit_counts(spark, sf):
    return state.fold(_slice_totals(spark, sf, PAIR, "n_visits"), PAIR, "n_visits")


def q_patient_cases(spark, sf):
    return aggregate.patient_cases(encounters(spark, sf, require_patient=True))


def q_merge_patient_cases(spark, sf):
    return state.fold(_slice_totals(spark, sf, CASE_KEYS, "n_cases"), CASE_KEYS, "n_cases")


def q_visits_and_patients(spark, sf):
    return aggregate.visits_and_patients(aggregate.patient_cases(encounters(spark, sf, True)))


def q_enriched_visits(spark, sf):
    return results(spark, sf)


def q_enriched_visits_and_patients(spark, sf):
    vp = aggregate.visits_and_patients(aggregate.patient_cases(encounters(spark, sf, True)))
    return enrich.enrich(vp, practitioners(spark, sf))


def q_diagnosis_list(spark, sf):
    return aggregate.list_diagnoses(encounters(spark, sf))


def _stored_state(spark, sf) -> str:
    path = work_dir(spark, "state")
    for i, part in enumerate(_slice_totals(spark, sf, PAIR, "n_visits")):
        state.append_delta(spark, part, path, i)
    return path


def q_stored_slice(spark, sf):
    """One diagnosis of the stored totals: partition pruning in every delta."""
    return state.read_totals(spark, _stored_state(spark, sf), PAIR, "n_visits", diagnosis=SLICE_DIAGNOSIS)


def q_stored_diagnoses(spark, sf):
    """The diagnoses of the stored totals, from their partition values."""
    return aggregate.list_diagnoses(state.read_totals(spark, _stored_state(spark, sf), PAIR, "n_visits"))


def q_diagnosis_slice(spark, sf):
    return aggregate.for_diagnosis(results(spark, sf), SLICE_DIAGNOSIS)


def q_state_documents(spark, sf):
    totals = aggregate.visit_counts(encounters(spark, sf))
    return serve.to_documents(totals, per_diagnosis=False)


def q_result_documents(spark, sf):
    return serve.to_documents(results(spark, sf), per_diagnosis=True)


def q_two_metric_documents(spark, sf):
    return serve.to_documents(q_enriched_visits_and_patients(spark, sf))


def q_case_documents(spark, sf):
    return serve.to_documents(aggregate.patient_cases(encounters(spark, sf, True)), per_diagnosis=False,
                              order_by=("practitioner", "patient"))


def q_chunked_documents(spark, sf):
    """The result documents as they are sent: cut into requests, the requests
    stored, and their documents read back with the requests' sizes checked."""
    path = work_dir(spark, "requests")
    serve.requests(serve.to_documents(results(spark, sf))).write.parquet(path)
    sent = spark.read.parquet(path)
    size = F.when((F.col("n_docs") == F.size("docs")) & (F.col("n_docs") <= serve.REQUEST), F.col("docs")).otherwise(
        F.raise_error("a request of the wrong size").cast("array<struct<diagnosis: string, _id: bigint, doc: string>>"))
    return sent.select(F.inline(size))


def q_lasting_documents(spark, sf):
    """Three builds, each with one more slice of visits: documents keep the
    ids that they were given first, and only new ones are numbered."""
    path = work_dir(spark, "ids")
    totals, prac = _slice_totals(spark, sf, PAIR, "n_visits"), practitioners(spark, sf)
    for i in range(star.N_SLICES):
        built = identity.with_lasting_id(enrich.enrich(state.fold(totals[:i + 1], PAIR, "n_visits"), prac), path)
    return serve.as_documents(built)


def q_partitioned_roundtrip(spark, sf):
    """The table written twice, first with a diagnosis that the second lacks."""
    path = work_dir(spark, "results")
    prac = practitioners(spark, sf)
    first = enrich.enrich(_slice_totals(spark, sf, PAIR, "n_visits")[0], prac)
    vanished = first.limit(5).withColumn("diagnosis", F.lit("vanished"))
    serve.write_results(first.unionByName(vanished), path)
    serve.write_results(results(spark, sf), path)
    return serve.read_results(spark, path)


def q_routed_scan(spark, sf):
    root = _stage_store(spark, sf, "routed")
    return (line_src.read_routed(spark, f"{root}/store").groupBy("role")
            .agg(F.count(F.lit(1)).alias("n_lines")))


def _stage_store(spark, sf, tag):
    root = work_dir(spark, tag)
    star.write_ndjson(star.encounter_lines(spark, sf), f"{root}/store/{line_src.ENCOUNTER_MARKER}", "slice")
    star.write_ndjson(star.practitioner_lines(spark, sf), f"{root}/store/{line_src.PRACTITIONER_MARKER}")
    return root


def q_batch_build(spark, sf):
    """The batch job end to end: files found by role, built in one plan."""
    root = _stage_store(spark, sf, "build")
    routed = line_src.route_paths(spark, f"{root}/store")        # folders, not files
    return job.build(spark, routed["encounter"], routed["practitioner"], f"{root}/results")


def q_incremental_build(spark, sf):
    """The patient-aware job fed one slice of files per run into its state."""
    root = _stage_store(spark, sf, "build-inc")
    routed = line_src.route_paths(spark, f"{root}/store")
    out = None
    for i in range(star.N_SLICES):
        folders = [f"{f}/slice={i}" for f in routed["encounter"]]
        out = job.build(spark, folders, routed["practitioner"], f"{root}/results", metrics="patients",
                        state_path=f"{root}/state", batch_id=i, duplicates="latest")
    return out


def q_fuzzy_diagnosis(spark, sf):
    return _matches(spark, sf, diagnosis_queries(spark, sf), ("diagnosis",))


def q_fuzzy_name(spark, sf):
    return _matches(spark, sf, name_queries(spark, sf), ("full_name",))


def q_fuzzy_hospital(spark, sf):
    return _matches(spark, sf, hospital_queries(spark, sf), ("hospital",))


def q_fuzzy_diagnosis_transposed(spark, sf):
    return _matches(spark, sf, turned_queries(spark, sf), ("diagnosis",), transpositions=True)


def q_fuzzy_name_transposed(spark, sf):
    return _matches(spark, sf, turned_queries(spark, sf), ("full_name",), transpositions=True)


def q_fuzzy_hospital_transposed(spark, sf):
    return _matches(spark, sf, turned_queries(spark, sf), ("hospital",), transpositions=True)


def q_capped_expansion(spark, sf):
    return _matches(spark, sf, name_queries(spark, sf), ("full_name",), CAPPED_EXPANSIONS)


def q_soft_intersection(spark, sf):
    res = served_results(spark, sf)
    q = search.make_queries(spark, SOFT_QUERIES)
    m = search.query_matches(q, res, transpositions=False)
    return search.soft_intersect(search.combine(m, res))


def q_search_with_diagnosis(spark, sf):
    return search.search(served_results(spark, sf), search.make_queries(spark, [SEARCH_WITH_DIAGNOSIS]),
                         transpositions=False)


def q_search_without_diagnosis(spark, sf):
    return search.search(served_results(spark, sf), search.make_queries(spark, [SEARCH_WITHOUT_DIAGNOSIS]),
                         transpositions=False)


def q_batch_search(spark, sf):
    return search.search(served_results(spark, sf), batch_queries(spark, sf), transpositions=False)


def q_search_transposed(spark, sf):
    """The default search: an adjacent transposition is one edit."""
    return search.search(served_results(spark, sf), search.make_queries(spark, [SEARCH_WITH_DIAGNOSIS]))


def q_indexed_search(spark, sf):
    """The whole table of turned queries against a stored index: the diagnosis
    folders of the served table, and the best lines of every term and pair."""
    res = served_results(spark, sf)
    return search.search(res, turned_queries(spark, sf), index=search.best_lines(res))


def q_turned_search(spark, sf):
    """A batch of searches by diagnosis, by practitioner name and by hospital:
    the whole table of turned queries."""
    return search.search(served_results(spark, sf), turned_queries(spark, sf))


def q_search_patients(spark, sf):
    """A search over the patient-aware results, ranked by distinct patients."""
    path = work_dir(spark, "served-patients")
    serve.write_results(q_enriched_visits_and_patients(spark, sf), path)
    return search.search(serve.read_results(spark, path, schema=RESULTS_TWO_METRICS),
                         search.make_queries(spark, [SEARCH_WITH_DIAGNOSIS]), transpositions=False)


def q_title_case(spark, sf):
    h = practitioners(spark, sf).select("hospital").distinct()
    return h.select("hospital", text.title_case("hospital").alias("title"))


def _streamed(spark, sf, root, run, damaged=False):
    """Have the encounter lines arrive slice by slice in the folder that the
    stream reads, and let the stream catch up after each arrival."""
    lines = star.encounter_lines(spark, sf, damaged=damaged)
    for i in range(star.N_SLICES):
        star.write_ndjson(lines.where(F.col("slice") == i), f"{root}/in/slice={i}")
        run(f"{root}/in")


def q_stream_visit_counts(spark, sf):
    root = work_dir(spark, "stream-visits")
    _streamed(spark, sf, root, lambda src: stream.run_visit_counts(spark, src, f"{root}/checkpoint", f"{root}/sink"))
    return stream.read_visit_counts(spark, f"{root}/sink")


def q_stream_patient_counts(spark, sf):
    root = work_dir(spark, "stream-patients")
    _streamed(spark, sf, root, lambda src: stream.run_patient_cases(spark, src, f"{root}/checkpoint", f"{root}/state"))
    return stream.read_patient_counts(spark, f"{root}/state")


def q_stream_served_table(spark, sf):
    """Encounter files arrive slice by slice; the stream keeps the served table up to date."""
    root = work_dir(spark, "stream-served")
    star.write_ndjson(star.practitioner_lines(spark, sf), f"{root}/practitioners")
    _streamed(spark, sf, root, lambda src: stream.run_served(
        spark, src, f"{root}/practitioners", f"{root}/checkpoint", f"{root}/state", f"{root}/results"))
    return job.results(spark, f"{root}/results", "patients")


def q_stream_rejects(spark, sf):
    """The malformed lines of a stream, set aside by the scan that folds the others."""
    root = work_dir(spark, "stream-rejects")
    _streamed(spark, sf, root, lambda src: stream.run_patient_cases(
        spark, src, f"{root}/checkpoint", f"{root}/state", rejects_path=f"{root}/rejects"), damaged=True)
    return stream.read_rejects(spark, f"{root}/rejects").select("value", "module")


def q_folder_build(spark, sf):
    """The batch job on a growing folder: a slice of files arrives before each
    run, the ledger tells which are new, and a last run finds none."""
    root = work_dir(spark, "folder")
    lines = star.encounter_lines(spark, sf)
    star.write_ndjson(star.practitioner_lines(spark, sf), f"{root}/store/{line_src.PRACTITIONER_MARKER}")
    for i in [*range(star.N_SLICES), None]:
        if i is not None:
            star.write_ndjson(lines.where(F.col("slice") == i), f"{root}/store/{line_src.ENCOUNTER_MARKER}slice={i}")
        out = job.run_folder(spark, f"{root}/store", f"{root}/results", f"{root}/state")
    return out


def q_build_rejects(spark, sf):
    """What the batch job sets aside of both modules, while it builds."""
    root = work_dir(spark, "build-rejects")
    star.write_ndjson(star.encounter_lines(spark, sf, damaged=True), f"{root}/encounters")
    star.write_ndjson(star.practitioner_lines(spark, sf, damaged=True), f"{root}/practitioners")
    job.build(spark, f"{root}/encounters", f"{root}/practitioners", f"{root}/results", rejects_path=f"{root}/rejects")
    return spark.read.schema("value string, module string").parquet(f"{root}/rejects")


def q_cleared_state(spark, sf):
    """State that is dropped and begun anew: nothing of the first totals is left (K6)."""
    path = _stored_state(spark, sf)
    state.compact(spark, path, PAIR, "n_visits")
    state.clear(spark, path)
    for i, part in enumerate(_slice_totals(spark, sf, PAIR, "n_visits")[1:]):
        state.append_delta(spark, part, path, i)
    return state.read_totals(spark, path, PAIR, "n_visits")


def q_compacted_state(spark, sf):
    path = work_dir(spark, "state")
    state.clear(spark, path)
    parts = _slice_totals(spark, sf, PAIR, "n_visits")
    state.append_delta(spark, parts[0], path, 0)
    state.append_delta(spark, parts[1], path, 1)
    state.compact(spark, path, PAIR, "n_visits")
    state.append_delta(spark, parts[2], path, 2)
    state.append_delta(spark, parts[0], path, 0, replay=True)  # of a compacted batch: ignored
    return state.read_totals(spark, path, PAIR, "n_visits")


def q_synth_practitioners(spark, sf):
    """The practitioner module written as NDJSON and read back (K8)."""
    path = work_dir(spark, "module")
    star.write_ndjson(star.practitioner_lines(spark, sf), path)
    return extract.practitioners(line_src.read_lines(spark, path))


def q_synth_patients(spark, sf):
    """The patient module written as NDJSON and read back (K8)."""
    path = work_dir(spark, "module")
    star.write_ndjson(star.patient_lines(spark, sf), path)
    return extract.patients(line_src.read_lines(spark, path))


def q_synth_encounters(spark, sf):
    """The encounter module written as NDJSON, a folder per slice, and read
    back with the folder each record came from (K8)."""
    path = work_dir(spark, "module")
    star.write_ndjson(star.encounter_lines(spark, sf), path, "slice")
    lines = line_src.read_lines(spark, path)
    return extract.encounters(lines, require_patient=True, keep=("file_path",)).select(
        F.regexp_extract("file_path", "slice=([0-9]+)", 1).cast("int").alias("file_no"),
        F.col("patient").alias("subject"), F.col("practitioner").alias("individual"),
        F.col("diagnosis").alias("condition"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_encounters": q_parse_encounters,
    "parse_practitioners": q_parse_practitioners,
    "malformed_sentinel": q_malformed_sentinel,
    "malformed_quarantine": q_malformed_quarantine,
    "practitioner_sentinel": q_practitioner_sentinel,
    "practitioner_quarantine": q_practitioner_quarantine,
    "visit_counts": q_visit_counts,
    "merge_visit_counts": q_merge_visit_counts,
    "patient_cases": q_patient_cases,
    "merge_patient_cases": q_merge_patient_cases,
    "visits_and_patients": q_visits_and_patients,
    "enriched_visits": q_enriched_visits,
    "enriched_visits_and_patients": q_enriched_visits_and_patients,
    "diagnosis_list": q_diagnosis_list,
    "diagnosis_slice": q_diagnosis_slice,
    "stored_slice": q_stored_slice,
    "stored_diagnoses": q_stored_diagnoses,
    "state_documents": q_state_documents,
    "result_documents": q_result_documents,
    "two_metric_documents": q_two_metric_documents,
    "case_documents": q_case_documents,
    "chunked_documents": q_chunked_documents,
    "lasting_documents": q_lasting_documents,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "routed_scan": q_routed_scan,
    "batch_build": q_batch_build,
    "incremental_build": q_incremental_build,
    "fuzzy_diagnosis": q_fuzzy_diagnosis,
    "fuzzy_name": q_fuzzy_name,
    "fuzzy_hospital": q_fuzzy_hospital,
    "fuzzy_diagnosis_transposed": q_fuzzy_diagnosis_transposed,
    "fuzzy_name_transposed": q_fuzzy_name_transposed,
    "fuzzy_hospital_transposed": q_fuzzy_hospital_transposed,
    "capped_expansion": q_capped_expansion,
    "soft_intersection": q_soft_intersection,
    "search_with_diagnosis": q_search_with_diagnosis,
    "search_without_diagnosis": q_search_without_diagnosis,
    "search_transposed": q_search_transposed,
    "search_patients": q_search_patients,
    "batch_search": q_batch_search,
    "indexed_search": q_indexed_search,
    "turned_search": q_turned_search,
    "title_case": q_title_case,
    "stream_visit_counts": q_stream_visit_counts,
    "stream_patient_counts": q_stream_patient_counts,
    "stream_served_table": q_stream_served_table,
    "stream_rejects": q_stream_rejects,
    "folder_build": q_folder_build,
    "build_rejects": q_build_rejects,
    "compacted_state": q_compacted_state,
    "cleared_state": q_cleared_state,
    "synth_practitioners": q_synth_practitioners,
    "synth_patients": q_synth_patients,
    "synth_encounters": q_synth_encounters,
}
