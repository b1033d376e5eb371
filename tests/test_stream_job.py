"""T1/T2 streaming folds, the batch job, work folders and the driver contract."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF

from caseload.operators import aggregate, extract
from caseload.plans import catalog, job
from caseload.sources import lines as line_src
from caseload.sources import star
from caseload.streaming import visits as stream


def _stage(spark, root):
    star.write_ndjson(star.encounter_lines(spark, SF), f"{root}/in", "slice")
    return f"{root}/in"


def _tuples(df):
    return sorted(map(tuple, df.collect()))


def test_stream_visit_counts_restart_is_idempotent(spark, tmp):
    src = _stage(spark, tmp)
    stream.run_visit_counts(spark, src, f"{tmp}/ck", f"{tmp}/sink")
    want = _tuples(catalog.q_visit_counts(spark, SF))
    assert _tuples(stream.read_visit_counts(spark, f"{tmp}/sink")) == want
    stream.run_visit_counts(spark, src, f"{tmp}/ck", f"{tmp}/sink")   # restart: nothing new
    assert _tuples(stream.read_visit_counts(spark, f"{tmp}/sink")) == want
    assert stream.compact_visit_counts(spark, f"{tmp}/sink") is not None
    assert _tuples(stream.read_visit_counts(spark, f"{tmp}/sink")) == want
    with pytest.raises(ValueError):     # another checkpoint must not wipe the sink
        stream.run_visit_counts(spark, src, f"{tmp}/ck2", f"{tmp}/sink")
    assert _tuples(stream.read_visit_counts(spark, f"{tmp}/sink")) == want
    stream.run_visit_counts(spark, src, f"{tmp}/ck2", f"{tmp}/sink", max_files_per_trigger=100, fresh=True)
    assert _tuples(stream.read_visit_counts(spark, f"{tmp}/sink")) == want


def test_stream_compacts_by_itself(spark, tmp):
    src = _stage(spark, tmp)
    stream.run_visit_counts(spark, src, f"{tmp}/ck", f"{tmp}/sink", max_files_per_trigger=1, compact_every=2)
    from caseload.plans import state
    assert state.latest_snapshot(spark, f"{tmp}/sink") is not None
    assert len(state.deltas(spark, f"{tmp}/sink")) < 2
    assert _tuples(stream.read_visit_counts(spark, f"{tmp}/sink")) == _tuples(catalog.q_visit_counts(spark, SF))


def test_stream_patient_counts(spark, tmp):
    src = _stage(spark, tmp)
    stream.run_patient_cases(spark, src, f"{tmp}/ck", f"{tmp}/state")
    got = stream.read_patient_counts(spark, f"{tmp}/state")
    assert got.where(F.col("n_patients") > F.col("n_visits")).count() == 0
    got = _tuples(got)
    assert got == _tuples(catalog.q_visits_and_patients(spark, SF))
    # restart with the same checkpoint: nothing new, nothing doubled
    stream.run_patient_cases(spark, src, f"{tmp}/ck", f"{tmp}/state")
    assert _tuples(stream.read_patient_counts(spark, f"{tmp}/state")) == got
    assert stream.compact_patient_cases(spark, f"{tmp}/state") is not None
    assert _tuples(stream.read_patient_counts(spark, f"{tmp}/state")) == got
    # a fresh checkpoint starts over (state cleared first) with other batch sizes
    stream.run_patient_cases(spark, src, f"{tmp}/ck2", f"{tmp}/state", max_files_per_trigger=5, fresh=True)
    assert _tuples(stream.read_patient_counts(spark, f"{tmp}/state")) == got


def test_batch_job_from_files(spark, tmp):
    root = f"{tmp}/store"
    star.write_ndjson(star.encounter_lines(spark, SF, damaged=True), f"{root}/{line_src.ENCOUNTER_MARKER}", "slice")
    star.write_ndjson(star.practitioner_lines(spark, SF), f"{root}/{line_src.PRACTITIONER_MARKER}")
    routed = line_src.route_paths(spark, root, level="files")
    assert len(routed["encounter"]) >= 3 and len(routed["practitioner"]) >= 1
    dirs = line_src.route_paths(spark, root)
    assert [d.rstrip("/").rsplit("/", 1)[-1] for d in dirs["encounter"]] == ["mockdata2"]
    assert line_src.read_lines(spark, dirs["encounter"]).count() == star.encounter_lines(spark, SF).count()
    out = job.build(spark, routed["encounter"], routed["practitioner"], f"{tmp}/results",
                    rejects_path=f"{tmp}/rejects")
    lines = star.encounter_lines(spark, SF, damaged=True)
    want = catalog.enrich.enrich(aggregate.visit_counts(extract.encounters(lines)), catalog.practitioners(spark, SF))
    assert _tuples(out.select(*want.columns)) == _tuples(want)
    rej = spark.read.parquet(f"{tmp}/rejects")
    assert rej.where("module = 'encounter'").count() == extract.rejects(lines).count()
    assert rej.where("module = 'practitioner'").count() == 0
    # incremental: three batches into a state table give the same totals
    for i in range(3):
        files = [f for f in routed["encounter"] if f"slice={i}" in f]
        out = job.build(spark, files, routed["practitioner"], f"{tmp}/results2",
                        state_path=f"{tmp}/state", batch_id=i, metrics="patients")
    vp = catalog.enrich.enrich(aggregate.visits_and_patients(aggregate.patient_cases(
        extract.encounters(lines, require_patient=True))), catalog.practitioners(spark, SF))
    assert _tuples(out.select(*vp.columns)) == _tuples(vp)


def test_route_paths_requires_practitioners(spark, tmp):
    star.write_ndjson(star.encounter_lines(spark, SF), f"{tmp}/x/{line_src.ENCOUNTER_MARKER}")
    try:
        line_src.route_paths(spark, f"{tmp}/x")
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_driver_contract(spark):
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.oracle_sql())
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"query_id", "kind", "ord", "line"}
    assert os.path.basename(E.SMOKE_DIR) == "sf0.001"


def test_job_cli(spark, tmp):
    root = f"{tmp}/store"
    star.write_ndjson(star.encounter_lines(spark, SF), f"{root}/{line_src.ENCOUNTER_MARKER}", "slice")
    star.write_ndjson(star.practitioner_lines(spark, SF), f"{root}/{line_src.PRACTITIONER_MARKER}")
    job.main(["--root", root, "--results", f"{tmp}/res", "--state", f"{tmp}/st", "--batch-id", "0",
              "--duplicates", "latest"])
    from caseload.plans import serve
    got = _tuples(serve.read_results(spark, f"{tmp}/res").select(*catalog.results(spark, SF).columns))
    assert got == _tuples(catalog.results(spark, SF))


def test_machine_local_work_folders_are_refused_on_a_cluster():
    from caseload import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
    assert session.is_local("local[4]") and session.is_local("local") and not session.is_local("local-cluster[2,1,512]")


def test_work_folders_have_an_owner(spark, tmp):
    from caseload import session
    assert f"/work/{spark.sparkContext.applicationId}/" in tmp


def test_a_file_below_both_markers_has_both_roles(spark, tmp):
    root = f"{tmp}/both"
    star.write_ndjson(star.practitioner_lines(spark, SF), f"{root}/{line_src.ENCOUNTER_MARKER}{line_src.PRACTITIONER_MARKER}")
    got = {r["role"]: r["count"] for r in line_src.read_routed(spark, root).groupBy("role").count().collect()}
    assert got == {"encounter": 10, "practitioner": 10}


def test_a_replaced_batch_takes_back_what_it_had(spark, tmp):
    """A corrected batch without a diagnosis removes it from the served table."""
    def store(name, diagnoses):
        lines = [f'{{"participant":[{{"individual":"1"}}],"diagnosis":[{{"condition":"{d}"}}],"subject":"s"}}' for d in diagnoses]
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp}/{name}")
        return f"{tmp}/{name}"

    spark.createDataFrame([('{"identifier":"1","name":"a b","telecom":"e","qualification":[{"identifier":"h"}]}',)],
                          "value string").write.text(f"{tmp}/prac")
    build = lambda path: sorted((r.diagnosis, r.n_visits) for r in job.build(
        spark, path, f"{tmp}/prac", f"{tmp}/out", state_path=f"{tmp}/st", batch_id=0).collect())
    assert build(store("first", ["flu", "gout", "gout"])) == [("flu", 1), ("gout", 2)]
    assert build(store("second", ["flu", "flu"])) == [("flu", 2)]


@pytest.mark.parametrize("duplicates", ["keep", "latest"])
def test_late_and_corrected_practitioners_reach_untouched_diagnoses(spark, tmp, duplicates):
    def store(name, lines):
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp}/{name}")
        return f"{tmp}/{name}"

    def visits(name, *pairs):
        return store(name, [f'{{"participant":[{{"individual":"{p}"}}],"diagnosis":[{{"condition":"{d}"}}],"subject":"s"}}'
                            for p, d in pairs])

    def prac(name, **emails):
        return store(name, [f'{{"identifier":"{p[1:]}","name":"a b","telecom":"{e}","qualification":[{{"identifier":"h"}}]}}'
                            for p, e in emails.items()])

    def build(path, practitioners, batch):
        out = job.build(spark, path, practitioners, f"{tmp}/out", state_path=f"{tmp}/st", batch_id=batch,
                        duplicates=duplicates, compact_every=2)
        return sorted((r.practitioner, r.diagnosis, r.email, r.n_visits) for r in out.collect())

    assert build(visits("a", ("1", "flu"), ("2", "gout"), ("3", "flu")), prac("p0", _1="old", _3="c"), 0) == [
        ("1", "flu", "old", 1), ("3", "flu", "c", 1)]
    # 2 is late and 1 corrected, while the batch has another diagnosis only
    second = [("1", "flu", "new", 1), ("2", "gout", "b", 1), ("3", "flu", "c", 1), ("3", "sprain", "c", 1)]
    assert build(visits("b", ("3", "sprain")), prac("p1", _1="new", _2="b", _3="c"), 1) == second
    # from a snapshot; then a record that is gone
    assert build(visits("c", ("3", "cold")), prac("p2", _1="newer", _2="b", _3="c"), 2) == sorted(
        [("1", "flu", "newer", 1), ("3", "cold", "c", 1)] + second[1:])
    assert build(visits("d", ("3", "cold")), prac("p3", _1="newer", _3="c"), 3) == [
        ("1", "flu", "newer", 1), ("3", "cold", "c", 2), ("3", "flu", "c", 1), ("3", "sprain", "c", 1)]
