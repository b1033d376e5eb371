"""Files that keep arriving: the ledger, rejects by one scan, streams to the served table."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF, lines_df

from caseload.operators import extract
from caseload.plans import catalog, job, ledger, state
from caseload.sources import lines as line_src
from caseload.sources import star
from caseload.streaming import visits as stream
from test_extract import FIXTURE, GOOD


def visit(p, d, s="s"):
    return f'{{"participant":[{{"individual":"{p}"}}],"diagnosis":[{{"condition":"{d}"}}],"subject":"{s}"}}'


def practitioner(p, email="e"):
    return f'{{"identifier":"{p}","name":"a b","telecom":"{email}","qualification":[{{"identifier":"h"}}]}}'


def put(spark, folder, *lines, mode="append"):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(mode).text(folder)


@pytest.fixture()
def store(spark, tmp):
    put(spark, f"{tmp}/store/{line_src.PRACTITIONER_MARKER}", practitioner("1"), practitioner("2"))
    return f"{tmp}/store"


def served(df):
    return sorted((r.practitioner, r.diagnosis, r.email, r.n_visits) for r in df.collect())


def run(spark, tmp, store, **options):
    return served(job.run_folder(spark, store, f"{tmp}/results", f"{tmp}/state", **options))


def test_a_folder_given_twice_adds_nothing(spark, tmp, store):
    put(spark, f"{store}/{line_src.ENCOUNTER_MARKER}a", visit("1", "flu"), visit("2", "flu"))
    want = [("1", "flu", "e", 1), ("2", "flu", "e", 1)]
    assert run(spark, tmp, store) == want and run(spark, tmp, store) == want
    assert ledger.batches(spark, f"{tmp}/state") == [0]
    put(spark, f"{store}/{line_src.ENCOUNTER_MARKER}b", visit("1", "flu"), visit("1", "gout"))
    want = [("1", "flu", "e", 2), ("1", "gout", "e", 1), ("2", "flu", "e", 1)]
    assert run(spark, tmp, store) == want and run(spark, tmp, store) == want
    files = ledger.folded(spark, f"{tmp}/state").collect()
    assert sorted(r.batch for r in files) == [0, 1] and len({r.path for r in files}) == 2
    # other practitioners, no new files
    put(spark, f"{store}/{line_src.PRACTITIONER_MARKER}", practitioner("1", "new"), practitioner("2"), mode="overwrite")
    assert run(spark, tmp, store) == [("1", "flu", "new", 2), ("1", "gout", "new", 1), ("2", "flu", "e", 1)]


@pytest.mark.parametrize("where", ["append_delta", "keep_practitioners"])
def test_a_run_that_ended_early_is_repeated_with_its_files(spark, tmp, store, monkeypatch, where):
    put(spark, f"{store}/{line_src.ENCOUNTER_MARKER}a", visit("1", "flu"))
    run(spark, tmp, store)
    put(spark, f"{store}/{line_src.ENCOUNTER_MARKER}b", visit("1", "flu"), visit("2", "gout"))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(state, where, killed)
        with pytest.raises(KeyboardInterrupt):
            run(spark, tmp, store)
    put(spark, f"{store}/{line_src.ENCOUNTER_MARKER}c", visit("2", "gout"))
    for _ in range(2):                                          # the batch that ended early, then the file that came later
        out = run(spark, tmp, store)
    assert out == [("1", "flu", "e", 2), ("2", "gout", "e", 2)]
    rows = ledger.folded(spark, f"{tmp}/state").groupBy("path").count().collect()
    assert len(rows) == 3 and {r["count"] for r in rows} == {1}


def test_a_folded_file_that_changes_is_an_error(spark, tmp, store):
    put(spark, f"{store}/{line_src.ENCOUNTER_MARKER}a", visit("1", "flu"))
    run(spark, tmp, store)
    [path] = [r.path for r in ledger.folded(spark, f"{tmp}/state").collect()]
    with open(path.removeprefix("file:"), "a") as f:
        f.write(visit("1", "gout") + "\n")
    with pytest.raises(ValueError, match="has changed"):
        run(spark, tmp, store)


def test_rejects_and_totals_by_one_scan(spark, capsys):
    lines = line_src.read_lines(spark, SF)          # any text: the plan is what counts
    extract.tallied(lines, job.PAIR, "n_visits").explain()
    plan = capsys.readouterr().out
    assert plan.count("Scan text") == 1 and plan.count("from_json") == 1


@pytest.mark.parametrize("on_malformed", ["quarantine", "sentinel"])
def test_split_batch_is_totals_and_rejects(spark, on_malformed):
    lines = lines_df(spark, FIXTURE + FIXTURE[:3])
    seen = Observation("lines")
    totals, bad = job.split_batch(lines, "visits", on_malformed, seen)
    want = job.totals(lines, "visits", on_malformed)
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, want.collect()))
    want = extract.rejects(lines).select("value", "file_path", "module")
    assert sorted(map(tuple, bad.collect())) == sorted(map(tuple, want.collect()))
    assert seen.get == {"accepted": len(GOOD) + 1, "rejected": len(FIXTURE) - len(GOOD) + 2}


def test_practitioners_and_their_rejects(spark):
    lines = lines_df(spark, [practitioner("1"), practitioner("1", "x"), "{bad", '{"identifier":"3"}'])
    for duplicates in ("keep", "latest"):
        prac, bad = job.split_practitioners(lines, "quarantine", duplicates)
        want = extract.practitioners(lines, duplicates=duplicates)
        assert sorted(map(tuple, prac.collect())) == sorted(map(tuple, want.collect()))
        assert sorted(r.value for r in bad.collect()) == ['{"identifier":"3"}', "{bad"]


def test_rejects_of_a_folder_by_batch(spark, tmp, store):
    for name in ("a", "b"):
        put(spark, f"{store}/{line_src.ENCOUNTER_MARKER}{name}", visit("1", "flu"), "{" + name)
        run(spark, tmp, store, rejects_path=f"{tmp}/rejects")
    rows = spark.read.schema("value string, batch_id int, module string").parquet(f"{tmp}/rejects").collect()
    assert sorted((r.value, r.batch_id, r.module) for r in rows) == [("{a", 0, "encounter"), ("{b", 1, "encounter")]


def test_a_stream_keeps_the_served_table_and_sets_rejects_aside(spark, tmp):
    put(spark, f"{tmp}/prac", practitioner("1"), practitioner("2"))
    options = {"rejects_path": f"{tmp}/rejects", "compact_every": 2}
    want = {}
    for k, d in enumerate(["flu", "gout", "flu", "cold"]):
        put(spark, f"{tmp}/in/{k}", visit("1", d), visit("3", d), f"{{{k}")     # 3 has no record
        want[d] = want.get(d, 0) + 1
        if k == 2:
            put(spark, f"{tmp}/prac", practitioner("1", "new"), mode="overwrite")
        stream.run_served(spark, f"{tmp}/in", f"{tmp}/prac", f"{tmp}/ck", f"{tmp}/state", f"{tmp}/out", "visits", **options)
        email = "e" if k < 2 else "new"
        assert served(job.results(spark, f"{tmp}/out", "visits")) == sorted(("1", x, email, n) for x, n in want.items())
    bad = stream.read_rejects(spark, f"{tmp}/rejects").collect()
    assert sorted((r.value, r.batch_id) for r in bad) == [(f"{{{k}", k) for k in range(4)]
    stream.run_served(spark, f"{tmp}/in", f"{tmp}/prac", f"{tmp}/ck", f"{tmp}/state", f"{tmp}/out", "visits", **options)
    assert stream.read_rejects(spark, f"{tmp}/rejects").count() == 4


def test_the_stream_serves_what_the_batch_build_serves(spark):
    want = catalog.q_enriched_visits_and_patients(spark, SF)
    got = catalog.q_stream_served_table(spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert star.N_SLICES == 3 and got.select(F.col("diagnosis")).distinct().count() > 3
