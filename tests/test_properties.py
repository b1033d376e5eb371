"""Properties of SURVEY section 5 over the driver tables."""

from pyspark.sql import functions as F

from conftest import SF, lines_df

from caseload.operators import aggregate, enrich, extract
from caseload.plans import catalog
from caseload.sources import star


def test_sum_of_visits_is_number_of_accepted_lines(spark):
    lines = star.encounter_lines(spark, SF, damaged=True)
    enc = extract.encounters(lines)
    total = aggregate.visit_counts(enc).agg(F.sum("n_visits")).first()[0]
    assert total == enc.count() == lines.count() - extract.rejects(lines).count()


def test_enrich_never_adds_rows_with_unique_ids(spark):
    prac = catalog.practitioners(spark, SF)
    assert enrich.duplicate_ids(prac).count() == 0
    totals = aggregate.visit_counts(catalog.encounters(spark, SF))
    assert enrich.enrich(totals, prac).count() <= totals.count()


def test_duplicate_ids_multiply_and_are_reported(spark):
    prac = catalog.practitioners(spark, SF)
    doubled = prac.unionByName(prac.where(F.col("practitioner") == "1"))
    totals = aggregate.visit_counts(catalog.encounters(spark, SF))
    n1 = totals.where(F.col("practitioner") == "1").count()
    assert enrich.enrich(totals, doubled).count() == enrich.enrich(totals, prac).count() + n1
    assert [r.practitioner for r in enrich.duplicate_ids(doubled).collect()] == ["1"]


def test_non_ascii_is_accepted(spark):
    line = '{"participant":[{"individual":"7"}],"diagnosis":[{"condition":"fièvre des foins"}],"subject":"1"}'
    got = extract.encounters(lines_df(spark, [line])).collect()
    assert [(r.practitioner, r.diagnosis) for r in got] == [("7", "fièvre des foins")]


def test_job_totals_sentinel_equals_registered_query(spark):
    from caseload.plans import job
    lines = star.encounter_lines(spark, SF, damaged=True)
    got = sorted(map(tuple, job.totals(lines, "visits", "sentinel").collect()))
    assert got == sorted(map(tuple, catalog.q_malformed_sentinel(spark, SF).collect()))
    assert any(r[0] == "0" and r[1] == "0" for r in got)


def test_long_running_stream_trigger(spark, tmp):
    from caseload.streaming import visits as stream
    star.write_ndjson(star.encounter_lines(spark, SF), f"{tmp}/in", "slice")
    q = stream.run_visit_counts(spark, f"{tmp}/in", f"{tmp}/ck", f"{tmp}/sink",
                                trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(map(tuple, stream.read_visit_counts(spark, f"{tmp}/sink").collect()))
    assert got == sorted(map(tuple, catalog.q_visit_counts(spark, SF).collect()))


def test_tasks_stay_small_in_a_session_without_a_size(spark):
    """Else AQE merges partitions up to 64 MB, and a task's memory grows with the input up to that."""
    import __spark_entry__
    from conftest import SF
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        for named, then in ((None, "16m"), ("8m", "8m")):
            spark.conf.unset(key) if named is None else spark.conf.set(key, named)
            __spark_entry__.queries()["parse_practitioners"](spark, SF)
            assert spark.conf.get(key) == then
    finally:
        spark.conf.set(key, before)


def test_shuffles_begin_with_enough_partitions_for_the_input(spark):
    """Else a session with few shuffle partitions gives each task a share of the input that grows with it."""
    from caseload.session import FIRST_PARTITIONS, bound_tasks
    try:
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        for gb in (1, 6):
            bound_tasks(spark, gb << 30)
            assert int(spark.conf.get(FIRST_PARTITIONS)) == gb * 4 * 64
            dealt = spark.range(1000).repartition("id")
            assert f", {gb * 256})" in dealt._jdf.queryExecution().executedPlan().toString()
        bound_tasks(spark, 1000)
        assert spark.conf.get(FIRST_PARTITIONS, None) is None
        spark.conf.set(FIRST_PARTITIONS, "7")  # named by the user
        bound_tasks(spark, 6 << 30)
        assert spark.conf.get(FIRST_PARTITIONS) == "7"
    finally:
        spark.conf.unset(FIRST_PARTITIONS)
        spark.conf.set("spark.sql.shuffle.partitions", before)
