"""Plan shape: the scale properties the design relies on, read from explain()."""

import re

import pytest

from conftest import SF

from caseload.operators import search
from caseload.plans import catalog


def plan(df, capsys, mode="formatted"):
    df.explain(mode)
    return capsys.readouterr().out


def test_scan_is_pruned_and_aggregation_is_partial(spark, capsys):
    p = plan(catalog.q_visit_counts(spark, SF), capsys)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in schemas
    assert "partial_count(1)" in p
    assert p.count("from_json(") == 1


def test_distinct_patients_in_two_partial_levels(spark, capsys):
    p = plan(catalog.q_visits_and_patients(spark, SF), capsys)
    assert "count(distinct" not in p.lower()
    assert "partial_count(1)" in p and "partial_sum(n_cases" in p
    # first shuffle spread over (practitioner, diagnosis, patient), second
    # over the pair carrying only partial counts
    assert re.search(r"hashpartitioning\(practitioner#\d+, diagnosis#\d+, patient#\d+, \d+\)", p)
    assert re.search(r"hashpartitioning\(practitioner#\d+, diagnosis#\d+, \d+\)", p)


def test_search_has_no_all_pairs_join(spark, capsys):
    res = catalog.results(spark, SF)
    q = catalog.batch_queries(spark, SF)
    p = plan(search.search(res, q, transpositions=False), capsys, "extended")
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "WindowGroupLimit" in p          # per-query top-k is partial
    assert "partial_bit_or" in p


@pytest.mark.parametrize("name", ["result_documents", "state_documents"])
def test_ordinals_read_one_checkpointed_copy(spark, capsys, name):
    """Both branches of the ordinal (counts, final join) read the same
    checkpointed, range-sorted rows; no row_number over a whole group."""
    p = plan(catalog.QUERIES[name](spark, SF), capsys)
    assert p.split("(1) ")[0].count("Scan ExistingRDD") == 1    # the counts were read from it before
    assert "row_number" not in p
    assert "hashpartitioning" not in p              # the rows are not moved again


def test_no_forced_broadcast(spark, capsys):
    res = catalog.served_results(spark, SF)
    for df in (catalog.q_enriched_visits_and_patients(spark, SF), search.search(res, catalog.batch_queries(spark, SF))):
        p = plan(df, capsys, "extended")
        assert "BROADCAST" not in p.split("== Analyzed Logical Plan ==")[1].split("== Optimized")[0]


def test_fold_aggregates_once_whatever_the_number_of_parts(spark, capsys):
    from caseload.plans import state
    part = spark.createDataFrame([("1", "flu", 2)], "practitioner string, diagnosis string, n_visits long")
    p = plan(state.fold([part] * 5, ["practitioner", "diagnosis"], "n_visits"), capsys, "simple")
    assert p.count("Exchange") == 1


def test_a_batch_reads_only_the_diagnoses_it_touches(spark, capsys, tmp):
    from caseload.plans import job, state
    keys = ["practitioner", "diagnosis"]
    schema = "practitioner string, diagnosis string, n_visits long"
    state.append_delta(spark, spark.createDataFrame([("1", "flu", 2), ("1", "gout", 1)], schema), tmp, 0)
    batch = spark.createDataFrame([("1", "flu", 3)], schema)
    prac = spark.createDataFrame([("1", "ann", "a@x", "mercy")], "practitioner string, full_name string, email string, hospital string")
    state.keep_practitioners(prac, tmp)                                # the table that the last run served, unchanged
    touched = job._fold_batch(spark, batch, prac, tmp, 1, keys, "n_visits")
    assert [r["diagnosis"] for r in touched.distinct().collect()] == ["flu"]
    totals = state.read_totals(spark, tmp, keys, "n_visits", only=touched)
    assert sorted(map(tuple, totals.collect())) == [("1", "flu", 5)]
    assert "dynamicpruning" in plan(totals, capsys)


def test_a_stored_slice_is_one_partition(spark, capsys):
    p = plan(catalog.q_stored_slice(spark, SF), capsys)
    assert "PartitionFilters: [isnotnull(diagnosis" in p and "= cold widget)" in p


def test_streaming_aggregation_is_partial_before_state(spark, capsys, tmp):
    from caseload.operators import aggregate, extract
    from caseload.sources import star
    from caseload.streaming.visits import _lines
    star.write_ndjson(star.encounter_lines(spark, SF), f"{tmp}/in", "slice")
    counts = aggregate.visit_counts(extract.encounters(_lines(spark, f"{tmp}/in", 1)))
    assert counts.isStreaming
    counts.explain()
    p = capsys.readouterr().out
    assert "partial_count(1)" in p and "StateStoreSave" in p
    assert p.index("StateStoreSave") < p.index("partial_count(1)")   # partial agg sits below the state
