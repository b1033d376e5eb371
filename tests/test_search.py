"""Search fixtures (FIXTURES section 5) and the soft intersection against its
rule stated over sets."""

import itertools
import random

import pytest

from caseload.operators import search
from caseload.schemas import RESULTS

ROWS = [
    ("1", 12, "ana reyes", "areyes@a.example", "st. orla's clinic", "hay fever"),
    ("1", 9, "ana reyes", "areyes@a.example", "st. orla's clinic", "sprain"),
    ("2", 12, "anna reyes", "areyes@b.example", "north-east/lake centre", "hay fever"),
    ("3", 7, "tom vale", "tvale@a.example", "north-east/lake centre", "hay fever"),
    ("3", 7, "tom vale", "tvale@a.example", "north-east/lake centre", "sprain"),
    ("4", 5, "bertholdt quimby", "bquimby@a.example", "st. orla's clinic", "hay fever"),
]


@pytest.fixture(scope="module")
def res(spark):
    return spark.createDataFrame(ROWS, RESULTS)


def run(spark, res, q, **kw):
    out = search.search(res, search.make_queries(spark, [("q",) + q]), **kw).collect()
    titles = [r.line for r in sorted(out, key=lambda r: r.ord) if r.kind == "title"]
    lines = [r.line for r in sorted(out, key=lambda r: r.ord) if r.kind == "result"]
    return titles, lines


def test_transposition_counts_one(spark, res):
    titles, lines = run(spark, res, ("Hya Fevre", "", ""))
    assert titles == ["Disease Query: Hya Fevre", "Searching Disease: hay fever", "\nResults:\n"]
    assert lines == ["Dr. ana reyes, 12 patients, St. Orla'S Clinic, areyes@a.example",
                     "Dr. anna reyes, 12 patients, North-East/Lake Centre, areyes@b.example",
                     "Dr. tom vale, 7 patients, North-East/Lake Centre, tvale@a.example",
                     "Dr. bertholdt quimby, 5 patients, St. Orla'S Clinic, bquimby@a.example"]
    # pure Levenshtein: two swaps are 4 edits, no diagnosis match -> nothing
    titles, lines = run(spark, res, ("hya fevre", "", ""), transpositions=False)
    assert titles == ["\nResults:\n"] and lines == ["NONE"]


def test_distance_limits(spark, res):
    assert run(spark, res, ("spraxx", "", ""))[1][0].startswith("Dr. ana reyes, 9 patients")  # 2 edits
    assert run(spark, res, ("spxxxn", "", ""))[1] == ["NONE"]                                 # 3 edits
    assert run(spark, res, ("", "", "st. orla's clinix"))[1] != ["NONE"]                       # hospital 1 edit
    assert run(spark, res, ("", "", "xt. orla's clinix"))[1] != ["NONE"]                       # token-wise 1 edit
    assert run(spark, res, ("", "", "clinxx"))[1] == ["NONE"]                                  # hospital 2 edits
    assert run(spark, res, ("", "a", ""))[1] == ["NONE"]                                       # one letter


def test_blank_query(spark, res):
    assert run(spark, res, ("", "", "")) == (["\nResults:\n"], ["NONE"])


def test_ignored_list_when_it_contradicts(spark, res):
    # diagnosis sprain hits ana(9) and tom(7); name "bertholdt quimby" hits only a hay fever row -> ignored
    titles, lines = run(spark, res, ("sprain", "bertholdt quimby", ""))
    assert lines == ["Dr. ana reyes, 9 patients, St. Orla'S Clinic, areyes@a.example",
                     "Dr. tom vale, 7 patients, North-East/Lake Centre, tvale@a.example"]


def test_intersection_narrows(spark, res):
    # "anna" is 1 edit from "ana": name hits include ana(9), so only ana(9) is kept
    assert run(spark, res, ("sprain", "anna", ""))[1] == [
        "Dr. ana reyes, 9 patients, St. Orla'S Clinic, areyes@a.example"]


def test_without_diagnosis_distinct_lines(spark, res):
    titles, lines = run(spark, res, ("", "reyes", ""))
    assert titles == ["\nResults:\n"]
    assert lines == ["Dr. ana reyes, St. Orla'S Clinic, areyes@a.example",
                     "Dr. anna reyes, North-East/Lake Centre, areyes@b.example"]


def test_more_than_ten_hits_and_ties(spark):
    rows = [(str(i), 5 + (i % 3), f"doc{i:02d} smith", f"d{i}@x", "lake centre", "gout") for i in range(25)]
    res = spark.createDataFrame(rows, RESULTS)
    titles, lines = run(spark, res, ("GOUT", "", ""))
    want = sorted(rows, key=lambda r: (-r[1], r[2], r[4], r[3]))[:10]
    assert lines == [f"Dr. {r[2]}, {r[1]} patients, Lake Centre, {r[3]}" for r in want]


def required_lists(lists):
    """Which lists count: of all choices of lists with a common element, the
    one that is first when earlier lists matter more."""
    choices = [c for c in itertools.product((True, False), repeat=len(lists))
               if any(c) and set.intersection(*[set(x) for x, on in zip(lists, c) if on])]
    return max(choices, default=(False,) * len(lists))


def kept(lists):
    chosen = [set(x) for x, on in zip(lists, required_lists(lists)) if on]
    return set.intersection(*chosen) if chosen else set()


def test_soft_intersection_matches_its_rule(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for qi in range(60):
        universe = [f"t{j}" for j in range(8)]
        lists = [rnd.sample(universe, rnd.randint(0, 5)) for _ in range(3)]
        want[f"q{qi}"] = kept(lists)
        for t in universe:
            mask = sum(bit for bit, lst in zip((4, 2, 1), lists) if t in lst)
            if mask:
                rows.append((f"q{qi}", t, 1, "h", "e", mask))
    hits = spark.createDataFrame(rows, "query_id string, full_name string, n_visits long, hospital string, "
                                       "email string, mask int")
    got = {}
    for r in search.soft_intersect(hits).collect():
        got.setdefault(r.query_id, set()).add(r.full_name)
    assert {q: s for q, s in want.items() if s} == got


def test_batch_equals_single_queries(spark, res):
    qs = [("a", "hay fevr", "tom", ""), ("b", "", "reyes", "lake"), ("c", "", "", "")]
    batch = search.search(res, search.make_queries(spark, qs)).collect()
    for q in qs:
        single = search.search(res, search.make_queries(spark, [q])).collect()
        assert sorted(tuple(r) for r in single) == sorted(tuple(r) for r in batch if r.query_id == q[0])


def test_null_fields_do_not_hide_the_others(spark, res):
    q = spark.createDataFrame([("n", "hay fever", None, None)], search.QUERIES)
    out = [r.line for r in search.search(res, q).collect() if r.kind == "title"]
    assert "Searching Disease: hay fever" in out
    from caseload.schemas import RESULTS
    res2 = res.unionByName(spark.createDataFrame([("9", 3, None, "x@y", None, "hay fever")], RESULTS))
    hits = search.combine(search.query_matches(q, res2), res2)
    assert hits.where("n_visits = 3").count() == 1


def test_joins_of_either_kind_give_the_same_answers(spark):
    """Matches broadcast by their size or joined by shuffle: one answer."""
    from conftest import SF
    from caseload.plans import catalog
    res = catalog.served_results(spark, SF)
    qs = catalog.batch_queries(spark, SF)
    small = sorted(map(tuple, search.search(res, qs).collect()))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        large = sorted(map(tuple, search.search(res, qs).collect()))
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert small == large and len(small) > 0


def test_a_diagnosis_search_prunes_the_served_table(spark, capsys):
    from conftest import SF
    from caseload.plans import catalog
    res = catalog.served_results(spark, SF)
    q = search.make_queries(spark, [("q", "cold widget", "", "")])
    search.combine(search.query_matches(q, res), res).explain()
    assert "dynamicpruning" in capsys.readouterr().out


def test_ranked_by_patients_where_the_results_count_them(spark):
    from caseload.schemas import RESULTS_TWO_METRICS
    rows = [("1", 3, 30, "ana reyes", "a@x", "lake", "gout"), ("2", 5, 6, "tom vale", "t@x", "lake", "gout")]
    res = spark.createDataFrame(rows, RESULTS_TWO_METRICS)
    assert run(spark, res, ("gout", "", ""))[1] == ["Dr. tom vale, 5 patients, Lake, t@x",
                                                    "Dr. ana reyes, 3 patients, Lake, a@x"]


def test_hit_identity(spark):
    from caseload.schemas import RESULTS
    rows = [("1", 4, "kim park", "k@x", "lake", "gout"), ("2", 4, "kim park", "k@x", "lake", "gout")]
    res = spark.createDataFrame(rows, RESULTS)
    q = search.make_queries(spark, [("q", "gout", "", "")])
    m = search.query_matches(q, res)
    assert search.combine(m, res).count() == 1                                  # same served tuple: one hit
    assert search.combine(m, res, identity="practitioner").count() == 2
    lines = [r.line for r in search.search(res, q, identity="practitioner").collect() if r.kind == "result"]
    assert lines == ["Dr. kim park, 4 patients, Lake, k@x"] * 2


def osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_a_batch_searches_every_name(spark):
    """The turned queries by name, against brute force."""
    from conftest import SF
    from caseload.functions import text
    from caseload.plans import catalog
    asked = catalog.turned_queries(spark, SF).collect()
    out = catalog.QUERIES["turned_search"](spark, SF).where("kind = 'result'").collect()
    assert {r.query_id for r in out} == {q.query_id for q in asked}
    got = {}
    for r in sorted(out, key=lambda r: r.ord):
        got.setdefault(r.query_id, []).append(r.line)
    rows = catalog.results(spark, SF).select(
        "full_name", "n_visits", text.line_without_count("full_name", "hospital", "email").alias("line")).collect()
    near = lambda a, b: osa(a, b) <= min(search.FUZZINESS["full_name"], min(len(a), len(b)) - 1)
    names = {r.full_name for r in rows}
    by_name = [q for q in asked if q.full_name]
    assert by_name
    for q in by_name:
        hit = {n for n in names if any(near(a, b) for a in q.full_name.split() for b in n.split())}
        best = {}
        for r in rows:
            if r.full_name in hit:
                best[r.line] = max(best.get(r.line, 0), r.n_visits)
        assert got[q.query_id] == (sorted(best, key=lambda x: (-best[x], x))[:10] or ["NONE"])


def test_matches_of_a_field_are_read_and_planned_by_its_files_alone(spark, res):
    """the many matches of names are not shuffled to leave out the few
    queries that matched a diagnosis."""
    q = search.make_queries(spark, [("d", "hay fever", "", ""), ("n", "", "reyes vale", ""), ("h", "", "", "clinic lake")])
    matches = search.query_matches(q, res)
    of_diagnosis, other = search._split(matches)
    assert of_diagnosis.inputFiles() and not set(of_diagnosis.inputFiles()) & set(other.inputFiles())
    assert sorted(tuple(r) for r in of_diagnosis.collect()) == [("d", "hay fever")]
    assert {(r.query_id, r.field) for r in other.collect()} == {("n", "full_name"), ("h", "hospital")}
    none = search.query_matches(search.make_queries(spark, [("x", "qqqqqqqq", "", "")]), res)
    assert none.columns == matches.columns and none.collect() == []


@pytest.fixture(scope="module")
def many(spark):
    """Names that share few words, so that some words are held by many lines and most by one or two."""
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        name = f"{rnd.choice(['smith', 'smyth', 'reyes', 'vale'])} {rnd.randint(100, 399)} {rnd.choice(['jo', 'kim', 'lee', ''])}".strip()
        hospital = f"{rnd.choice(['lake', 'lane', 'north', 'nowhere'])} {rnd.choice(['clinic', 'centre'])}"
        for d in rnd.sample(["gout", "hay fever", "sprain"], 2):
            rows.append((str(i), rnd.randint(1, 12), name, f"m{i % 50}@x", hospital, d))
    return spark.createDataFrame(rows, RESULTS)


def test_an_index_gives_the_answers_of_a_whole_matching(spark, many):
    """names left out by their best line change no answer, whatever the fields of a query."""
    rnd = random.Random(9)
    asked = [(f"q{i}", rnd.choice(["", "", "", "gotu", "xxxx"]),
              " ".join(filter(None, [rnd.choice(["smiht", "ryes", "", "qqqqqq"]), rnd.choice(["", str(rnd.randint(100, 399))])])),
              rnd.choice(["", "", "laek", "clinci", "nrth centre", "zzzzzz"])) for i in range(120)]
    asked += [("a", "", "123", ""), ("b", "", "123", "laek"), ("c", "", "smiht 123", "zzzzzz"), ("d", "gotu", "smiht 123", "laek"),
              ("e", "", "", "")]
    queries = search.make_queries(spark, asked)
    whole = sorted(map(tuple, search.search(many, queries).collect()))
    indexed = sorted(map(tuple, search.search(many, queries, index=search.best_lines(many)).collect()))
    assert whole == indexed and len(whole) > len(asked)


def test_names_that_cannot_reach_the_lines_shown_are_not_matched(spark, many):
    """a query that a frequent name gives ten lines matches few of the others; one without is matched with all."""
    asked = [("f", "", "smiht 222", ""), ("g", "", "223", ""), ("h", "gotu", "smiht 224", ""), ("i", "", "smiht 225", "qqqqqq")]
    queries = search.make_queries(spark, asked)
    count = lambda m: {r.query_id: r["count"] for r in m.where("field = 'full_name'").groupBy("query_id").count().collect()}
    whole = count(search.query_matches(queries, many))
    few = count(search.reaching_matches(queries, many, search.best_lines(many)))
    assert few["g"] == whole["g"] and few["h"] == whole["h"]
    assert few["f"] < whole["f"] / 2 and few["i"] < whole["i"] / 2
