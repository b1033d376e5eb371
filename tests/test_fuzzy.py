"""Deletion-neighbourhood candidates + exact distance equal a
brute-force scan of the whole vocabulary."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from caseload.functions import fuzzy
from caseload.operators import search


def lev(a, b):
    d = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        prev, d[0] = d[0], i
        for j, cb in enumerate(b, 1):
            cur = min(d[j] + 1, d[j - 1] + 1, prev + (ca != cb))
            prev, d[j] = d[j], cur
    return d[-1]


def spark_osa(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    return [r.d for r in df.select(fuzzy.osa(F.col("a"), F.col("b")).alias("d")).collect()]


def test_osa(spark):
    cases = [("ab", "ba", 1), ("ca", "abc", 3), ("hya fever", "hay fever", 1), ("hya fevre", "hay fever", 2),
             ("", "abc", 3), ("abc", "", 3), ("", "", 0), ("kitten", "sitting", 3)]
    assert spark_osa(spark, [c[:2] for c in cases]) == [c[2] for c in cases]


def test_deletion_variants(spark):
    df = spark.createDataFrame([("abcd",), ("ab",), ("a",)], "t string")
    got = {r.t: set(r.v) for r in df.select("t", fuzzy.deletion_variants("t", 2).alias("v")).collect()}
    assert got["a"] == {"a"}
    assert got["ab"] == {"ab", "a", "b"}
    want = {"abcd"} | {"".join(c) for n in (2, 3) for c in itertools.combinations("abcd", n)}
    assert got["abcd"] == want


def _brute(terms, vocab, k, dist):
    out = set()
    for t in terms:
        for v in vocab:
            d = dist(t, v)
            if d <= k and d < min(len(t), len(v)):
                out.add((t, v, d))
    return out


@pytest.mark.parametrize("transpositions", [False, True])
def test_expand_terms_equals_brute_force(spark, transpositions):
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 7))) for _ in range(250)]
    vocab = sorted(set(words[:180]))
    terms = sorted(set(words[150:]))
    for field, k in (("diagnosis", 2), ("hospital", 1), ("hospital", 3)):
        t = spark.createDataFrame([(field, w) for w in terms], "field string, term string")
        v = spark.createDataFrame([(field, w) for w in vocab], "field string, term string")
        got = {(r.term, r.match, r.distance) for r in
               search.expand_terms(t, v, {field: k}, None, transpositions).collect()}
        assert got == _brute(terms, vocab, k, _osa_recursive if transpositions else lev)


def test_cap_keeps_closest(spark):
    vocab = ["abcd", "abce", "abcf", "abxy", "abcd1"]
    t = spark.createDataFrame([("full_name", "abcd")], "field string, term string")
    v = spark.createDataFrame([("full_name", w) for w in vocab], "field string, term string")
    got = [(r.match, r.distance) for r in
           search.expand_terms(t, v, {"full_name": 2}, 3, False).orderBy("distance", "match").collect()]
    # similarity 1 - d/min(len): abcd (1.0), abcd1 (0.75, min len 4), abce / abcf (0.75) -> ties by term
    assert got == [("abcd", 0), ("abcd1", 1), ("abce", 1)]


def _osa_recursive(a, b):
    """Restricted edit distance by its recursive definition (independent of
    the table-filling implementation)."""
    from functools import lru_cache

    @lru_cache(maxsize=None)
    def d(i, j):
        if i == 0:
            return j
        if j == 0:
            return i
        best = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            best = min(best, d(i - 2, j - 2) + 1)
        return best

    return d(len(a), len(b))


def test_osa_matches_definition(spark):
    rnd = random.Random(5)
    pairs = [tuple("".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 7))) for _ in range(2)) for _ in range(600)]
    got = spark_osa(spark, pairs)
    assert got == [_osa_recursive(a, b) for a, b in pairs]
    # a transposition saves at most one of two edits
    assert all(d <= lev(a, b) <= 2 * d for d, (a, b) in zip(got, pairs))


def test_every_match_counts_without_a_cap(spark):
    vocab = [f"{i:09d}" for i in range(400)]
    t = spark.createDataFrame([("full_name", "000000042")], "field string, term string")
    v = spark.createDataFrame([("full_name", w) for w in vocab], "field string, term string")
    got = {r.match for r in search.expand_terms(t, v, {"full_name": 2}).collect()}
    assert got == {w for w in vocab if _osa_recursive("000000042", w) <= 2} and len(got) > 50


def test_no_python_in_the_distance(spark, capsys):
    t = spark.createDataFrame([("full_name", "abcd")], "field string, term string")
    search.expand_terms(t, t, {"full_name": 2}).explain()
    plan = capsys.readouterr().out
    assert "ArrowEvalPython" not in plan and plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") == 1


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_only_near_texts_meet(spark, k):
    """Numbers of five digits: very many pairs lack two characters of the same text, few of them are near."""
    rnd = random.Random(3)
    words = sorted({f"{rnd.randrange(100000):05d}" for _ in range(300)} | {"7", "77", "778"})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    sides = [df.select(F.col("w").alias(name), F.explode(fuzzy.meeting_keys(F.col("w"), k, name == "a")).alias("key"))
             for name in ("a", "b")]
    met = {(r.a, r.b) for r in sides[0].join(sides[1], "key").select("a", "b").distinct().collect()}
    near = {(a, b) for a in words for b in words if lev(a, b) <= k and lev(a, b) < min(len(a), len(b))}
    assert near <= met and len(met) <= 1.5 * len(near)


def test_transpositions_without_a_matrix(spark, capsys):
    """Up to two edits, parts before and after the turned pair are compared; no matrix is filled row by row."""
    t = spark.createDataFrame([("full_name", "abcd")], "field string, term string")
    search.expand_terms(t, t, {"full_name": 2}).explain("extended")
    assert "aggregate(" not in capsys.readouterr().out.split("== Optimized Logical Plan ==")[1]
