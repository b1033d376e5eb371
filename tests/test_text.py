"""C2 title case, C3/C4 lines, C14 tokens."""

import random
import string

from pyspark.sql import functions as F

from caseload.functions import text


def _one(spark, col, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(col).collect()]


def test_title_case_examples(spark):
    vals = ["st. orla's clinic", "north-east/lake centre", "3rd floor", "mount sinai st. luke's",
            "middle east-nation_3", "", "ALL CAPS"]
    assert _one(spark, text.title_case("x"), vals) == [v.title() for v in vals]


def test_title_case_matches_python_on_random_ascii(spark):
    rnd = random.Random(7)
    alphabet = string.ascii_letters + string.digits + " -/.'_"
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 15))) for _ in range(300)]
    assert _one(spark, text.title_case("x"), vals) == [v.title() for v in vals]


def test_tokens(spark):
    got = _one(spark, text.tokens("x"), ["New York-Presbyterian/Columbia St. Luke's 3rd"])
    assert got == [["new", "york", "presbyterian", "columbia", "st", "luke's", "3rd"]]


def test_lines(spark):
    df = spark.createDataFrame([("ana reyes", 12, "st. orla's clinic", "a@x")], "n string, c long, h string, e string")
    r = df.select(text.line_with_count("n", "c", "h", "e").alias("a"),
                  text.line_without_count("n", "h", "e").alias("b")).first()
    assert r.a == "Dr. ana reyes, 12 patients, St. Orla'S Clinic, a@x"
    assert r.b == "Dr. ana reyes, St. Orla'S Clinic, a@x"
    assert F is not None
