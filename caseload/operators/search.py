"""Typo-tolerant search over the results table (F2-F4, F7, J4, X2-X4, A7, A8,
O1-O4), for one query or a whole table of queries in one Spark plan.

Per query (``query_id, diagnosis, full_name, hospital``):

1. terms: the diagnosis text lower-cased is one whole term (value match);
   name and hospital texts are tokenised (token match, OR over tokens);
   blank fields give no terms.
2. expansion: every distinct query term is matched against the vocabulary of
   its field (distinct diagnoses / name tokens / hospital tokens of the
   results) -- distance ``<= k`` and ``< min(len)``.  All matches count;
   ``max_expansions`` keeps only the closest so many (similarity
   ``1 - d / min(len)``, ties by term), for those who ask for it.  Candidates
   come from an equi-join on deletion variants, never from comparing a term
   with the whole vocabulary.  The matches are written once: later steps read
   them several times, and know how large they are.  With a stored index the
   names that many rows hold are matched first, and other names only if their
   best line can be among the ``k`` that a query shows (``reaching_matches``).
3. hits: matched terms joined back to result rows; a hit is the tuple
   ``(full_name, count, hospital, email)`` with a bit per field
   (diagnosis 4, name 2, hospital 1), equal tuples merged with ``bit_or``.
   A query that matched a diagnosis keeps only hits of matched diagnoses
   (step 4), and the other bits hang on the tuple alone; so for such queries
   the results are read by diagnosis, with partition pruning, and only those
   rows are tokenised.  A query without one shows distinct lines by their best
   count, so top-k goes below the join: the ``k`` best lines of every term, and
   of every pair of a name and a hospital term that some tuple holds, are
   worked out once (``best_lines``) and merged per query (``merged_lines``).
   Steps 4 and 6 then take the pairs of a query if there are any, else its name
   terms, else its hospital terms.
4. soft intersection: for the fields in order diagnosis, name, hospital,
   intersect with the field's hits only when the intersection is non-empty.
5. label: the closest matched diagnosis (ties alphabetical), null if none.
6. rank: with a label, the top ``k`` tuples by count (ties by name, hospital,
   e-mail) as ``Dr. name, n patients, Hospital, email``; without, the top
   ``k`` distinct ``Dr. name, Hospital, email`` lines by their best count.

The count is ``n_patients`` where the results have it, else ``n_visits``.
Each step is a single join / aggregation, left to the planner; per-query top-k
uses ``row_number() <= k``, which Spark evaluates as a partial group limit
before the shuffle.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caseload.functions import fuzzy, text
from caseload.schemas import QUERIES
from caseload.session import path_exists, work_dir

# fixed values: searched fields, their fuzziness and hit bits
DIAGNOSIS, NAME, HOSPITAL = "diagnosis", "full_name", "hospital"
FIELDS = (DIAGNOSIS, NAME, HOSPITAL)
FUZZINESS = {DIAGNOSIS: 2, NAME: 2, HOSPITAL: 1}
FLAG = {DIAGNOSIS: 4, NAME: 2, HOSPITAL: 1}
TOP_K = 10


def metric_of(results: DataFrame) -> str:
    """The column that ranks hits."""
    return "n_patients" if "n_patients" in results.columns else "n_visits"


def hit_columns(results: DataFrame, identity: str = "tuple") -> list[str]:
    """What tells hits apart: the served tuple, or the practitioner too."""
    return ["full_name", metric_of(results), "hospital", "email"] + ["practitioner"] * (identity == "practitioner")


def make_queries(spark: SparkSession, rows) -> DataFrame:
    """Queries table from ``(query_id, diagnosis, full_name, hospital)`` rows."""
    return spark.createDataFrame(list(rows), QUERIES)


def _keys(fields, query_side: bool) -> Column:
    """array<struct<field, term>> of one row: the diagnosis as one whole term
    (lower-cased and trimmed on the query side, as stored on the data side),
    name and hospital as distinct tokens.  A null field contributes no terms
    (and does not null out the other fields' terms)."""
    def tagged(f):
        return lambda t: F.struct(F.lit(f).alias("field"), t.alias("term"))

    parts = []
    for f in fields:
        if f == DIAGNOSIS:
            v = F.lower(F.trim(F.col(f))) if query_side else F.col(f)
            parts.append(F.array(F.struct(F.lit(f).alias("field"), v.alias("term"))))
        else:
            toks = F.coalesce(text.tokens(f), F.array().cast("array<string>"))
            parts.append(F.transform(F.array_distinct(toks), tagged(f)))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _nonblank(df: DataFrame) -> DataFrame:
    return df.where(F.col("term").isNotNull() & (F.col("term") != ""))


def query_terms(queries: DataFrame, fields=FIELDS) -> DataFrame:
    """``query_id, field, term`` (F7: blank fields give no terms, C1 lower)."""
    return _nonblank(queries.select("query_id", F.inline(_keys(fields, True))))


def vocabulary(results: DataFrame, fields=FIELDS) -> DataFrame:
    """``field, term``: distinct diagnoses and distinct name / hospital tokens."""
    return _nonblank(results.select(F.inline(_keys(fields, False)))).distinct()


def _k_of(fuzziness: dict) -> Column:
    k = F.lit(None).cast("int")
    for f, v in fuzziness.items():
        k = F.when(F.col("field") == f, F.lit(v)).otherwise(k)
    return k


def _meeting(terms: DataFrame, text: str, fuzziness: dict, query_side: bool, apart=()) -> DataFrame:
    """``terms`` once per key by which its column ``text`` can meet a text at a
    distance up to ``_left`` (``fuzzy.meeting_keys``) and of the same ``apart``;
    keys are 64-bit hashes.

    Distinct terms are few bytes, which AQE puts into one task, but their keys
    are many: the terms are dealt to all cores first.  The keys are dealt out
    before the join, which is then planned by their size, not that of the terms."""
    terms = terms.repartition(terms.sparkSession.sparkContext.defaultParallelism, text)
    keys = F.lit(None).cast("array<struct<kind: string, key: string>>")
    for left in range(max(fuzziness.values()) + 1):
        keys = F.when(F.col("_left") == left, fuzzy.meeting_keys(F.col(text), left, query_side)).otherwise(keys)
    return (terms.withColumn("_met", F.explode(keys))
                 .withColumn("_key", F.xxhash64("field", *apart, "_left", "_met.kind", "_met.key"))
                 .drop("_met", "_left", *apart)
                 .repartition("_key", "field"))


def expand_terms(terms: DataFrame, vocab: DataFrame, fuzziness: dict | None = None,
                 max_expansions: int | None = None, transpositions: bool = True) -> DataFrame:
    """F2-F4 + O4: ``field, term, match, distance`` for distinct query terms.

    ``terms`` and ``vocab`` both carry ``field, term``.  A match needs
    ``distance <= k(field)`` and ``distance < min(len(term), len(match))``;
    with ``max_expansions`` only so many matches per term are kept.

    If ``terms`` also carry ``least`` and ``vocab`` carries ``best``, a term
    matches only what is as good as the lowest ``least`` it has (null: all).
    """
    fuzziness = dict(fuzziness or FUZZINESS)
    most = max(fuzziness.values())
    apart = bound = ()
    distinct = terms.select("field", "term").distinct()
    if "least" in terms.columns:
        if max_expansions is not None:
            raise ValueError("the closest of all matches are not known among the good ones")
        apart, bound = ("_bounded",), ("least", "_bounded")
        lowest = F.when(F.count("least") == F.count(F.lit(1)), F.min("least"))
        distinct = (terms.groupBy("field", "term").agg(lowest.alias("least"))
                         .withColumn("_bounded", F.col("least").isNotNull()))
        # one row for the terms with a bound, one for those without: what no term can match gets no keys
        lowest = distinct.groupBy("_bounded").agg(F.min("least").alias("_lowest"))
        vocab = vocab.join(lowest, ~F.col("_bounded") | (F.col("best") >= F.col("_lowest")))
    # a term, or one of its forms with neighbours turned round, has so many other edits left; the
    # terms are few bytes, which AQE puts into one task, and are dealt out before they are turned
    dealt = distinct.repartition(terms.sparkSession.sparkContext.defaultParallelism, "field", "term")
    forms = dealt.withColumn("_form", F.explode(fuzzy.swapped(F.col("term"), most if transpositions else 0)))
    forms = (forms.select("field", "term", *bound, "_form.*").withColumn("_left", _k_of(fuzziness) - F.col("swaps"))
                  .where(F.col("_left") >= 0))
    lefts = F.sequence(F.lit(0) if transpositions else _k_of(fuzziness), _k_of(fuzziness))
    theirs = _meeting(vocab.select("field", F.col("term").alias("match"), *(("best", "_bounded") if bound else ()),
                                   F.explode(lefts).alias("_left")), "match", fuzziness, False, apart)
    minlen = F.least(F.length("term"), F.length("match"))
    # the distance comes out of a generator: the filter above it does not work it out again
    distance = fuzzy.swapped_distance(F.col("term"), F.col("form"), F.col("swaps"), F.col("at"), F.col("match"), most)
    met = _meeting(forms, "form", fuzziness, True, apart).join(theirs, ["_key", "field"])
    if bound:
        met = met.where(F.col("least").isNull() | (F.col("best") >= F.col("least")))
    near = (met.select("field", "term", "match", F.explode(F.array(distance.cast("bigint"))).alias("distance"))
               .where((F.col("distance") <= _k_of(fuzziness)) & (F.col("distance") < minlen)))
    # dealt by pair: a term that is near very many others is spread as well
    kept = (near.repartition("field", "term", "match")
                .groupBy("field", "term", "match").agg(F.min("distance").alias("distance")))
    if max_expansions is not None:
        sim = 1 - F.col("distance") / minlen
        w = Window.partitionBy("field", "term").orderBy(sim.desc(), F.col("match"))
        kept = kept.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_expansions)
    return kept.select("field", "term", "match", "distance")


def query_matches(queries: DataFrame, results: DataFrame, fuzziness: dict | None = None,
                  max_expansions: int | None = None, transpositions: bool = True) -> DataFrame:
    """``query_id, field, match, distance`` for every query (J4's key side), as
    a table written by field: what reads the matches of one field reads, and is
    planned by the size of, that folder alone."""
    fuzziness = dict(fuzziness or FUZZINESS)
    fields = tuple(fuzziness)
    terms = query_terms(queries, fields)
    return _stored(terms, expand_terms(terms, vocabulary(results, fields), fuzziness, max_expansions, transpositions), fields)


def _stored(terms: DataFrame, expanded: DataFrame, fields) -> DataFrame:
    """The matches of the queries' terms, written by field."""
    matches = (terms.select("query_id", "field", "term").join(expanded, ["field", "term"])
                    .groupBy("query_id", "field", "match").agg(F.min("distance").alias("distance")))
    spark, path = terms.sparkSession, work_dir(terms.sparkSession, "matches")
    matches.write.partitionBy("field").parquet(path)
    stored = matches.where(F.lit(False))  # planned as empty, where no field has a match
    columns = [c for c in matches.schema if c.name != "field"]
    for f in fields:
        if path_exists(spark, f"{path}/field={f}"):
            stored = stored.unionByName(spark.read.schema(StructType(columns)).parquet(f"{path}/field={f}")
                                        .select("query_id", F.lit(f).alias("field"), "match", "distance"))
    return stored


def _flag() -> Column:
    flag = F.lit(0)
    for f in FIELDS:
        flag = F.when(F.col("field") == f, F.lit(FLAG[f])).otherwise(flag)
    return flag


def combine(matches: DataFrame, results: DataFrame, identity: str = "tuple") -> DataFrame:
    """J4 + X2 + X3: one row per (query, hit tuple), ``mask`` = OR of the bits
    of the fields through which the tuple was hit -- for a query with a matched
    diagnosis only the tuples of matched diagnoses, the ones it can keep.

    The aggregation buffers are single ints, so they run as hash aggregates
    with a map-side partial step.  Joins carry no hint: a small matches table
    is broadcast by its size, so the result rows stream through in their own
    partitioning; a large one is joined by shuffle, and AQE splits the
    partitions of a term that very many rows hold.
    """
    hit = hit_columns(results, identity)
    of_diagnosis, other = _split(matches)
    rest = other.join(of_diagnosis.select("query_id"), "query_id", "left_anti").withColumnRenamed("match", "term")
    keyed = results.select(*hit, F.inline(_keys((NAME, HOSPITAL), False)))
    anywhere = keyed.join(rest, ["field", "term"]).select("query_id", *hit, _flag().alias("bit"))
    return (_narrowed(matches, results, hit).unionByName(anywhere)
            .groupBy("query_id", *hit).agg(F.bit_or("bit").alias("mask")))


def _split(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The diagnosis matches, and the others."""
    found = matches.select("query_id", "field", "match")
    # the comparison holds for every diagnosis; Spark prunes partitions only by a side that has a filter
    return (found.where((F.col("field") == DIAGNOSIS) & (F.col("match") >= "")).select("query_id", F.col("match").alias("diagnosis")),
            found.where(F.col("field") != DIAGNOSIS))


def _narrowed(matches: DataFrame, results: DataFrame, hit: list[str]) -> DataFrame:
    """``query_id``, hit columns and a bit for queries with a matched diagnosis:
    the rows of those diagnoses, pruned, and what else hits them."""
    of_diagnosis, other = _split(matches)
    other = other.join(of_diagnosis.select("query_id"), "query_id", "left_semi")
    rows = results.select(*hit, "diagnosis").join(of_diagnosis, "diagnosis").select("query_id", *hit).distinct()
    # only the rows of queries that also matched a name or a hospital are tokenised
    tokens = rows.join(other.select("query_id"), "query_id", "left_semi").select(
        "query_id", *hit, F.inline(_keys((NAME, HOSPITAL), False)))
    bits = tokens.join(other.withColumnRenamed("match", "term"), ["query_id", "field", "term"]).select(
        "query_id", *hit, _flag().alias("bit"))
    return rows.select("query_id", *hit, F.lit(FLAG[DIAGNOSIS]).alias("bit")).unionByName(bits)


# ---------------------------------------------------------------- queries without a diagnosis

_TERMS = ["name_term", "hospital_term"]  # "" stands for none: a token is never empty


def term_keys(matches: DataFrame) -> DataFrame:
    """``query_id, name_term, hospital_term, kind`` for queries without a
    matched diagnosis: each name term (kind 2), each hospital term (1) and each
    pair of both (3)."""
    of_diagnosis, other = _split(matches)
    rest = other.join(of_diagnosis.select("query_id"), "query_id", "left_anti")
    names = rest.where(F.col("field") == NAME).select("query_id", F.col("match").alias("name_term"))
    hospitals = rest.where(F.col("field") == HOSPITAL).select("query_id", F.col("match").alias("hospital_term"))
    none = F.lit("")
    return (names.select("query_id", "name_term", none.alias("hospital_term"), F.lit(2).alias("kind"))
            .unionByName(hospitals.select("query_id", none.alias("name_term"), "hospital_term", F.lit(1).alias("kind")))
            .unionByName(names.join(hospitals, "query_id").select("query_id", *_TERMS, F.lit(3).alias("kind"))))


def best_lines(results: DataFrame, k: int = TOP_K, only: DataFrame | None = None) -> DataFrame:
    """``name_term, hospital_term, line, best``: the ``k`` best lines of every
    name term, hospital term and pair of both, or of those that ``only`` holds,
    as a written table.  Stored without ``only`` it is the index of a batch of
    searches by name and hospital.

    One row per tuple and key reaches the aggregation whatever the number of
    queries, and of a term that very many tuples hold each task passes on ``k``
    lines."""
    metric = metric_of(results)
    tuples = results.groupBy("full_name", "hospital", "email").agg(F.max(metric).alias("best"))

    def own(field: str) -> Column:
        return F.array_distinct(F.coalesce(text.tokens(field), F.array().cast("array<string>")))

    def key(name: Column, hospital: Column) -> Column:
        return F.struct(name.alias("name_term"), hospital.alias("hospital_term"))

    names, hospitals, none = F.col("_names"), F.col("_hospitals"), F.lit("")
    keys = F.concat(F.transform(names, lambda n: key(n, none)), F.transform(hospitals, lambda h: key(none, h)),
                    F.flatten(F.transform(names, lambda n: F.transform(hospitals, lambda h: key(n, h)))))
    keyed = (tuples.select(text.line_without_count("full_name", "hospital", "email").alias("line"), "best",
                           own(NAME).alias("_names"), own(HOSPITAL).alias("_hospitals"))
             .select("line", "best", F.inline(keys)))
    if only is not None:
        keyed = keyed.join(only.select(*_TERMS).distinct(), _TERMS, "left_semi")
    lines = keyed.groupBy(*_TERMS, "line").agg(F.max("best").alias("best"))
    w = Window.partitionBy(*_TERMS).orderBy(F.desc("best"), "line")
    top = lines.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")
    path = work_dir(results.sparkSession, "best-lines")
    top.write.parquet(path)
    return results.sparkSession.read.schema(top.schema).parquet(path)


def key_bounds(lines: DataFrame, k: int = TOP_K) -> DataFrame:
    """``name_term, hospital_term, top, floor`` of ``best_lines``: the count of
    a key's best line, and of its ``k``-th (null with fewer lines)."""
    return lines.groupBy(*_TERMS).agg(F.max("best").alias("top"), F.when(F.count(F.lit(1)) >= k, F.min("best")).alias("floor"))


def reaching_matches(queries: DataFrame, results: DataFrame, index: DataFrame, k: int = TOP_K,
                     transpositions: bool = True) -> DataFrame:
    """``query_matches`` without the name matches that cannot change what a
    search with the ``index`` (``best_lines``) shows.

    Names with ``k`` lines or more are matched first, and so are diagnoses and
    hospitals.  A query without a diagnosis that they give ``k`` lines of its
    kind of key (``term_keys``) -- pairs, or names if no hospital matched --
    shows nothing below the last of these, so of the other names it is matched
    with those alone whose best line is as good.  They have fewer than ``k``
    lines, so they give no bound of their own.  All other queries are matched
    with every name."""
    bounds = key_bounds(index, k)
    names = bounds.where((F.col("hospital_term") == "") & (F.col("name_term") != ""))
    hospitals = bounds.where((F.col("name_term") == "") & (F.col("hospital_term") != ""))
    frequent = (vocabulary(results, (DIAGNOSIS,))
                .unionByName(hospitals.select(F.lit(HOSPITAL).alias("field"), F.col("hospital_term").alias("term")))
                .unionByName(names.where(F.col("floor").isNotNull()).select(F.lit(NAME).alias("field"), F.col("name_term").alias("term"))))
    terms = query_terms(queries)
    first = _stored(terms, expand_terms(terms, frequent, None, None, transpositions), FIELDS)

    most = term_keys(first).join(bounds, _TERMS).groupBy("query_id").agg(F.max(F.struct("kind", "floor")).alias("most"))
    near_hospital = first.where(F.col("field") == HOSPITAL).select("query_id").distinct().withColumn("_near", F.lit(True))
    kind = F.when(F.col("_near"), F.lit(3)).otherwise(F.lit(2))
    least = (most.join(near_hospital, "query_id", "left").where(F.col("most.kind") == kind)
                 .select("query_id", F.col("most.floor").alias("least")))
    path = work_dir(results.sparkSession, "bounded-terms")
    bounded = query_terms(queries, (NAME,)).join(least, "query_id", "left")
    bounded.write.parquet(path)
    bounded = results.sparkSession.read.schema(bounded.schema).parquet(path)
    others = names.where(F.col("floor").isNull()).select(
        F.lit(NAME).alias("field"), F.col("name_term").alias("term"), F.col("top").alias("best"))
    rest = expand_terms(bounded, others, {NAME: FUZZINESS[NAME]}, None, transpositions)
    return first.unionByName(_stored(bounded, rest, (NAME,)))


def merged_lines(keys: DataFrame, lines: DataFrame, k: int = TOP_K) -> DataFrame:
    """``query_id, line, best`` of the lines that can be among a query's ``k``
    best: from the keys of the largest kind that it has (``term_keys``), but
    for those whose best line is below the ``k``-th of another key."""
    found = keys.join(key_bounds(lines, k), _TERMS)
    largest = found.groupBy("query_id").agg(F.max(F.struct("kind", "floor")).alias("most"))
    used = found.join(largest, "query_id").where(
        (F.col("kind") == F.col("most.kind")) & (F.col("most.floor").isNull() | (F.col("top") >= F.col("most.floor"))))
    return used.select("query_id", *_TERMS).join(lines, _TERMS).groupBy("query_id", "line").agg(F.max("best").alias("best"))


def required_bits(hits: DataFrame) -> DataFrame:
    """``query_id, required``: the bits a kept hit must carry.

    Derived from the query's (at most 7) distinct masks: diagnosis first,
    then name, then hospital, each bit added only if some hit still carries
    all bits required so far plus that bit.
    """
    def covers(want):
        return lambda m: m.bitwiseAND(want) == want

    per_query = hits.groupBy("query_id").agg(F.collect_set("mask").alias("_ms"))
    req = F.lit(0)
    for bit in (FLAG[DIAGNOSIS], FLAG[NAME], FLAG[HOSPITAL]):
        want = req.bitwiseOR(F.lit(bit))
        req = F.when(F.exists("_ms", covers(want)), want).otherwise(req)
    return per_query.select("query_id", req.alias("required"))


def soft_intersect(hits: DataFrame) -> DataFrame:
    """Keep hits whose mask covers the required bits of their query
    (intersect with each field's hits, in order diagnosis, name, hospital,
    only where that intersection is non-empty)."""
    required = required_bits(hits)
    return (hits.join(required, "query_id")
                .where(F.col("mask").bitwiseAND(F.col("required")) == F.col("required"))
                .drop("required"))


def resolve_label(matches: DataFrame) -> DataFrame:
    """``query_id, label`` = closest matched diagnosis, then alphabetical
    (an aggregate over the diagnosis matches alone)."""
    return (matches.where(F.col("field") == DIAGNOSIS).groupBy("query_id")
                   .agg(F.min_by("match", F.struct("distance", "match")).alias("label")))


def rank(kept: DataFrame, k: int = TOP_K, metric: str = "n_visits") -> DataFrame:
    """``query_id, ord, line`` (ord 0-based, <= k lines)
    from kept hits carrying their query's ``label``."""
    lines = (kept.where(F.col("label").isNull())
                 .select("query_id", F.col(metric).alias("n"),
                         text.line_without_count("full_name", "hospital", "email").alias("line"))
                 .groupBy("query_id", "line").agg(F.max("n").alias("best")))
    return _rank_hits(kept.where(F.col("label").isNotNull()), k, metric).unionByName(_rank_lines(lines, k))


def _rank_hits(kept: DataFrame, k: int, metric: str) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc(metric), "full_name", "hospital", "email")
    return (kept.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
                .select("query_id", (F.col("_rn") - 1).cast("bigint").alias("ord"),
                        text.line_with_count("full_name", metric, "hospital", "email").alias("line")))


def _rank_lines(lines: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("best"), "line")
    return (lines.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
                 .select("query_id", (F.col("_rn") - 1).cast("bigint").alias("ord"), "line"))


def titles(queries: DataFrame, labels: DataFrame) -> DataFrame:
    """``query_id, ord, line`` title lines of each response."""
    q = queries.select("query_id", F.col(DIAGNOSIS).alias("_typed")).join(labels, "query_id", "left")
    lines = F.when(F.col("label").isNotNull(), F.array(
        F.concat(F.lit(text.DISEASE_QUERY_PREFIX), F.coalesce("_typed", F.lit(""))),
        F.concat(F.lit(text.SEARCHING_DISEASE_PREFIX), F.col("label")),
        F.lit(text.RESULTS_TITLE))).otherwise(F.array(F.lit(text.RESULTS_TITLE)))
    return q.select("query_id", F.posexplode(lines)).select(
        "query_id", F.col("pos").cast("bigint").alias("ord"), F.col("col").alias("line"))


def search(results: DataFrame, queries: DataFrame, k: int = TOP_K,
           max_expansions: int | None = None, transpositions: bool = True,
           identity: str = "tuple", index: DataFrame | None = None) -> DataFrame:
    """Full search: ``query_id, kind, ord, line`` with ``kind`` 'title' or
    'result' (``NONE`` as the only result line when a query keeps no hit).

    ``index`` is ``best_lines`` of the results with the same ``k``; without it
    the lines of the terms that the queries matched are worked out here.  With
    it, names that cannot reach the lines shown are not matched."""
    if index is None or max_expansions is not None:
        matches = query_matches(queries, results, None, max_expansions, transpositions)
    else:
        matches = reaching_matches(queries, results, index, k, transpositions)
    labels = resolve_label(matches)
    hit, metric = hit_columns(results, identity), metric_of(results)
    hits = _narrowed(matches, results, hit).groupBy("query_id", *hit).agg(F.bit_or("bit").alias("mask"))
    keys = term_keys(matches)
    lines = best_lines(results, k, keys) if index is None else index
    ranked = _rank_hits(soft_intersect(hits), k, metric).unionByName(_rank_lines(merged_lines(keys, lines, k), k))
    res = (queries.select("query_id").join(ranked, "query_id", "left")
                  .select("query_id", F.lit("result").alias("kind"),
                          F.coalesce("ord", F.lit(0).cast("bigint")).alias("ord"),
                          F.coalesce("line", F.lit(text.NONE_LINE)).alias("line")))
    return titles(queries, labels).select("query_id", F.lit("title").alias("kind"), "ord", "line").unionByName(res)
