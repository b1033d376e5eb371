"""Reference SQL for every registered query (ANSI SQL as run by DuckDB over
the same tables), written independently of the Spark plans: the star
mapping, aggregation, fuzzy matching, soft intersection and ranking are
restated in plain SQL, constants included.  Only the typed queries of the
registered searches are taken from the catalog."""

from __future__ import annotations

from caseload.plans import catalog as C

# runs of letters and digits, inner apostrophes kept; runs of letters / of others
TOK = r"[\p{L}\p{N}]+(?:''[\p{L}\p{N}]+)*"
CHUNK = r"(\p{L}+|[^\p{L}]+)"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{TOK}')"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '{CHUNK}'), "
            f"lambda c: upper(c[1]) || lower(c[2:])), '')")


ENC = """enc AS (
  SELECT CAST(l.l_suppkey AS VARCHAR) AS practitioner, p.p_name AS diagnosis,
         CAST(o.o_custkey AS VARCHAR) AS patient, l.l_orderkey, l.l_linenumber,
         CAST(l.l_orderkey % 3 AS INTEGER) AS slice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey)"""

PRAC = """prac AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS practitioner,
         lower(replace(s.s_name, '#', ' ')) AS full_name,
         substr(lower(replace(s.s_name, '#', ' ')), 1, 1)
           || split_part(lower(replace(s.s_name, '#', ' ')), ' ', 2)
           || '@' || lower(replace(r.r_name, ' ', '')) || '.org' AS email,
         lower(r.r_name) || '-' || lower(n.n_name) AS hospital
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

VC = "vc AS (SELECT practitioner, diagnosis, count(*) AS n_visits FROM enc GROUP BY practitioner, diagnosis)"

RES = """res AS (
  SELECT vc.practitioner, vc.n_visits, prac.full_name, prac.email, prac.hospital, vc.diagnosis
  FROM vc JOIN prac ON vc.practitioner = prac.practitioner)"""

CASES = """cases AS (SELECT practitioner, diagnosis, patient, count(*) AS n_cases
  FROM enc GROUP BY practitioner, diagnosis, patient)"""

VP = """vp AS (SELECT practitioner, diagnosis, count(*) AS n_patients,
  CAST(sum(n_cases) AS BIGINT) AS n_visits FROM cases GROUP BY practitioner, diagnosis)"""

# the encounter JSON text as the adapter emits it
ENC_JSON = ("'{\"resourceType\":\"Encounter\",\"identifier\":\"' || l_orderkey || '-' || l_linenumber"
            " || '\",\"subject\":\"' || patient || '\",\"participant\":[{\"individual\":\"' || practitioner"
            " || '\"}],\"diagnosis\":[{\"condition\":\"' || diagnosis || '\"}]}'")
ENC_JSON_NO_PARTICIPANT = ("'{\"resourceType\":\"Encounter\",\"identifier\":\"' || l_orderkey || '-'"
                           " || l_linenumber || '\",\"subject\":\"' || patient || '\",\"participant\":[]"
                           ",\"diagnosis\":[{\"condition\":\"' || diagnosis || '\"}]}'")

Q_DIAG = """qd AS (SELECT DISTINCT 'd:' || p_name AS query_id,
  upper(substr(p_name, 1, 2) || substr(p_name, 4)) AS diagnosis, '' AS full_name, '' AS hospital FROM part)"""
Q_NAME = """qn AS (SELECT 's:' || CAST(s_suppkey AS VARCHAR) AS query_id, '' AS diagnosis,
  replace(lower(replace(s_name, '#', ' ')), 'pp', 'p') AS full_name, '' AS hospital FROM supplier)"""
Q_HOSP = """qh AS (SELECT 'n:' || CAST(n.n_nationkey AS VARCHAR) AS query_id, '' AS diagnosis, '' AS full_name,
  substr(lower(r.r_name) || '-' || lower(n.n_name), 1, 1) || substr(lower(r.r_name) || '-' || lower(n.n_name), 3)
    AS hospital
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def values_queries(rows) -> str:
    def lit(s):
        return "'" + s.replace("'", "''") + "'"
    vals = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"q AS (SELECT * FROM (VALUES {vals}) t(query_id, diagnosis, full_name, hospital))"


def _k(field: str) -> int:
    return {"diagnosis": 2, "full_name": 2, "hospital": 1}[field]


def _qterms_sql(fields) -> str:
    parts = []
    for f in fields:
        if f == "diagnosis":
            parts.append("SELECT query_id, 'diagnosis' AS field, lower(trim(diagnosis)) AS term FROM q")
        else:
            parts.append(f"SELECT query_id, '{f}' AS field, unnest(list_distinct({tokens(f)})) AS term FROM q")
    return ("qterms AS (SELECT * FROM (" + " UNION ALL ".join(parts)
            + ") WHERE term IS NOT NULL AND term <> '')")


def _vocab_sql(fields) -> str:
    parts = []
    for f in fields:
        if f == "diagnosis":
            parts.append("SELECT 'diagnosis' AS field, diagnosis AS term FROM res")
        else:
            parts.append(f"SELECT '{f}' AS field, unnest({tokens(f)}) AS term FROM res")
    return ("vocab AS (SELECT DISTINCT field, term FROM (" + " UNION ALL ".join(parts)
            + ") WHERE term IS NOT NULL AND term <> '')")


def _kcase(col: str = "t.field") -> str:
    return f"CASE {col} WHEN 'diagnosis' THEN 2 WHEN 'full_name' THEN 2 ELSE 1 END"


def _swap_sql(a: str, b: str, tail: str) -> str:
    """Least 1 + edits before + ``tail`` after over the neighbours of a that
    stand the other way round in b, at most one place away (99: none).  Splits
    at a transposition, so it is exact for distances of up to 2."""
    return f"""coalesce(list_min(list_transform(list_filter(
      flatten(list_transform(range(1, length({a})), lambda i: list_transform([i - 1, i, i + 1], lambda j: {{'i': i, 'j': j}}))),
      lambda p: p.j >= 1 AND p.j < length({b}) AND {a}[p.i] = {b}[p.j + 1] AND {a}[p.i + 1] = {b}[p.j]
                AND {a}[p.i] <> {a}[p.i + 1]),
      lambda p: levenshtein(substr({a}, 1, p.i - 1), substr({b}, 1, p.j - 1)) + 1 + {tail})), 99)"""


def _osa_sql(a: str, b: str) -> str:
    """Optimal-string-alignment distance, exact up to 2."""
    ra, rb = f"substr({a}, p.i + 2)", f"substr({b}, p.j + 2)"
    second = f"""CASE WHEN length({ra}) = length({rb}) AND list_contains(list_transform(range(1, length({ra})), lambda t:
        substr({ra}, 1, t - 1) || substr({ra}, t + 1, 1) || substr({ra}, t, 1) || substr({ra}, t + 2)), {rb})
      THEN 1 ELSE 99 END"""
    return f"least(levenshtein({a}, {b}), {_swap_sql(a, b, f'least(levenshtein({ra}, {rb}), {second})')})"


def _expand_sql(cap, transposed: bool = False) -> str:
    distance = _osa_sql("term", "match") if transposed else "levenshtein(term, match)"
    exp = f"""pairs AS (
  SELECT t.field, t.term, v.term AS match
  FROM (SELECT DISTINCT field, term FROM qterms) t JOIN vocab v ON t.field = v.field
  WHERE levenshtein(t.term, v.term) <= 4),
scored AS (
  SELECT * FROM (SELECT field, term, match, CAST({distance} AS BIGINT) AS distance FROM pairs)
  WHERE distance <= {_kcase('field')} AND distance < least(length(term), length(match)))"""
    if cap is None:
        return exp + ",\nexpanded AS (SELECT field, term, match, distance FROM scored)"
    return exp + f""",
expanded AS (SELECT field, term, match, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY field, term
     ORDER BY 1 - distance / least(length(term), length(match)) DESC, match) AS rn FROM scored)
  WHERE rn <= {cap})"""


def matches_sql(queries_cte: str, fields=("diagnosis", "full_name", "hospital"), cap=None,
                transposed: bool = False) -> list[str]:
    return [queries_cte, _qterms_sql(fields), _vocab_sql(fields), _expand_sql(cap, transposed),
            """matches AS (SELECT qt.query_id, qt.field, e.match, min(e.distance) AS distance
  FROM qterms qt JOIN expanded e ON qt.field = e.field AND qt.term = e.term
  GROUP BY qt.query_id, qt.field, e.match)"""]


def hits_sql() -> list[str]:
    rk = f"""rkeys AS (
  SELECT full_name, n_visits, hospital, email, 'diagnosis' AS field, diagnosis AS term FROM res
  UNION ALL SELECT full_name, n_visits, hospital, email, 'full_name', unnest(list_distinct({tokens('full_name')})) FROM res
  UNION ALL SELECT full_name, n_visits, hospital, email, 'hospital', unnest(list_distinct({tokens('hospital')})) FROM res)"""
    hits = """hits AS (
  SELECT m.query_id, r.full_name, r.n_visits, r.hospital, r.email,
         bit_or(CASE m.field WHEN 'diagnosis' THEN 4 WHEN 'full_name' THEN 2 ELSE 1 END) AS mask
  FROM matches m JOIN rkeys r ON m.field = r.field AND m.match = r.term
  GROUP BY m.query_id, r.full_name, r.n_visits, r.hospital, r.email)"""
    r1 = """r1 AS (SELECT query_id, CASE WHEN bool_or((mask & 4) = 4) THEN 4 ELSE 0 END AS req
  FROM hits GROUP BY query_id)"""
    r2 = """r2 AS (SELECT h.query_id, CASE WHEN bool_or((h.mask & (r1.req | 2)) = (r1.req | 2))
  THEN r1.req | 2 ELSE r1.req END AS req FROM hits h JOIN r1 ON h.query_id = r1.query_id
  GROUP BY h.query_id, r1.req)"""
    r3 = """r3 AS (SELECT h.query_id, CASE WHEN bool_or((h.mask & (r2.req | 1)) = (r2.req | 1))
  THEN r2.req | 1 ELSE r2.req END AS req FROM hits h JOIN r2 ON h.query_id = r2.query_id
  GROUP BY h.query_id, r2.req)"""
    kept = """kept AS (SELECT h.* FROM hits h JOIN r3 ON h.query_id = r3.query_id
  WHERE (h.mask & r3.req) = r3.req)"""
    return [rk, hits, r1, r2, r3, kept]


def search_sql(queries_cte: str, k: int = 10, transposed: bool = False, results=None) -> str:
    labels = """labels AS (SELECT query_id, first(match ORDER BY distance, match) AS label
  FROM matches WHERE field = 'diagnosis' GROUP BY query_id)"""
    ranked = f"""lab AS (SELECT kept.*, labels.label FROM kept LEFT JOIN labels ON kept.query_id = labels.query_id),
ra AS (SELECT query_id, ord, line FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id
           ORDER BY n_visits DESC, full_name, hospital, email) - 1 AS BIGINT) AS ord,
         'Dr. ' || full_name || ', ' || CAST(n_visits AS VARCHAR) || ' patients, ' || {title('hospital')}
           || ', ' || email AS line
  FROM lab WHERE label IS NOT NULL) WHERE ord < {k}),
lines AS (SELECT query_id, 'Dr. ' || full_name || ', ' || {title('hospital')} || ', ' || email AS line,
  max(n_visits) AS best FROM lab WHERE label IS NULL GROUP BY 1, 2),
rb AS (SELECT query_id, ord, line FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY best DESC, line) - 1 AS BIGINT) AS ord,
         line FROM lines) WHERE ord < {k}),
ranked AS (SELECT * FROM ra UNION ALL SELECT * FROM rb)"""
    body = with_(ENC, PRAC, *(results or [VC, RES]), *matches_sql(queries_cte, transposed=transposed), *hits_sql(),
                 labels, ranked)
    return body + """SELECT q.query_id, 'title' AS kind, CAST(0 AS BIGINT) AS ord,
       'Disease Query: ' || coalesce(q.diagnosis, '') AS line
FROM q JOIN labels l ON q.query_id = l.query_id
UNION ALL
SELECT q.query_id, 'title', CAST(1 AS BIGINT), 'Searching Disease: ' || l.label
FROM q JOIN labels l ON q.query_id = l.query_id
UNION ALL
SELECT q.query_id, 'title', CAST(CASE WHEN l.label IS NULL THEN 0 ELSE 2 END AS BIGINT),
       chr(10) || 'Results:' || chr(10)
FROM q LEFT JOIN labels l ON q.query_id = l.query_id
UNION ALL
SELECT q.query_id, 'result', coalesce(r.ord, CAST(0 AS BIGINT)), coalesce(r.line, 'NONE')
FROM q LEFT JOIN ranked r ON q.query_id = r.query_id"""


def _turned(x: str) -> str:
    return f"substr({x}, 1, 1) || substr({x}, 3, 1) || substr({x}, 2, 1) || substr({x}, 4)"


Q_TURNED = f"""q AS (SELECT DISTINCT 'd:' || p_name AS query_id, {_turned('p_name')} AS diagnosis, '' AS full_name,
    '' AS hospital FROM part
  UNION ALL SELECT 's:' || CAST(s_suppkey AS VARCHAR), '', {_turned("lower(replace(s_name, '#', ' '))")}, '' FROM supplier
  UNION ALL SELECT 'n:' || CAST(n.n_nationkey AS VARCHAR), '', '', {_turned("(lower(r.r_name) || '-' || lower(n.n_name))")}
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""
#: the patient-aware results under the count's name that the hit CTEs use
RES_PATIENTS = """res AS (
  SELECT vp.practitioner, vp.n_patients AS n_visits, prac.full_name, prac.email, prac.hospital, vp.diagnosis
  FROM vp JOIN prac ON vp.practitioner = prac.practitioner)"""
# the practitioner JSON text as the adapter emits it
PRAC_JSON = ("'{\"resourceType\":\"Practitioner\",\"identifier\":\"' || practitioner || '\",\"name\":\"' || full_name"
             " || '\",\"telecom\":\"' || email || '\",\"qualification\":[{\"identifier\":\"' || hospital || '\"}]}'")
PRAC_JSON_BARE = PRAC_JSON.replace("[{\"identifier\":\"' || hospital || '\"}]", "[]")


def oracle_sql() -> dict[str, str]:
    routed = (with_(ENC, PRAC) + "SELECT 'encounter' AS role, count(*) AS n_lines FROM enc "
              "UNION ALL SELECT 'practitioner', count(*) FROM prac")
    docs_state = (with_(ENC, VC) + """SELECT diagnosis,
  CAST(row_number() OVER (ORDER BY diagnosis, practitioner) - 1 AS BIGINT) AS _id,
  '{"Practitioner":"' || practitioner || '","Number of patients":' || CAST(n_visits AS VARCHAR) || '}' AS doc
FROM vc""")
    docs_res = (with_(ENC, PRAC, VC, RES) + """SELECT diagnosis,
  CAST(row_number() OVER (PARTITION BY diagnosis ORDER BY practitioner, n_visits, full_name, email, hospital) - 1
       AS BIGINT) AS _id,
  '{"Practitioner":"' || practitioner || '","Number of patients":' || CAST(n_visits AS VARCHAR)
    || ',"Full name":"' || full_name || '","E-mail":"' || email || '","Hospital":"' || hospital || '"}' AS doc
FROM res""")
    sentinel = (with_(ENC) + """SELECT CASE WHEN l_linenumber IN (1, 2) THEN '0' ELSE practitioner END AS practitioner,
       CASE WHEN l_linenumber IN (1, 2) THEN '0' ELSE diagnosis END AS diagnosis,
       count(*) AS n_visits
FROM enc GROUP BY 1, 2""")
    quarantine = (with_(ENC) + f"""SELECT CASE WHEN l_linenumber = 1 THEN substr({ENC_JSON}, 1, 40)
            ELSE {ENC_JSON_NO_PARTICIPANT} END AS value, 'encounter' AS module
FROM enc WHERE l_linenumber IN (1, 2)""")
    soft = (with_(ENC, PRAC, VC, RES, *matches_sql(values_queries(C.SOFT_QUERIES)), *hits_sql())
            + "SELECT query_id, full_name, n_visits, hospital, email, mask FROM kept")
    return {
        "parse_encounters": with_(ENC) + "SELECT practitioner, diagnosis, patient FROM enc",
        "parse_practitioners": with_(PRAC) + "SELECT practitioner, full_name, email, hospital FROM prac",
        "malformed_sentinel": sentinel,
        "malformed_quarantine": quarantine,
        "visit_counts": with_(ENC, VC) + "SELECT practitioner, diagnosis, n_visits FROM vc",
        "merge_visit_counts": with_(ENC, VC) + "SELECT practitioner, diagnosis, n_visits FROM vc",
        "patient_cases": with_(ENC, CASES) + "SELECT practitioner, diagnosis, patient, n_cases FROM cases",
        "merge_patient_cases": with_(ENC, CASES) + "SELECT practitioner, diagnosis, patient, n_cases FROM cases",
        "visits_and_patients": with_(ENC, CASES, VP) + "SELECT practitioner, diagnosis, n_patients, n_visits FROM vp",
        "enriched_visits": with_(ENC, PRAC, VC, RES) + "SELECT * FROM res",
        "enriched_visits_and_patients": with_(ENC, PRAC, CASES, VP) + """SELECT vp.practitioner, vp.n_patients,
  vp.n_visits, prac.full_name, prac.email, prac.hospital, vp.diagnosis
FROM vp JOIN prac ON vp.practitioner = prac.practitioner""",
        "diagnosis_list": with_(ENC) + "SELECT DISTINCT diagnosis FROM enc",
        "diagnosis_slice": with_(ENC, PRAC, VC, RES) + f"SELECT * FROM res WHERE diagnosis = '{C.SLICE_DIAGNOSIS}'",
        "state_documents": docs_state,
        "result_documents": docs_res,
        "lasting_documents": with_(ENC, PRAC, VC, RES, """seen AS (
  SELECT practitioner, diagnosis, min(slice) AS first_slice FROM enc GROUP BY 1, 2)""") + """SELECT diagnosis,
  CAST(row_number() OVER (PARTITION BY diagnosis ORDER BY first_slice, practitioner) - 1 AS BIGINT) AS _id,
  '{"Practitioner":"' || practitioner || '","Number of patients":' || CAST(n_visits AS VARCHAR)
    || ',"Full name":"' || full_name || '","E-mail":"' || email || '","Hospital":"' || hospital || '"}' AS doc
FROM res JOIN seen USING (practitioner, diagnosis)""",
        "partitioned_roundtrip": with_(ENC, PRAC, VC, RES) + "SELECT * FROM res",
        "routed_scan": routed,
        "batch_build": with_(ENC, PRAC, VC, RES) + "SELECT * FROM res",
        "incremental_build": with_(ENC, PRAC, CASES, VP) + """SELECT vp.practitioner, vp.n_patients,
  vp.n_visits, prac.full_name, prac.email, prac.hospital, vp.diagnosis
FROM vp JOIN prac ON vp.practitioner = prac.practitioner""",
        "fuzzy_diagnosis": with_(ENC, PRAC, VC, RES, *matches_sql(Q_DIAG.replace("qd AS", "q AS", 1),
                                                                  ("diagnosis",), None)[:-1])
                            + "SELECT field, term, match, distance FROM expanded",
        "fuzzy_name": with_(ENC, PRAC, VC, RES, *matches_sql(Q_NAME.replace("qn AS", "q AS", 1),
                                                             ("full_name",), None)[:-1])
                       + "SELECT field, term, match, distance FROM expanded",
        "fuzzy_hospital": with_(ENC, PRAC, VC, RES, *matches_sql(Q_HOSP.replace("qh AS", "q AS", 1),
                                                                 ("hospital",), None)[:-1])
                           + "SELECT field, term, match, distance FROM expanded",
        "capped_expansion": with_(ENC, PRAC, VC, RES, *matches_sql(Q_NAME.replace("qn AS", "q AS", 1),
                                                                   ("full_name",), C.CAPPED_EXPANSIONS)[:-1])
                             + "SELECT field, term, match, distance FROM expanded",
        "soft_intersection": soft,
        "search_with_diagnosis": search_sql(values_queries([C.SEARCH_WITH_DIAGNOSIS])),
        "search_without_diagnosis": search_sql(values_queries([C.SEARCH_WITHOUT_DIAGNOSIS])),
        "batch_search": search_sql(Q_DIAG.replace("qd AS", "q0 AS", 1) + ",\n" + Q_HOSP
                                   + ",\nq AS (SELECT * FROM q0 UNION ALL SELECT * FROM qh)"),
        "indexed_search": search_sql(Q_TURNED, transposed=True),
        "turned_search": search_sql(Q_TURNED, transposed=True),
        "title_case": with_(PRAC) + f"SELECT DISTINCT hospital, {title('hospital')} AS title FROM prac",
        "stream_visit_counts": with_(ENC, VC) + "SELECT practitioner, diagnosis, n_visits FROM vc",
        "stream_patient_counts": with_(ENC, CASES, VP) + "SELECT practitioner, diagnosis, n_patients, n_visits FROM vp",
        "compacted_state": with_(ENC, VC) + "SELECT practitioner, diagnosis, n_visits FROM vc",
        "stream_served_table": with_(ENC, PRAC, CASES, VP) + """SELECT vp.practitioner, vp.n_patients,
  vp.n_visits, prac.full_name, prac.email, prac.hospital, vp.diagnosis
FROM vp JOIN prac ON vp.practitioner = prac.practitioner""",
        "stream_rejects": quarantine,
        "folder_build": with_(ENC, PRAC, VC, RES) + "SELECT * FROM res",
        "build_rejects": quarantine.replace("WITH ", f"WITH {PRAC}, ", 1) + f"""
UNION ALL SELECT CASE WHEN CAST(practitioner AS BIGINT) % 10 = 1 THEN substr({PRAC_JSON}, 1, 40) ELSE {PRAC_JSON_BARE} END,
  'practitioner' FROM prac WHERE CAST(practitioner AS BIGINT) % 10 IN (1, 2)""",
        "cleared_state": with_(ENC) + """SELECT practitioner, diagnosis, count(*) AS n_visits FROM enc WHERE slice > 0
GROUP BY 1, 2""",
        "synth_practitioners": with_(PRAC) + "SELECT practitioner, full_name, email, hospital FROM prac",
        "synth_patients": """SELECT CAST(c_custkey AS VARCHAR) AS identifier, lower(replace(c_name, '#', ' ')) AS name
FROM customer""",
        "synth_encounters": with_(ENC) + """SELECT slice AS file_no, patient AS subject, practitioner AS individual,
       diagnosis AS condition FROM enc""",
        "practitioner_sentinel": with_(PRAC) + """, bad AS (SELECT *, CAST(practitioner AS BIGINT) % 10 IN (1, 2) AS b FROM prac)
SELECT CASE WHEN b THEN '0' ELSE practitioner END AS practitioner, CASE WHEN b THEN '0' ELSE full_name END AS full_name,
       CASE WHEN b THEN '0' ELSE email END AS email, CASE WHEN b THEN '0' ELSE hospital END AS hospital FROM bad""",
        "practitioner_quarantine": with_(PRAC) + f"""SELECT practitioner AS value, 'kept' AS module FROM prac
WHERE CAST(practitioner AS BIGINT) % 10 NOT IN (1, 2)
UNION ALL SELECT CASE WHEN CAST(practitioner AS BIGINT) % 10 = 1 THEN substr({PRAC_JSON}, 1, 40) ELSE {PRAC_JSON_BARE} END,
  'practitioner' FROM prac WHERE CAST(practitioner AS BIGINT) % 10 IN (1, 2)""",
        "stored_slice": with_(ENC, VC) + f"SELECT practitioner, diagnosis, n_visits FROM vc WHERE diagnosis = '{C.SLICE_DIAGNOSIS}'",
        "stored_diagnoses": with_(ENC) + "SELECT DISTINCT diagnosis FROM enc",
        "two_metric_documents": with_(ENC, PRAC, CASES, VP) + """SELECT vp.diagnosis,
  CAST(row_number() OVER (PARTITION BY vp.diagnosis ORDER BY vp.practitioner) - 1 AS BIGINT) AS _id,
  '{"Practitioner":"' || vp.practitioner || '","Number of patients":' || vp.n_patients || ',"Number of cases":' || vp.n_visits
    || ',"Full name":"' || full_name || '","E-mail":"' || email || '","Hospital":"' || hospital || '"}' AS doc
FROM vp JOIN prac ON vp.practitioner = prac.practitioner""",
        "case_documents": with_(ENC, CASES) + """SELECT diagnosis,
  CAST(row_number() OVER (ORDER BY diagnosis, practitioner, patient) - 1 AS BIGINT) AS _id,
  '{"Practitioner":"' || practitioner || '","Patient":"' || patient || '","Number of cases":' || n_cases || '}' AS doc
FROM cases""",
        "chunked_documents": docs_res,
        "fuzzy_diagnosis_transposed": with_(ENC, PRAC, VC, RES, *matches_sql(Q_TURNED, ("diagnosis",), None, True)[:-1])
                                       + "SELECT field, term, match, distance FROM expanded",
        "fuzzy_name_transposed": with_(ENC, PRAC, VC, RES, *matches_sql(Q_TURNED, ("full_name",), None, True)[:-1])
                                  + "SELECT field, term, match, distance FROM expanded",
        "fuzzy_hospital_transposed": with_(ENC, PRAC, VC, RES, *matches_sql(Q_TURNED, ("hospital",), None, True)[:-1])
                                      + "SELECT field, term, match, distance FROM expanded",
        "search_transposed": search_sql(values_queries([C.SEARCH_WITH_DIAGNOSIS]), transposed=True),
        "search_patients": search_sql(values_queries([C.SEARCH_WITH_DIAGNOSIS]), results=[CASES, VP, RES_PATIENTS]),
    }
