"""Registered queries of this subpackage, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.llm import block_dedup, bwt_dedup, fingerprint, hilbert, html_text, importance, mixing, ngram_join
from caseload.llm import packing, rules, subword, token_files, warc
from caseload.llm.common import read_table, written
from caseload.session import work_dir


def tokenizer_paths() -> dict[str, str]:
    """The public tokenizer's files, from the installed package that ships them."""
    import public_tokenizers
    return {"vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
            "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken")}


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(read_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read_table(spark, sf_dir, "documents"), **tokenizer_paths())


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read_table(spark, sf_dir, "documents")).drop("copies")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(rules.statistics(read_table(spark, sf_dir, "documents")), "rules-statistics")
    return rules.judged(stats, read_table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.classified(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read_table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(read_table(spark, sf_dir, "pages"))


def op8_block_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_dedup.dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc.parsed(warc.read_archive(spark, path))


def op10_bwt_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hilbert_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.clustered(read_table(spark, sf_dir, "embeddings")).drop("n_candidates")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    token_files.write(read_table(spark, sf_dir, "documents"), path, **tokenizer_paths())
    return token_files.read(spark, path)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("n_words")


QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_best_fit_packing, op3_source_mixing, op4_quality_rules, op5_subword_quality,
    op6_ngram_jaccard_join, op7_html_text, op8_block_anchor_dedup, op9_content_addressed_warc, op10_bwt_merge_dedup,
    op11_hilbert_clusters, op12_token_files, op13_importance_resampling)}

_MIXING_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12))::BIGINT AS draw
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
         2 * source_size AS cap FROM per),
filled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM weighed
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, cap::DOUBLE / weight <= level AS is_full FROM filled),
goals AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap::DOUBLE
              ELSE (max(CASE WHEN NOT is_full THEN level END) OVER ()) * weight END AS target
  FROM marked),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM goals),
drawn AS (
  SELECT d.doc_id, d.size, g.source, g.source_size, g.target, r.j,
         CAST(floor(g.rate) AS BIGINT) + CASE WHEN (d.draw + r.j * 17592186044416) % 281474976710656
              < (g.rate - floor(g.rate)) * 281474976710656.0::DOUBLE THEN 1 ELSE 0 END AS copies
  FROM sized d JOIN rated g ON d.source IS NOT DISTINCT FROM g.source
  CROSS JOIN (SELECT unnest(range(16)) AS j) r),
best AS (
  SELECT source, arg_min(j, (miss, j)) AS j FROM (
    SELECT source, j, abs(sum(size * copies) - any_value(target)) AS miss FROM drawn GROUP BY source, j)
  GROUP BY source)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, d.source_size, d.target, CAST(d.size * d.copies AS BIGINT) AS taken
FROM drawn d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.j = b.j
"""

def _clusters_sql(rounds: int = 5) -> str:
    """k-means restated: every vector against every centroid, round after round."""
    steps = ["""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v AS m
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h, v FROM kept ORDER BY h, v LIMIT 40))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT i, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT i, c, CAST(list_sum(list_transform(range(1, 65), lambda k: (v[k] - m[k]) * (v[k] - m[k]))) AS BIGINT) AS d
    FROM kept, c{r}) GROUP BY i)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.m, o.m) AS m FROM c{r} o LEFT JOIN (
    SELECT c, list(x ORDER BY k) AS m FROM (
      SELECT a.best.c AS c, k, CAST((sum(v[k]) - ((sum(v[k]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
      FROM a{r} a JOIN kept USING (i) CROSS JOIN (SELECT unnest(range(1, 65)) AS k) GROUP BY a.best.c, k) GROUP BY c) n
  ON o.c = n.c)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, best.c AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (i) JOIN c{rounds} ON c = best.c"""


_RESAMPLING_SQL = """
WITH bytes AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, list_transform(range(8), lambda x: x::BIGINT)),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
lowered AS (
  SELECT row_number() OVER () AS i, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
  UNION ALL
  SELECT -row_number() OVER (), NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  FROM benchmark),
worded AS MATERIALIZED (
  SELECT i, doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
runs AS MATERIALIZED (
  SELECT i, f, count(*) AS n FROM (
    SELECT i, unnest(w) AS f FROM worded
    UNION ALL
    SELECT i, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) FROM worded
    UNION ALL
    SELECT i, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) FROM worded)
  GROUP BY i, f),
hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(0, strlen(f)), lambda k: ('0x' || substr(hex(encode(f)), 2 * k + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM runs), bytes),
per AS MATERIALIZED (SELECT i, bucket, sum(n)::BIGINT AS n FROM runs JOIN hashed USING (f) GROUP BY i, bucket),
counted AS (
  SELECT bucket, coalesce(sum(n) FILTER (i > 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (i < 0), 0)::DOUBLE AS t
  FROM per GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counted) + 10000)
                                 / ((s + 1) * ((SELECT sum(t) FROM counted) + 10000))))::BIGINT AS g FROM counted),
weighed AS (
  SELECT i, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM per JOIN gain USING (bucket) WHERE i > 0 GROUP BY i),
scored AS (
  SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')),
           1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM worded d LEFT JOIN weighed USING (i) WHERE d.i > 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS r,
         5 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS most FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= most THEN r END AS rank FROM ranked
"""

ORACLES = {"op3_source_mixing": _MIXING_SQL, "op11_hilbert_clusters": _clusters_sql(),
           "op13_importance_resampling": _RESAMPLING_SQL}
