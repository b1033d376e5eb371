"""Adapters: the driver's star tables standing in for the clinical modules.

encounter     one ``lineitem`` row joined to its ``orders`` and ``part`` rows
practitioner  ``l_suppkey`` / ``s_suppkey`` as text
diagnosis     ``p_name``
patient       ``o_custkey`` as text
full name     ``lower(replace(s_name, '#', ' '))``
hospital      ``lower(r_name) || '-' || lower(n_name)``
email         first letter of the name, its second word, ``@``, region, ``.org``
input file    ``pmod(l_orderkey, 3)``

The adapters emit the JSON *text* of each record so the engine's real parse
path (``from_json`` with a pruned schema) runs on every row, while the SQL
oracle reads the tables directly.  Joins are left to the planner: ``part``,
``supplier``, ``nation`` and ``region`` are dimension tables that Spark
broadcasts when their statistics are under the threshold and sort-merges
otherwise.  ``lineitem`` x ``orders`` is a sort-merge join on the order key at
scale; the lines are dealt out by that key first, which is the exchange the
join needs, and which also spreads an unsplittable file over the cores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.session import bytes_of

N_SLICES = 3
TABLES = ("lineitem", "orders", "part", "supplier", "nation", "region", "customer")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the tables that the adapters read."""
    return sum(bytes_of(spark, f"{sf_dir.rstrip('/')}/{name}.parquet") for name in TABLES)


def encounter_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat encounter columns (before JSON encoding)."""
    li = (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
          .repartition("l_orderkey"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(part, li.l_partkey == part.p_partkey)
              .select("l_orderkey", "l_linenumber", "l_suppkey", "o_custkey", "p_name"))


def _encounter_json() -> Column:
    fields = [
        F.lit("Encounter").alias("resourceType"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("identifier"),
        F.col("o_custkey").cast("string").alias("subject"),
        F.array(F.struct(F.col("l_suppkey").cast("string").alias("individual"))).alias("participant"),
        F.array(F.struct(F.col("p_name").alias("condition"))).alias("diagnosis"),
    ]
    return F.to_json(F.struct(*fields))


def damage(value: Column, line_number: Column) -> Column:
    """Deterministic damage for the malformed-record queries.

    line 1: text cut after 40 characters (unparseable)
    line 2: empty participant list (no practitioner)
    line 4: practitioner id written as a JSON number (still valid: coerced)
    other lines unchanged.
    """
    return (F.when(line_number == 1, F.substring(value, 1, 40))
             .when(line_number == 2, F.regexp_replace(value, r'\[\{"individual":"[^"]*"\}\]', "[]"))
             .when(line_number == 4, F.regexp_replace(value, r'"individual":"(\d+)"', '"individual":$1'))
             .otherwise(value))


def encounter_lines(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """``value`` (one JSON encounter per row), ``file_path`` and ``slice``."""
    rec = encounter_records(spark, sf_dir)
    value = _encounter_json()
    if damaged:
        value = damage(value, F.col("l_linenumber"))
    slice_no = F.pmod(F.col("l_orderkey"), F.lit(N_SLICES)).cast("int")
    return rec.select(
        value.alias("value"),
        F.concat(F.lit("encounters/slice="), slice_no.cast("string")).alias("file_path"),
        slice_no.alias("slice"))


def practitioner_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    full_name = F.lower(F.regexp_replace(F.col("s_name"), "#", " "))
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(
                 F.col("s_suppkey").cast("string").alias("practitioner"),
                 full_name.alias("full_name"),
                 F.concat(F.substring(full_name, 1, 1), F.get(F.split(full_name, " "), 1), F.lit("@"),
                          F.lower(F.regexp_replace(F.col("r_name"), " ", "")), F.lit(".org")).alias("email"),
                 F.concat(F.lower(F.col("r_name")), F.lit("-"), F.lower(F.col("n_name"))).alias("hospital")))


def damage_practitioner(value: Column, practitioner: Column) -> Column:
    """Deterministic damage by the id's remainder by 10: 1 text cut after 40
    characters, 2 no qualification, 4 id written as a JSON number."""
    rest = F.pmod(practitioner.cast("bigint"), F.lit(10))
    return (F.when(rest == 1, F.substring(value, 1, 40))
             .when(rest == 2, F.regexp_replace(value, r'"qualification":\[[^\]]*\]', '"qualification":[]'))
             .when(rest == 4, F.regexp_replace(value, r'"identifier":"(\d+)"', '"identifier":$1'))
             .otherwise(value))


def practitioner_lines(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    rec = practitioner_records(spark, sf_dir)
    value = F.to_json(F.struct(
        F.lit("Practitioner").alias("resourceType"),
        F.col("practitioner").alias("identifier"),
        F.col("full_name").alias("name"),
        F.col("email").alias("telecom"),
        F.array(F.struct(F.col("hospital").alias("identifier"))).alias("qualification"),
    ))
    if damaged:
        value = damage_practitioner(value, F.col("practitioner"))
    return rec.select(value.alias("value"), F.lit("practitioners/part-0").alias("file_path"))


def patient_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    value = F.to_json(F.struct(
        F.lit("Patient").alias("resourceType"),
        F.col("c_custkey").cast("string").alias("identifier"),
        F.lower(F.regexp_replace("c_name", "#", " ")).alias("name"),
    ))
    return c.select(value.alias("value"), F.lit("patients/part-0").alias("file_path"))


def write_ndjson(lines: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write ``value`` lines as text files (one JSON object per line)."""
    cols = ["value"] + ([partition_by] if partition_by else [])
    w = lines.select(*cols).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(path)
