"""Aggregations (A1, A3, A5, A6), diagnosis listing (S8) and slicing (F1).

All are hash aggregations with a partial (map-side) step, so a hot key --
one practitioner or diagnosis holding a third of all encounters -- is
collapsed before the shuffle and never lands in one task as raw rows.

Distinct patients are counted in two levels (cases per patient first, then
rows per practitioner/diagnosis) instead of ``count(distinct)`` over the
practitioner/diagnosis key: the first shuffle is spread over the
(practitioner, diagnosis, patient) key, the second carries only partial
counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR = ["practitioner", "diagnosis"]


def visit_counts(enc: DataFrame) -> DataFrame:
    """A1: encounters per (practitioner, diagnosis) -> ``n_visits``."""
    return enc.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_visits"))


def patient_cases(enc: DataFrame) -> DataFrame:
    """A3: encounters per (practitioner, diagnosis, patient) -> ``n_cases``."""
    return enc.groupBy(*PAIR, "patient").agg(F.count(F.lit(1)).alias("n_cases"))


def visits_and_patients(cases: DataFrame) -> DataFrame:
    """A5 + A6 (and J2 without a self-join): ``n_patients`` distinct patients
    and ``n_visits`` total cases per (practitioner, diagnosis)."""
    return cases.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n_patients"),
        F.sum("n_cases").cast("bigint").alias("n_visits"))


def list_diagnoses(df: DataFrame) -> DataFrame:
    """The distinct diagnoses present."""
    return df.select("diagnosis").distinct()


def for_diagnosis(df: DataFrame, diagnosis: str) -> DataFrame:
    """one diagnosis slice (partition pruning on a partitioned table)."""
    return df.where(F.col("diagnosis") == F.lit(diagnosis))
