"""Practitioner enrichment.

An inner equi-join on the practitioner id: totals without a practitioner
record and practitioners without totals drop out; duplicated ids multiply
(reference semantics).  No broadcast hint: the practitioner dimension is
broadcast by the planner when its size estimate is under the threshold
(a few MB at the reference's 5 000 practitioners) and sort-merge joined
beyond it, and AQE re-plans at run time from the real shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DETAIL_COLS = ["full_name", "email", "hospital"]


def enrich(totals: DataFrame, practitioners: DataFrame) -> DataFrame:
    """Attach ``full_name, email, hospital`` to per-practitioner totals."""
    metrics = [c for c in totals.columns if c not in ("practitioner", "diagnosis")]
    return (totals.join(practitioners.select("practitioner", *DETAIL_COLS), "practitioner", "inner")
                  .select("practitioner", *metrics, *DETAIL_COLS, "diagnosis"))


def duplicate_ids(practitioners: DataFrame) -> DataFrame:
    """Practitioner ids that occur more than once (reported, not dropped)."""
    return (practitioners.groupBy("practitioner").agg(F.count(F.lit(1)).alias("n_records"))
                         .where(F.col("n_records") > 1))
