"""caseload: practitioner / diagnosis caseload analytics on Spark.

Reads encounter and practitioner records (newline-delimited JSON), counts
visits, cases and distinct patients per practitioner and diagnosis, folds new
files into running totals (batch or Structured Streaming), joins practitioner
details, writes results partitioned by diagnosis and answers typo-tolerant
searches over them -- all as DataFrame plans.
"""

from caseload.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
