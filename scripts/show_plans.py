"""Print the final (post-AQE) physical plans of the headline queries.

    python scripts/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caseload.plans import catalog  # noqa: E402
from caseload.session import get_session  # noqa: E402

DEFAULT = ["visit_counts", "visits_and_patients", "enriched_visits", "result_documents", "merge_visit_counts", "stored_slice",
           "fuzzy_name_transposed", "search_with_diagnosis"]


def final_plan(df) -> str:
    """Run ``df`` itself (a diagnostic: the outputs shown here are small) so
    its adaptive plan reaches its final form, then print it."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)                     # attribute ids
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    text = re.sub(r"Location: [^,]*, ", "", text)
    return "\n".join(line[:170] for line in text.splitlines())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = get_session("local[8]", 8)
    for name in names:
        df = catalog.QUERIES[name](spark, sf)
        print(f"### {name}\n\n```\n{final_plan(df)}\n```\n")


if __name__ == "__main__":
    main()
