"""Scalar text functions (C1-C5, C14) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern (letters/digits, inner apostrophes kept)
# and the title-case chunk pattern (runs of letters / runs of non-letters).
TOKEN_PATTERN = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*"
TITLE_CHUNK_PATTERN = r"(\p{L}+|[^\p{L}]+)"

# Fixed values of the response text.
RESULTS_TITLE = "\nResults:\n"
DISEASE_QUERY_PREFIX = "Disease Query: "
SEARCHING_DISEASE_PREFIX = "Searching Disease: "
NONE_LINE = "NONE"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Upper-case the first letter after *any* non-letter, lower the rest.

    ``initcap`` only restarts after blanks; here every letter run is
    capitalised on its own: ``st. luke's`` -> ``St. Luke'S``,
    ``north-east/lake`` -> ``North-East/Lake``, ``3rd`` -> ``3Rd``.
    """
    chunks = F.regexp_extract_all(_col(c), F.lit(TITLE_CHUNK_PATTERN), 1)
    return F.array_join(F.transform(chunks, lambda x: F.initcap(x)), "")


def tokens(c) -> Column:
    """C14: lower-cased word tokens of a text (array<string>)."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN_PATTERN), 0)


def line_with_count(name, n, hospital, email) -> Column:
    """``Dr. {name}, {n} patients, {Hospital}, {email}``."""
    return F.concat(F.lit("Dr. "), _col(name), F.lit(", "), _col(n).cast("string"),
                    F.lit(" patients, "), title_case(hospital), F.lit(", "), _col(email))


def line_without_count(name, hospital, email) -> Column:
    """C4: ``Dr. {name}, {Hospital}, {email}``."""
    return F.concat(F.lit("Dr. "), _col(name), F.lit(", "), title_case(hospital),
                    F.lit(", "), _col(email))
