"""Schemas, column names and display names.

Every id and attribute is a string (numeric-looking ids such as "7" included);
counts are bigint.  Read schemas are pruned to the JSON paths the engine uses
so ``from_json`` never materialises unused fields.
"""

from pyspark.sql.types import (ArrayType, LongType, StringType, StructField,
                               StructType)

CORRUPT = "_corrupt_record"

# encounter: $.participant[0].individual, $.diagnosis[0].condition, $.subject
ENCOUNTER_READ = StructType([
    StructField("subject", StringType()),
    StructField("participant", ArrayType(StructType([StructField("individual", StringType())]))),
    StructField("diagnosis", ArrayType(StructType([StructField("condition", StringType())]))),
    StructField(CORRUPT, StringType()),
])

# practitioner: $.identifier, $.name, $.telecom, $.qualification[0].identifier
PRACTITIONER_READ = StructType([
    StructField("identifier", StringType()),
    StructField("name", StringType()),
    StructField("telecom", StringType()),
    StructField("qualification", ArrayType(StructType([StructField("identifier", StringType())]))),
    StructField(CORRUPT, StringType()),
])

# patient: $.identifier, $.name
PATIENT_READ = StructType([
    StructField("identifier", StringType()),
    StructField("name", StringType()),
    StructField(CORRUPT, StringType()),
])

RESULTS = StructType([
    StructField("practitioner", StringType()),
    StructField("n_visits", LongType()),
    StructField("full_name", StringType()),
    StructField("email", StringType()),
    StructField("hospital", StringType()),
    StructField("diagnosis", StringType()),
])

RESULTS_TWO_METRICS = StructType([
    StructField("practitioner", StringType()),
    StructField("n_patients", LongType()),
    StructField("n_visits", LongType()),
    StructField("full_name", StringType()),
    StructField("email", StringType()),
    StructField("hospital", StringType()),
    StructField("diagnosis", StringType()),
])

QUERIES = StructType([
    StructField("query_id", StringType()),
    StructField("diagnosis", StringType()),
    StructField("full_name", StringType()),
    StructField("hospital", StringType()),
])

# display names of the served documents (fixed values, must match the
# served document format)
DISPLAY_NAMES = {
    "practitioner": "Practitioner",
    "diagnosis": "Diagnosis",
    "n_visits": "Number of patients",
    "full_name": "Full name",
    "email": "E-mail",
    "hospital": "Hospital",
}
# two-metric documents: distinct patients and visits (cases)
DISPLAY_NAMES_TWO_METRICS = {
    "practitioner": "Practitioner",
    "n_patients": "Number of patients",
    "n_visits": "Number of cases",
    "full_name": "Full name",
    "email": "E-mail",
    "hospital": "Hospital",
}
# documents of the cases per patient
DISPLAY_NAMES_CASES = {
    "practitioner": "Practitioner",
    "patient": "Patient",
    "n_cases": "Number of cases",
}


def display_names(columns) -> dict[str, str]:
    """The display names of a table with these columns."""
    if "n_cases" in columns:
        return DISPLAY_NAMES_CASES
    return DISPLAY_NAMES_TWO_METRICS if "n_patients" in columns else DISPLAY_NAMES
