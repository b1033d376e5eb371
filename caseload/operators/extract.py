"""Record extraction (P1-P5, S7): JSON text -> typed rows, malformed routing.

``from_json`` with a pruned schema (only the paths used) runs JVM-side inside
whole-stage code generation; numbers, booleans and nested objects found where
a string is declared come back as their JSON text (string coercion, P5).

A record is *malformed* when the text does not parse as an object, or a
required path is missing / null, or the diagnosis is blank (a blank value
would become the null default partition of the result table).  Only element
0 of ``participant``, ``diagnosis`` and ``qualification`` counts; ``get`` (not
``[0]``) keeps an empty array from raising under ANSI mode.

``on_malformed``:
  ``"quarantine"`` (default) drop malformed rows here; ``rejects`` returns them
  ``"sentinel"``   replace every extracted field of a malformed row with "0"
                   (the reference behaviour: such rows count for id "0")
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caseload.schemas import CORRUPT, ENCOUNTER_READ, PATIENT_READ, PRACTITIONER_READ

SENTINEL = "0"
_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parse_json(value: Column, schema) -> Column:
    """JSON text -> struct with the declared (pruned) schema."""
    return F.from_json(value, schema, _JSON_OPTS)


def _parsed(lines: DataFrame, schema, also: tuple[str, ...] = ()) -> DataFrame:
    """``lines`` (with the columns ``also``) plus the parsed struct ``_j``, parsed exactly once per line.

    The parse sits in a one-element generator: predicates on the extracted
    fields stay above it instead of being pushed below with the parse
    expression inlined once per reference (which re-parses every line
    several times when the filter lands in a scan or join condition).
    """
    names = [c for c in dict.fromkeys(("value", "file_path", *also)) if c in lines.columns]
    return lines.select(*names, F.explode(F.array(parse_json(F.col("value"), schema))).alias("_j"))


def _encounter_fields(lines: DataFrame, require_patient: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    parsed = _parsed(lines, ENCOUNTER_READ, keep)
    j = F.col("_j")
    practitioner = F.get(j.getField("participant"), 0).getField("individual")
    diagnosis = F.get(j.getField("diagnosis"), 0).getField("condition")
    patient = j.getField("subject")
    bad = (j.isNull() | j.getField(CORRUPT).isNotNull() | practitioner.isNull()
           | diagnosis.isNull() | (F.trim(diagnosis) == ""))
    if require_patient:
        bad = bad | patient.isNull()
    cols = [c for c in dict.fromkeys(("file_path", *keep)) if c in lines.columns]
    return parsed.select(
        "value", *cols,
        practitioner.alias("practitioner"), diagnosis.alias("diagnosis"),
        patient.alias("patient"), F.coalesce(bad, F.lit(True)).alias("_malformed"))


def _route(df: DataFrame, fields: list[str], on_malformed: str, keep: tuple[str, ...] = ()) -> DataFrame:
    if on_malformed == "quarantine":
        return df.where(~F.col("_malformed")).select(*fields, *keep)
    if on_malformed == "sentinel":
        return df.select(*[
            F.when(F.col("_malformed"), F.lit(SENTINEL)).otherwise(F.col(c)).alias(c) for c in fields], *keep)
    raise ValueError(f"on_malformed must be 'quarantine' or 'sentinel', not {on_malformed!r}")


def encounters(lines: DataFrame, on_malformed: str = "quarantine",
               require_patient: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``practitioner, diagnosis, patient`` per encounter line, and the
    columns ``keep`` of the lines.

    ``require_patient=True`` gives the patient-aware reading, under which a
    line without ``subject`` is malformed as well.
    """
    return _route(_encounter_fields(lines, require_patient, keep),
                  ["practitioner", "diagnosis", "patient"], on_malformed, keep)


def patients(lines: DataFrame) -> DataFrame:
    """``identifier, name`` per patient line; malformed lines are set aside."""
    parsed = _parsed(lines, PATIENT_READ)
    j = F.col("_j")
    return parsed.select(j.getField("identifier").alias("identifier"), j.getField("name").alias("name"),
                         j.getField(CORRUPT).alias("bad")).where(
        "bad is null and identifier is not null and name is not null").drop("bad")


def latest_per_id(practitioners: DataFrame, order_col: str = "file_path") -> DataFrame:
    """Q9 option: one record per practitioner id, taken from the greatest
    ``order_col`` (the last file); ties broken by the record itself."""
    fields = ["full_name", "email", "hospital"]
    best = F.max_by(F.struct(*fields), F.struct(order_col, *fields))
    return (practitioners.groupBy("practitioner").agg(best.alias("_r"))
                         .select("practitioner", *[F.col(f"_r.{f}").alias(f) for f in fields]))


def _practitioner_fields(lines: DataFrame) -> DataFrame:
    parsed = _parsed(lines, PRACTITIONER_READ)
    j = F.col("_j")
    pid = j.getField("identifier")
    name = j.getField("name")
    email = j.getField("telecom")
    hospital = F.get(j.getField("qualification"), 0).getField("identifier")
    bad = (j.isNull() | j.getField(CORRUPT).isNotNull() | pid.isNull() | name.isNull()
           | email.isNull() | hospital.isNull())
    cols = [c for c in ("file_path",) if c in lines.columns]
    return parsed.select(
        "value", *cols,
        pid.alias("practitioner"), name.alias("full_name"), email.alias("email"),
        hospital.alias("hospital"), F.coalesce(bad, F.lit(True)).alias("_malformed"))


def practitioners(lines: DataFrame, on_malformed: str = "quarantine", duplicates: str = "keep") -> DataFrame:
    """``practitioner, full_name, email, hospital`` per practitioner line.

    ``duplicates="keep"`` keeps every record (an id in two files then joins
    twice); ``"latest"`` keeps the record of the last file per id.
    """
    fields = ["practitioner", "full_name", "email", "hospital"]
    if duplicates not in ("keep", "latest"):
        raise ValueError(f"duplicates must be 'keep' or 'latest', not {duplicates!r}")
    keep = fields + (["file_path"] if duplicates == "latest" and "file_path" in lines.columns else [])
    return one_record(_route(_practitioner_fields(lines), keep, on_malformed), duplicates)


def one_record(practitioners: DataFrame, duplicates: str) -> DataFrame:
    """All records, or with ``"latest"`` that of the last file per id."""
    if duplicates == "keep":
        return practitioners.select("practitioner", "full_name", "email", "hospital")
    if "file_path" not in practitioners.columns:
        practitioners = practitioners.withColumn("file_path", F.lit(""))
    return latest_per_id(practitioners)


def rejects(lines: DataFrame, module: str = "encounter", require_patient: bool = False) -> DataFrame:
    """The malformed lines themselves: ``value, file_path, module``."""
    if module == "encounter":
        df = _encounter_fields(lines, require_patient)
    elif module == "practitioner":
        df = _practitioner_fields(lines)
    else:
        raise ValueError(f"unknown module {module!r}")
    fp = F.col("file_path") if "file_path" in lines.columns else F.lit(None).cast("string")
    return df.where(F.col("_malformed")).select("value", fp.alias("file_path"), F.lit(module).alias("module"))


# ---------------------------------------------------------------- one scan, two outcomes

ACCEPTED, REJECTED = "accepted", "rejected"


def outcomes(lines: DataFrame, module: str = "encounter", on_malformed: str = "quarantine",
             require_patient: bool = False, observation: Observation | None = None) -> DataFrame:
    """What becomes of each line, parsed once: ``outcome``, the module's
    fields where it is accepted, ``value`` where it is rejected, ``file_path``.

    With the sentinel a malformed line has both outcomes.  ``observation``
    counts the lines accepted and rejected as they go by.
    """
    if on_malformed not in ("quarantine", "sentinel"):
        raise ValueError(f"on_malformed must be 'quarantine' or 'sentinel', not {on_malformed!r}")
    if module == "encounter":
        df, fields = _encounter_fields(lines, require_patient), ["practitioner", "diagnosis", "patient"]
    elif module == "practitioner":
        df, fields = _practitioner_fields(lines), ["practitioner", "full_name", "email", "hospital"]
    else:
        raise ValueError(f"unknown module {module!r}")
    bad = F.col("_malformed")
    if observation is not None:
        df = df.observe(observation, F.count_if(~bad).alias(ACCEPTED), F.count_if(bad).alias(REJECTED))
    kept = [F.lit(REJECTED)] + [F.lit(ACCEPTED)] * (on_malformed == "sentinel")
    path = F.col("file_path") if "file_path" in df.columns else F.lit(None).cast("string")
    df = df.withColumn("outcome", F.explode(F.when(bad, F.array(*kept)).otherwise(F.array(F.lit(ACCEPTED)))))
    accepted = F.col("outcome") == ACCEPTED
    return df.select("outcome", *[F.when(accepted & bad, F.lit(SENTINEL)).when(accepted, F.col(f)).alias(f) for f in fields],
                     F.when(~accepted, F.col("value")).alias("value"), path.alias("file_path"))


def tallied(lines: DataFrame, keys: list[str], metric: str, on_malformed: str = "quarantine",
            require_patient: bool = False, observation: Observation | None = None) -> DataFrame:
    """``outcome, *keys, value, file_path, <metric>``: the totals of accepted
    lines per key, and the rejected lines with how often each occurs in its
    file, by one scan and one aggregation (partial sums before the shuffle)."""
    found = outcomes(lines, "encounter", on_malformed, require_patient, observation)
    rejected = F.when(F.col("outcome") == REJECTED, F.col("file_path")).alias("file_path")
    return (found.select("outcome", *keys, "value", rejected)
            .groupBy("outcome", *keys, "value", "file_path").agg(F.count(F.lit(1)).alias(metric)))


def rejected_lines(stored: DataFrame, module: str, count: str | None = None) -> DataFrame:
    """``value, file_path, module`` of the rejected rows of a stored outcome table."""
    rows = stored.where(F.col("outcome") == REJECTED)
    if count is not None:
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count))))
    return rows.select("value", "file_path", F.lit(module).alias("module"))
