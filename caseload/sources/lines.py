"""Line scans (S1, S2) and input discovery / role routing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.session import list_files

# The path markers that route input files to their role.
ENCOUNTER_MARKER = "mockdata2/"
PRACTITIONER_MARKER = "mockdoctor2/"


def read_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row per text line: ``value`` plus the ``file_path`` it came from.

    Plain ``read.text`` (files or folders, folders read recursively):
    splittable, one task per 128 MB split, the file path comes from the hidden
    ``_metadata`` column at no extra cost.
    """
    if isinstance(paths, str):
        paths = [paths]
    paths = list(paths)
    if not paths:
        raise ValueError("no input paths")
    return (spark.read.option("recursiveFileLookup", "true").text(paths)
            .select("value", F.col("_metadata.file_path").alias("file_path")))


def _walk(spark: SparkSession, root: str, markers: dict[str, str]) -> dict[str, list[str]]:
    """Folders below ``root`` whose path contains a marker (not descended
    further: every file below them matches), plus loose matching files."""
    from caseload.session import hadoop_path
    fs, p = hadoop_path(spark, root)
    out = {role: [] for role in markers}
    if not fs.exists(p):
        return out
    stack = [(p, frozenset())]           # folder, roles matched by an ancestor
    while stack:
        d, done = stack.pop()
        for st in fs.listStatus(d):
            path = st.getPath()
            if path.getName().startswith(("_", ".")):
                continue
            text = path.toString() + ("/" if st.isDirectory() else "")
            hit = {role for role, m in markers.items() if role not in done and m in text}
            for role in hit:
                out[role].append(path.toString())
            if st.isDirectory() and len(done | hit) < len(markers):
                stack.append((path, done | hit))
    return {role: sorted(v) for role, v in out.items()}


def route_paths(spark: SparkSession, root: str,
                encounter_marker: str = ENCOUNTER_MARKER,
                practitioner_marker: str = PRACTITIONER_MARKER,
                level: str = "dirs") -> dict[str, list[str]]:
    """Split the input below ``root`` into encounter and practitioner inputs.

    A file is an encounter file when its path *contains* ``encounter_marker``
    and a practitioner file when it contains ``practitioner_marker``.  With
    ``level="dirs"`` (default) the walk stops at the first folder whose path
    contains a marker and returns folders -- a marker ending in ``/`` can only
    match the folder part of a path, so every file below such a folder
    matches -- and the reader lists their files in parallel on the cluster;
    the driver never holds one path per file.  ``level="files"`` lists the
    individual files.  No practitioner input is an error.
    """
    markers = {"encounter": encounter_marker, "practitioner": practitioner_marker}
    if level == "dirs":
        routed = _walk(spark, root, markers)
    elif level == "files":
        files = list_files(spark, root)
        routed = {role: [f for f in files if m in f] for role, m in markers.items()}
    else:
        raise ValueError(f"level must be 'dirs' or 'files', not {level!r}")
    if not routed["practitioner"]:
        raise ValueError(f"no practitioner file below {root!r} (marker {practitioner_marker!r})")
    return routed


def read_routed(spark: SparkSession, root: str, **markers) -> DataFrame:
    """All routed lines: ``value, file_path, role``, scanned once.  A file whose
    path holds both markers has both roles, so its lines come twice."""
    routed = route_paths(spark, root, **markers)
    enc = set(routed["encounter"])
    prac = set(routed["practitioner"])
    lines = read_lines(spark, sorted(enc | prac))
    enc_m = markers.get("encounter_marker", ENCOUNTER_MARKER)
    prac_m = markers.get("practitioner_marker", PRACTITIONER_MARKER)
    roles = F.array_compact(F.array(
        F.when(F.col("file_path").contains(enc_m), F.lit("encounter")),
        F.when(F.col("file_path").contains(prac_m), F.lit("practitioner"))))
    return lines.withColumn("role", F.explode(roles))
