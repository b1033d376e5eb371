"""Served results.

Results are a Parquet table partitioned by diagnosis (``plans.published``).  A
full build replaces the table, so a diagnosis that vanished is no longer
served.  An incremental build names the diagnoses it touched: each is replaced
whole, the touched ones without rows are removed, all others are left alone.
Readers see the table before a build or after it, never a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from caseload.operators.ordinal import with_ordinal
from caseload.plans import published
from caseload.schemas import RESULTS, display_names

#: Documents of one request to an external store, at most.
REQUEST = 1000


def write_results(results: DataFrame, path: str, touched: DataFrame | None = None,
                  max_records_per_file: int | None = None) -> None:
    """K2 + K3 + K7: replace the table, or with ``touched`` (a table with a
    column ``diagnosis``) only those diagnoses; readers see it switch at once."""
    published.publish(results, path, touched, max_records_per_file)


def read_results(spark: SparkSession, path: str, diagnosis: str | None = None,
                 schema=RESULTS) -> DataFrame:
    """The served table (diagnosis read back as text, never inferred)."""
    df = published.read(spark, path, schema)
    if diagnosis is not None:
        df = df.where(F.col("diagnosis") == F.lit(diagnosis))
    return df


def to_documents(df: DataFrame, display: dict | None = None, per_diagnosis: bool = True,
                 order_by=("practitioner",)) -> DataFrame:
    """K4 + P8: ``diagnosis, _id, doc`` -- one JSON document per row with the
    display field names, diagnosis moved out of the body into its own column
    (the document type), ``_id`` restarting per diagnosis or global.

    The display names follow from the columns unless given; a column without
    one is an error, never left out."""
    display, body = _display(df.columns, display)
    tie = [c for c in body if c not in order_by]
    ordered = with_ordinal(df, [*order_by, *tie], ["diagnosis"], name="_id") if per_diagnosis else \
        with_ordinal(df, ["diagnosis", *order_by, *tie], [], name="_id")
    return as_documents(ordered, display)


def _display(columns: list[str], display: dict | None) -> tuple[dict, list[str]]:
    """(display names, columns of a document's body)."""
    body = [c for c in columns if c not in ("diagnosis", "_id")]
    display = dict(display or display_names(columns))
    unnamed = [c for c in body if c not in display]
    if unnamed:
        raise ValueError(f"no display name for {', '.join(unnamed)}")
    return display, body


def as_documents(numbered: DataFrame, display: dict | None = None) -> DataFrame:
    """``diagnosis, _id, doc`` of rows that have an ``_id`` (e.g. a lasting one, ``plans.identity``)."""
    display, body = _display(numbered.columns, display)
    doc = F.to_json(F.struct(*[F.col(c).alias(display[c]) for c in body]))
    return numbered.select("diagnosis", "_id", doc.alias("doc"))


def requests(docs: DataFrame, size: int = REQUEST) -> DataFrame:
    """K3: the documents of each diagnosis in requests of at most ``size``, by
    their ordinals: ``diagnosis, request, n_docs, docs`` (array of
    struct<diagnosis, _id, doc>, in order).  Ordinals do not repeat, so a
    request is bounded however hot its diagnosis, and it is the same request
    whenever it is formed again."""
    grouped = docs.groupBy("diagnosis", F.floor(F.col("_id") / size).cast("bigint").alias("request"))
    rows = grouped.agg(F.sort_array(F.collect_list(F.struct("_id", "doc"))).alias("_rows"))
    packed = F.transform("_rows", lambda r: F.struct(F.col("diagnosis"), r["_id"].alias("_id"), r["doc"].alias("doc")))
    return rows.select("diagnosis", "request", F.size("_rows").alias("n_docs"), packed.alias("docs"))


def send_in_chunks(docs: DataFrame, store: Store, chunk: int = REQUEST) -> None:
    """K3 for an external document store: the executors stage requests of at
    most ``chunk`` documents, and the driver publishes those of the attempts
    that counted -- names of requests, never documents.  What a failed,
    repeated or speculative attempt staged is never published."""
    spark = docs.sparkSession
    spark.dataSource.register(_sink(store))
    requests(docs, chunk).write.format(_SINK).mode("append").save()


class Store(Protocol):
    """An external store as ``send_in_chunks`` uses it (pickled to the executors)."""

    def stage(self, docs: list[dict]) -> str:
        """Take a request without showing it; gives its name."""

    def publish(self, names: list[str]) -> None:
        """Show the staged requests of these names, all of them."""

    def discard(self, names: list[str]) -> None:
        """Forget the staged requests of these names."""


_SINK = "document_store"


def _sink(store: Store) -> type[DataSource]:
    """A data source that writes requests to the store, a task's requests in one message."""

    @dataclass
    class Staged(WriterCommitMessage):
        names: list[str]

    class Writer(DataSourceWriter):
        def write(self, rows: Iterator[Row]) -> Staged:
            names = []
            try:
                for row in rows:
                    names.append(store.stage([d.asDict() for d in row["docs"]]))
            except BaseException:
                store.discard(names)
                raise
            return Staged(names)

        def commit(self, messages: list[Staged | None]) -> None:
            store.publish([n for m in messages if m is not None for n in m.names])

        def abort(self, messages: list[Staged | None]) -> None:
            store.discard([n for m in messages if m is not None for n in m.names])

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return _SINK

        def writer(self, schema, overwrite: bool) -> Writer:
            return Writer()

    return Sink
