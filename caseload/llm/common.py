"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.session import work_dir

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to a new folder below ``spark.checkpoint.dir`` and read
    back: later jobs start from the files, also after executors are lost."""
    path = work_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, a null taken as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of maximal runs without ASCII white space."""
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")


def smallest_hashes(rows: DataFrame, size: int) -> DataFrame:
    """``size`` of the rows (all, if there are fewer), those with the smallest
    ``h``, a 32-bit hash.  The rows are counted first and cut at the hash below
    which about as many lie, so no task passes on more than its share."""
    n = rows.count()
    share = min(1.0, (1.2 * size + 100) / n) if n else 1.0
    return rows.where(F.col("h") <= int(share * 0xFFFFFFFF)).orderBy("h", "doc_id").limit(size)


def text_totals(docs: DataFrame) -> tuple[int, int]:
    """(rows, UTF-8 bytes of text): one scan, used to size partitions."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(whole_text())).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)
