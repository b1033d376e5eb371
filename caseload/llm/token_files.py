"""Token ids as flat files of unsigned integers.

A folder holds, for every range of document ids, three flat files without a
header -- ``.bin``: the ids of its documents one after the other, 16 or 32 bits
each as the vocabulary needs; ``.idx``: 64-bit offsets, in ids, of its
documents and of their end; ``.doc``: the 64-bit document ids -- and a manifest
table with one row per range: its file name, its numbers of documents and ids
and its base, the number of ids in all ranges before it.  Files are
memory-mapped when they are read; in a store that cannot be mapped, ranges of
bytes are read.

Documents are dealt into ranges by a sampled range partitioning and sorted by
Spark, so a range is streamed through the encoder and never held.  A task
writes to names of its own; only the names that its successful attempt hands
to Spark enter the manifest, so a lost executor or a second attempt leaves
files that nothing reads.  The bases are prefix sums over the manifest, one
row per range.

Edge cases: a null text counts as empty and holds the end id alone; a null
``doc_id`` comes last (it is stored as the least 64-bit number); rows that
repeat an id are documents of their own, ordered by a hash of their texts, so
an id with a third of all rows is spread over ranges; a text of any length is
encoded whole, one text at a time; other columns, whatever their names, are
not read; an empty table gives a manifest without rows.
"""

from __future__ import annotations

import math
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseload.llm.common import text_totals, whole_text, written
from caseload.llm.tokens import encoder, vocabulary_size

END = 2
#: Bytes of text in a range: from LEAST up to MOST as the input grows, about WANTED ranges in between.
LEAST, MOST, WANTED = 8 << 20, 1 << 30, 4096
#: Ids that a reader maps or reads at once, at most, but for a longer document.
READ = 4 << 20
_NULL = -(1 << 63)
_FIRST = ["first_null", "first_id", "first_hash", "first_at"]
_RANGE = "first_null boolean, first_id long, first_hash long, first_at long, file string, n_docs long, n_ids long"


def _store(path: str) -> tuple[stores.FileSystem, str]:
    """The file system of a Hadoop path and the path in it."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme != "file":
        return stores.FileSystem.from_uri(path)
    return stores.LocalFileSystem(), "/" + rest.lstrip("/") if colon else path


def range_bytes(size: int) -> int:
    """Bytes of text in a range for so many bytes of text."""
    return min(MOST, max(LEAST, size // WANTED))


def write(docs: DataFrame, path: str, vocabulary: str, ranks: str, end_id: int = END,
          bytes_per_range: int | None = None) -> None:
    """Encode every document of ``docs`` (doc_id, text) into token files below ``path``."""
    _, size = text_totals(docs)
    ranges = max(1, math.ceil(size / (bytes_per_range or range_bytes(size))))
    width = 2 if max(vocabulary_size(vocabulary), end_id + 1) <= 1 << 16 else 4
    order = ["null_id", "doc_id", "text_hash", "at"]
    rows = (docs.select(F.col("doc_id").isNull().alias("null_id"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(whole_text()).alias("text_hash"), F.monotonically_increasing_id().alias("at"),
                        whole_text().alias("text"))
            .repartitionByRange(ranges, *order).sortWithinPartitions(*order))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(vocabulary, ranks), f"<u{width}"
        name, first, files, n_docs, n_ids = uuid.uuid4().hex, None, None, 0, 0
        fs, root = _store(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                found = [np.array([*encode(t.as_py()), end_id], kind) for t in some.column(4)]
                if not found:
                    continue
                if first is None:
                    first = [c[0].as_py() for c in some.columns[:4]]
                    fs.create_dir(f"{root}/files", recursive=True)
                    files = [fs.open_output_stream(f"{root}/files/{name}.{x}", compression=None) for x in ("bin", "idx", "doc")]
                ends = n_ids + np.cumsum([len(x) for x in found], dtype="<i8")
                files[0].write(np.concatenate(found).tobytes())
                files[1].write(np.r_[n_ids, ends[:-1]].astype("<i8").tobytes())
                files[2].write(some.column(1).fill_null(_NULL).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs, n_ids = n_docs + len(found), int(ends[-1])
        if files:
            files[1].write(np.array([n_ids], "<i8").tobytes())
            for f in files:
                f.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip([*first, name, n_docs, n_ids], [
                    pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()])],
                [*_FIRST, "file", "n_docs", "n_ids"])

    done = written(rows.mapInArrow(store, _RANGE), "token-ranges")
    # one row per range, in the order of their first documents
    before = Window.orderBy(*_FIRST).rowsBetween(Window.unboundedPreceding, -1)
    done.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"), "n_docs", "n_ids",
                F.lit(width).alias("width")).write.parquet(f"{path}/manifest")


def _mapped(path: str, file: str, kind: str) -> pa.NativeFile:
    fs, root = _store(path)
    name = f"{root}/files/{file}.{kind}"
    if isinstance(fs, stores.LocalFileSystem):
        return pa.memory_map(name) if fs.get_file_info(name).size else pa.BufferReader(b"")
    return fs.open_input_file(name)


def _part(mapped: pa.NativeFile, kind: str, start: int, end: int) -> np.ndarray:
    """Numbers ``start`` to ``end`` of a mapped file, not copied."""
    width = np.dtype(kind).itemsize
    mapped.seek(start * width)
    return np.frombuffer(mapped.read_buffer((end - start) * width), kind)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files:
    ``start`` counts the ids of all documents before it, the checksum is that
    of its ids as little-endian 32-bit numbers."""
    manifest = spark.read.parquet(f"{path}/manifest")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from documents(**row)

    def documents(file: str, base: int, n_docs: int, n_ids: int, width: int) -> Iterator[pa.RecordBatch]:
        kind = f"<u{width}"
        ids, idx, doc = (_mapped(path, file, x) for x in ("bin", "idx", "doc"))
        if (ids.size(), idx.size(), doc.size()) != (n_ids * width, 8 * n_docs + 8, 8 * n_docs):
            raise ValueError(f"token file {file} is not of the length that the manifest says")
        offsets = _part(idx, "<i8", 0, n_docs + 1)
        k = 0
        while k < n_docs:
            # documents that begin within the next READ ids, and at least one
            end = min(n_docs, k + 10000, max(k + 1, int(np.searchsorted(offsets, offsets[k] + READ))))
            part = _part(ids, kind, int(offsets[k]), int(offsets[end])).astype("<u4")
            here = (offsets[k:end + 1] - offsets[k]).tolist()
            crc = [zlib.crc32(part[a:b].data) for a, b in zip(here, here[1:])]
            doc_id = _part(doc, "<i8", k, end)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id, mask=doc_id == _NULL), pa.array(base + offsets[k:end]),
                 pa.array(np.diff(offsets[k:end + 1])), pa.array(crc, pa.int64())], names)
            k = end

    files = manifest.count()
    return manifest.repartition(max(1, files)).mapInArrow(ranges, "doc_id long, start long, n_tokens long, ids_crc32 long")


class Reader:
    """The ids of all files as one array, mapped where they are used: what a
    training job reads windows from.  Knows the manifest only."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        rows = sorted(map(tuple, spark.read.parquet(f"{path}/manifest").select("base", "n_ids", "file", "width").collect()))
        self.rows = [r for r in rows if r[1]]
        self.bases = [r[0] for r in self.rows]

    def __len__(self) -> int:
        return sum(self.rows[-1][:2]) if self.rows else 0

    def window(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end``, which may lie in several files."""
        out = [np.zeros(0, "<u4")]
        for base, n, file, width in self.rows[max(0, bisect_right(self.bases, start) - 1):]:
            if base >= end:
                break
            if start < base + n:
                out.append(_part(_mapped(self.path, file, "bin"), f"<u{width}", max(start, base) - base, min(end - base, n)))
        return np.concatenate(out).astype("<u4")
