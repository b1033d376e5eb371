"""Documents in chunks, and keys that chunks exchange.

Two operators ask of very many short keys (hashes of word windows, anchors of
byte strings) who else has them.  A row per key would be most of the cost, so
keys travel packed: the documents are dealt into *chunks* of a few MB, written
once as a table bucketed by chunk; each chunk sends its distinct keys to hash
*buckets* as byte arrays, a bucket answers every chunk with a few bits per
key, in the order sent, and the chunk works the keys out again to use the
answer.  A key that a third of all documents share is one entry per chunk.
Chunks and buckets grow with the square root of the input, between bounds, and
their number with the other root: so a row between a chunk and a bucket holds
some thousand keys up to about 0.3 TB, and the rows grow as the input does.
Beyond, where both are as large as a task can hold, rows hold fewer keys each;
the result is the same.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import text_totals
from caseload.session import work_dir

#: Bytes of text in a task over chunks, about, and the least and most in a chunk and for each key bucket.
TASK_BYTES = 8 << 20
CHUNK_BYTES, MOST_CHUNK_BYTES = 2 << 20, 32 << 20
BUCKET_BYTES, MOST_BUCKET_BYTES = 16 << 20, 256 << 20

_ODD = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: A fixed 64-bit value for each byte.
_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE_VALUES = _rng.integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)


def sizes_for(size: int) -> tuple[int, int]:
    """(bytes of a chunk, bytes of a bucket) for so many bytes of text."""
    root = math.isqrt(size)
    return (min(MOST_CHUNK_BYTES, max(CHUNK_BYTES, 64 * root)), min(MOST_BUCKET_BYTES, max(BUCKET_BYTES, 512 * root)))


class Chunks:
    """The written chunk table and the number of key buckets to use with it.

    The table is one of the session's work folders, and its name one of the
    session's catalog: results are read from it for as long as they are used.
    """

    def __init__(self, docs: DataFrame, chunk_bytes: int | None = None, bucket_bytes: int | None = None):
        self.spark = docs.sparkSession
        _, size = text_totals(docs)
        usual = sizes_for(size)
        chunk_bytes, bucket_bytes = chunk_bytes or usual[0], bucket_bytes or usual[1]
        chunks = max(1, math.ceil(size / chunk_bytes))
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        tasks = min(max(1, math.ceil(size / max(TASK_BYTES, chunk_bytes))), most)
        self.buckets = max(1, math.ceil(size / bucket_bytes))
        self.table = f"chunks_{uuid.uuid4().hex[:16]}"
        names = docs.columns

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            for batch in batches:
                of = batch.column(0).to_numpy()
                order = np.argsort(of, kind="stable")
                rows = pa.RecordBatch.from_arrays(batch.columns[1:], names)
                ends = np.flatnonzero(np.r_[np.diff(of[order]) != 0, True]) + 1 if len(of) else []
                start = 0
                for end in ends:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                        out.write_batch(rows.take(pa.array(order[start:end])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(of[order[start]])], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                        ["chunk", "rows"])
                    start = int(end)

        chunk = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(chunks)).cast("int")
        packed = docs.select(chunk.alias("__chunk"), *[F.col(f"`{c}`") for c in names]).mapInArrow(
            pack, "chunk int, rows binary")
        (packed.repartition(tasks, "chunk").write.bucketBy(tasks, "chunk")
         .option("path", work_dir(self.spark, self.table)).saveAsTable(self.table))

    def run(self, work: Callable, schema, replies: DataFrame | None = None) -> DataFrame:
        """``work(chunk, rows: pa.Table, replies: pa.Table | None) -> pa.Table`` for every
        chunk, the replies being those addressed to it."""
        arrow = pa.schema([(c, _arrow(t)) for c, t in _fields(schema)]) if isinstance(schema, str) else None

        def joined(packed: pa.Table) -> pa.Table:
            return pa.concat_tables([pa.ipc.open_stream(pa.py_buffer(r.as_py())).read_all()
                                     for r in packed.column("rows")])

        def done(table: pa.Table) -> pa.Table:
            return table.cast(arrow) if arrow is not None else table

        chunks = self.spark.table(self.table).groupBy("chunk")
        if replies is None:
            def alone(key: tuple, packed: pa.Table) -> pa.Table:
                return done(work(key[0].as_py(), joined(packed), None))

            return chunks.applyInArrow(alone, schema)

        def both(key: tuple, packed: pa.Table, answers: pa.Table) -> pa.Table:
            return done(work(key[0].as_py(), joined(packed), answers))

        return chunks.cogroup(replies.groupBy("chunk")).applyInArrow(both, schema)


def _fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(f.split()) for f in schema.split(",")]


def _arrow(kind: str) -> pa.DataType:
    return {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[kind]


def answered(rows: DataFrame, work: Callable) -> DataFrame:
    """``work(rows: pa.Table) -> list[bytes]`` for every bucket, one answer to each of its rows;
    gives (chunk, bucket, answer)."""
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "answer": pa.array(work(table), pa.binary())})

    return rows.groupBy("bucket").applyInArrow(run, "chunk int, bucket int, answer binary")


def by_bucket(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """(bucket, its part) of keys in ascending order of their buckets."""
    start = first_of(bucket)
    return [(b, slice(x, y)) for b, x, y in zip(bucket[start].tolist(), start.tolist(), [*start[1:].tolist(), len(bucket)])]


def answers(replies: pa.Table, kind: int | None = None) -> dict[int, bytes]:
    """bucket -> its answer to a chunk; of the given kind if there are several."""
    rows = replies.to_pydict()
    kinds = rows.get("kind", [None] * len(rows["bucket"]))
    return {b: a for b, a, k in zip(rows["bucket"], rows["answer"], kinds) if k == kind}


# ---------------------------------------------------------------- arrays

def narrow_bytes(values: np.ndarray) -> bytes:
    """Integers as: least value, bytes a value, and so many low bytes of each difference to the least."""
    least = int(values.min()) if len(values) else 0
    rest = (values.astype(np.int64) - least).astype(np.uint64)
    width = max(1, (int(rest.max() if len(rest) else 0).bit_length() + 7) // 8)
    body = np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return np.array([least, width], "<i8").tobytes() + body.tobytes()


def wide_ints(data: bytes) -> np.ndarray:
    least, width = (int(x) for x in np.frombuffer(data, "<i8", 2))
    body = np.frombuffer(data, np.uint8, offset=16).reshape(-1, width)
    full = np.zeros((len(body), 8), np.uint8)
    full[:, :width] = body
    return full.view("<u8").ravel().astype(np.int64) + least


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result hangs on every bit of ``h``."""
    h = h ^ (h >> np.uint64(31)) ^ np.uint64(seed)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_known_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1); those of usual chunk sizes are worked out once per process."""
    known = _known_powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2)), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 2 * CHUNK_BYTES:
            _known_powers[base] = known
    return known[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] by content, from prefix sums."""
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(_ODD, len(data)), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mixed(h + (ends - starts).astype(np.uint64))


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` values, by doubling the window."""
    done, done_k, cur, cur_k, left = None, 0, values, 1, k
    while left:
        if left & 1:
            if done is None:
                done, done_k = cur, cur_k
            else:
                n = max(0, len(cur) - done_k)
                done, done_k = done[:n] * np.uint64(pow(_ODD, cur_k, 1 << 64)) + cur[done_k:done_k + n], done_k + cur_k
        left >>= 1
        if left:
            n = max(0, len(cur) - cur_k)
            cur, cur_k = cur[:n] * np.uint64(pow(_ODD, cur_k, 1 << 64)) + cur[cur_k:cur_k + n], 2 * cur_k
    return mixed(done)


def first_of(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])


def texts_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(doc ids, which rows have one, texts in UTF-8) of a chunk; a null text is empty."""
    ids = rows.column("doc_id").cast(pa.int64())
    known = ids.is_valid().to_numpy()
    texts = [t.as_py() or b"" for t in rows.column("text").cast(pa.binary())]
    return ids.fill_null(0).to_numpy(), known, texts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts, where each text's words begin, and the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    edge = np.diff(np.r_[True, _BLANK[data], True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    bounds = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return span_hashes(data, starts, ends), np.searchsorted(starts, bounds)
