"""Document fingerprints: a quartile bucket digest.

Every byte triplet inside a sliding window of ``SPAN`` bytes is hashed into
one of ``BUCKETS`` counters.  The digest holds the logarithm of the length and
two bits per bucket: in which quartile of all counts the bucket's count lies.
Two digests are compared by a difference score -- bucket steps, length steps,
quartile ratios -- bounded by the score of opposite digests, so the likeness
is a number from 0 to 1.

Edge cases: a null text counts as empty; a text without a triplet has an
all-zero body; repeated rows and equal texts have equal digests; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import text_totals, whole_text

#: Bytes of text in a range of neighbouring ids, about; there are at most
#: RANGES of them (the driver knows each by one number), so beyond that many
#: they grow.  A range is sorted and streamed, never held.
RANGE_BYTES = 8 << 20
RANGES = 10000
BUCKETS = 128
SPAN = 5
#: (first, second, third) offsets of the triplets that end a window of SPAN bytes.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
_ODD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
#: Steps of the length code; one step is this factor of length.
LENGTH_STEP = 1.1
LENGTH_WEIGHT = 16


#: Score of two codes of a bucket by the quartiles between them.
_STEP = np.array([0, 1, 3, 6])
_LAST = (1 << 63) - 1


def bucket_counts(data: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """How many triplets of the bytes fall into each bucket."""
    total = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - (buckets - 1).bit_length())
    wide = data.astype(np.uint32)
    first, second, third = (wide * odd for odd in _ODD)
    for k, (a, b, c) in enumerate(TRIPLETS):
        n = len(data) - c
        if n > 0:
            mixed = first[a:a + n] + second[b:b + n]
            mixed ^= mixed >> np.uint32(15)
            mixed += third[c:c + n]
            mixed *= np.uint32(0x27D4EB2F)
            total += np.bincount(mixed >> shift, minlength=buckets)
    return total


def digest(text: str, buckets: int = BUCKETS) -> str:
    """Hex digest of one text: length code, the two quartile ratios, the bucket quartiles."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = bucket_counts(data, buckets)
    length = 0 if not len(data) else min(255, 1 + int(np.log(len(data)) / np.log(LENGTH_STEP)))
    if not count.any():
        return f"{length:02x}00" + "00" * (buckets // 4)
    q1, q2, q3 = (int(x) for x in np.partition(count, (buckets // 4 - 1, buckets // 2 - 1, 3 * buckets // 4 - 1))[
        [buckets // 4 - 1, buckets // 2 - 1, 3 * buckets // 4 - 1]])
    ratios = (q1 * 15 // max(q3, 1)) << 4 | (q2 * 15 // max(q3, 1))
    codes = ((count > q1).astype(np.uint8) + (count > q2) + (count > q3)).astype(np.uint8)
    packed = codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]
    return f"{length:02x}{ratios:02x}" + packed.tobytes().hex()


def difference(a: str, b: str) -> float:
    """Difference score of two digests: 0 for equal ones, at most ``bound``."""
    x, y = (np.frombuffer(bytes.fromhex(d), np.uint8).astype(np.int16) for d in (a, b))
    steps = np.zeros(1, np.int64)
    for shift in (0, 2, 4, 6):
        steps = steps + _STEP[np.abs((x[2:] >> shift & 3) - (y[2:] >> shift & 3))].sum()
    length = min(abs(int(x[0]) - int(y[0])) * LENGTH_WEIGHT, 16 * LENGTH_WEIGHT)
    ratios = abs(int(x[1]) // 16 - int(y[1]) // 16) + abs(int(x[1]) % 16 - int(y[1]) % 16)
    return float(steps[0] + length + ratios)


def bound(buckets: int = BUCKETS) -> float:
    return float(_STEP[3] * buckets + 16 * LENGTH_WEIGHT + 30)


def expected(buckets: int = BUCKETS) -> float:
    """Mean bucket score of two digests of unrelated texts: every quartile equally likely."""
    return buckets * float(np.mean([_STEP[abs(i - j)] for i in range(4) for j in range(4)]))


def likeness(a: str, b: str) -> float:
    """1 for equal digests, falling to 0 at the score of unrelated ones and beyond."""
    return max(0.0, 1.0 - difference(a, b) / expected((len(a) - 4) * 2))


def fingerprints(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, fingerprint) of every document; nothing is shuffled."""
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: digest(t, buckets))

    return docs.select("doc_id", of(whole_text()).alias("fingerprint"))


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(key, doc_id, text, rng, after): the documents dealt into ranges of
    ascending doc_id, each range closed by a copy (``after`` 1) of the document
    that follows it; the first document follows the last.

    The ranges are cut at approximate quantiles; the driver holds one number
    per range, and the texts are shuffled once.  A null id comes last.
    """
    n, size = text_totals(docs)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("key"), "doc_id",
                        whole_text().alias("text"))
    ranges = min(max(1, math.ceil(size / range_bytes)), RANGES)
    probs = [k / ranges for k in range(1, ranges)]
    cuts = np.array(sorted(set(keyed.approxQuantile("key", probs, 0.2 / ranges))) if probs and n else [], np.float64)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(np.float64), side="right").astype(np.int32))

    heads = sorted((r["rng"], r["key"]) for r in
                   keyed.select("key", range_of("key").alias("rng")).groupBy("rng").agg(F.min("key").alias("key")).collect())
    follows = {key: heads[k - 1][0] for k, (_, key) in enumerate(heads)}
    head_keys = np.array(sorted(follows), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            rng = np.searchsorted(cuts, keys.astype(np.float64), side="right").astype(np.int32)
            names = [*batch.schema.names, "rng", "after"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rng), pa.array(np.zeros(len(rng), np.int32))], names)
            again = np.flatnonzero(np.isin(keys, head_keys))
            if len(again):
                extra = batch.take(pa.array(again))
                yield pa.RecordBatch.from_arrays(
                    [*extra.columns, pa.array([follows[k] for k in keys[again].tolist()], pa.int32()),
                     pa.array(np.ones(len(again), np.int32))], names)

    kind = dict(docs.dtypes)["doc_id"]
    return (keyed.mapInArrow(deal, f"key long, doc_id {kind}, text string, rng int, after int")
            .repartition("rng").sortWithinPartitions("rng", "after", "key", "text"))


def compared(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: its digest, that of its edited text (the last
    quarter of its code points replaced by the first as many of the next
    document) and the likeness to that and to the next document's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, after in zip(*(batch.column(k).to_pylist() for k in (1, 2, 4))):
                if after and before is None:  # a range is closed once
                    continue
                own = digest(text, buckets)
                if before is not None:
                    old_id, old, old_digest = before
                    cut = len(old) // 4
                    edited = old[:len(old) - cut] + text[:cut]
                    new = digest(edited, buckets)
                    rows.append((old_id, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                 old_digest, new, likeness(old_digest, new), likeness(old_digest, own)))
                before = None if after else (doc_id, text, own)
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(1).type), pa.array(columns[1], pa.int64()),
                 *[pa.array(c, pa.string()) for c in columns[2:5]], *[pa.array(c, pa.float64()) for c in columns[5:]]],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    kind = dict(docs.dtypes)["doc_id"]
    return with_next(docs).mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
