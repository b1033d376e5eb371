"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping reference blocks of ``window // 2``
words; a window of ``window`` words always holds a whole block of the document
it was taken from.  The blocks are indexed, every rolling window of a block's
length probes the index, and a hit is extended word by word -- through the
``window``-word windows around it -- to the maximal exact repeat.  Words
covered by a window that also starts in a document with a smaller id go.

Probes and extensions are exchanged as packed keys between chunks of
documents (see ``chunks``), so the cost is linear in the words: a passage with
any number of copies never makes pairs, and one that a third of the documents
share is one key per chunk.  Windows count as equal if 64 bits of one hash
and the bucket of another agree.

Edge cases: a null text has no words; texts shorter than a window are kept;
rows with equal ids never remove words from one another; rows with a null id
are kept as they are and remove nothing; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.chunks import Chunks, answered, answers, bits, by_bucket, first_of, flags, mixed, narrow_bytes
from caseload.llm.chunks import rolling, texts_of, wide_ints, word_hashes
from caseload.llm.common import written

WINDOW = 50
_KEYS = "bucket int, chunk int, keys binary, extra binary"


class _Words:
    """The words of a chunk as hashes, document after document."""

    def __init__(self, rows: pa.Table):
        self.ids, self.known, self.texts = texts_of(rows)
        self.hashes, self.first = word_hashes(self.texts)
        self.doc = np.repeat(np.arange(len(self.texts)), np.diff(self.first))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, whether it lies in one known document) of the windows of ``k`` words."""
        if len(self.hashes) < k:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        with np.errstate(over="ignore"):
            h = rolling(self.hashes, k)
        doc = self.doc[:len(h)]
        return h, (doc == self.doc[k - 1:]) & self.known[doc]


class _Probes:
    """The distinct probe keys of a chunk, in sending order, and where they occur."""

    def __init__(self, words: _Words, block: int, buckets: int):
        h, valid = words.windows(block)
        at = np.flatnonzero(valid)
        h = h[at]
        bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        key = bucket << 32 | (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
        order = np.argsort(key, kind="stable")
        self.at, key = at[order], key[order]
        doc = words.ids[words.doc[self.at]]
        index = (self.at - words.first[words.doc[self.at]]) % block == 0
        start = first_of(key)
        self.of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(key)]))
        self.keys = key[start]
        self.indexed = np.logical_or.reduceat(index, start) if len(start) else np.zeros(0, bool)
        many = (np.maximum.reduceat(doc, start) != np.minimum.reduceat(doc, start)) if len(start) else self.indexed
        self.local = many & self.indexed  # shared by documents of this chunk


def _sent(chunk: int, parts: list[tuple[int, bytes, bytes]]) -> pa.Table:
    return pa.table({"bucket": pa.array([p[0] for p in parts], pa.int32()),
                     "chunk": pa.array([chunk] * len(parts), pa.int32()),
                     "keys": pa.array([p[1] for p in parts], pa.binary()),
                     "extra": pa.array([p[2] for p in parts], pa.binary())})


def _answered_flags(bucket: np.ndarray, buckets: int, got: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(len(bucket), bool)
    for b, part in by_bucket(bucket):
        out[part] = flags(got[b], part.stop - part.start)
    return out


def _probe(table: pa.Table) -> list[bytes]:
    """In a bucket: a key is shared if two chunks have it and one indexes it."""
    keys = [np.frombuffer(k.as_py(), "<u4") for k in table.column("keys")]
    indexed = np.concatenate([flags(e.as_py(), len(k)) for e, k in zip(table.column("extra"), keys)])
    sizes = np.cumsum([0, *map(len, keys)])
    joined = np.concatenate(keys)
    order = np.argsort(joined, kind="stable")
    start = first_of(joined[order])
    n = np.diff(np.r_[start, len(order)])
    shared = np.logical_or.reduceat(indexed[order], start) & (n > 1)
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(shared, n)
    return [bits(out[a:b]) for a, b in zip(sizes, sizes[1:])]


class _Extensions:
    """The windows around the hits of a chunk: distinct keys with their least id, and where they occur."""

    def __init__(self, words: _Words, probes: _Probes, hit: np.ndarray, window: int, block: int, buckets: int):
        h, valid = words.windows(window)
        near = np.zeros(len(words.hashes) + 1, np.int64)
        at = probes.at[hit[probes.of]]
        np.add.at(near, np.maximum(at - block + 1, 0), 1)
        np.add.at(near, at + 1, -1)
        at = np.flatnonzero((np.cumsum(near)[:len(h)] > 0) & valid)
        h = h[at]
        bucket = (mixed(h, 0x5851F42D4C957F2D) % np.uint64(buckets)).astype(np.int64) if len(h) else np.zeros(0, np.int64)
        order = np.lexsort((h, bucket))
        self.at, h, bucket = at[order], h[order], bucket[order]
        self.doc = words.ids[words.doc[self.at]]
        start = first_of(h)
        self.of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(h)]))
        self.keys, self.bucket = h[start], bucket[start]
        self.least = np.minimum.reduceat(self.doc, start) if len(start) else np.zeros(0, np.int64)


def _extend(table: pa.Table) -> list[bytes]:
    """In a bucket: for each key, whether a smaller id than the chunk's least has it."""
    keys = [np.frombuffer(k.as_py(), "<u8") for k in table.column("keys")]
    least = np.concatenate([wide_ints(e.as_py()) for e in table.column("extra")])
    sizes = np.cumsum([0, *map(len, keys)])
    joined = np.concatenate(keys)
    order = np.argsort(joined, kind="stable")
    start = first_of(joined[order])
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(np.minimum.reduceat(least[order], start), np.diff(np.r_[start, len(order)])) < least[order]
    return [bits(out[a:b]) for a, b in zip(sizes, sizes[1:])]


def dedup(docs: DataFrame, window: int = WINDOW, **sizes) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is the words left, joined
    by one space.  ``sizes``: chunk_bytes, bucket_bytes (see ``chunks``)."""
    block = window // 2
    chunks = Chunks(docs.select("doc_id", "text"), **sizes)
    buckets = chunks.buckets

    def hits(words: _Words, got: dict[int, bytes]) -> tuple[_Probes, np.ndarray]:
        probes = _Probes(words, block, buckets)
        return probes, probes.local | _answered_flags(probes.keys >> 32, buckets, got)

    def send_probes(chunk: int, rows: pa.Table, _) -> pa.Table:
        probes = _Probes(_Words(rows), block, buckets)
        return _sent(chunk, [(b, probes.keys[p].astype("<u4").tobytes(), bits(probes.indexed[p]))
                             for b, p in by_bucket(probes.keys >> 32)])

    def send_extensions(chunk: int, rows: pa.Table, replies: pa.Table) -> pa.Table:
        words = _Words(rows)
        found = _Extensions(words, *hits(words, answers(replies)), window, block, buckets)
        return _sent(chunk, [(b, found.keys[p].astype("<u8").tobytes(), narrow_bytes(found.least[p]))
                             for b, p in by_bucket(found.bucket)])

    def finish(chunk: int, rows: pa.Table, replies: pa.Table) -> pa.Table:
        words = _Words(rows)
        found = _Extensions(words, *hits(words, answers(replies, 0)), window, block, buckets)
        smaller = _answered_flags(found.bucket, buckets, answers(replies, 1))
        gone = found.at[smaller[found.of] | (found.doc > found.least[found.of])]
        cover = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + window, -1)
        keep = np.cumsum(cover[:-1]) == 0
        n_words = np.diff(words.first)
        n_kept = np.diff(np.r_[0, np.cumsum(keep)][words.first])
        kept = []
        for k, text in enumerate(words.texts):
            own = text.split()
            if n_kept[k] < n_words[k]:
                own = compress(own, keep[words.first[k]:words.first[k + 1]])
            kept.append(b" ".join(own).decode("utf-8", "surrogatepass"))
        return pa.table({"doc_id": rows.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_words - n_kept, pa.int64()), "kept": pa.array(kept, pa.string())})

    shared = written(answered(chunks.run(send_probes, _KEYS), _probe), "blocks-shared")
    smaller = written(answered(chunks.run(send_extensions, _KEYS, shared), _extend), "blocks-smaller")
    replies = shared.withColumn("kind", F.lit(0)).unionByName(smaller.withColumn("kind", F.lit(1)))
    return chunks.run(finish, "doc_id long, n_words long, n_removed long, kept string", replies)
