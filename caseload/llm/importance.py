"""Importance resampling towards a target distribution.

Features of a text are its runs of one to three consecutive words; a feature's
bucket is its CRC-32 modulo ``BUCKETS``.  A bucket's gain is the smoothed log
ratio of its share in the target and in the documents, a document's weight the
sum of the gains of its features; the documents with the highest weight plus
Gumbel noise (hash-seeded, so reruns agree) are the sample.

Head and tail: the words of the whole corpus are counted, and the exact CRC
states of frequent words and the states and buckets of frequent pairs are
broadcast.  Frequent is what occurs more than once in ``2 ** SHARE`` bytes of
text, so all frequent words together hold at most that many bytes, and there
are at most that many frequent pairs, however large the corpus; words of more
than 8 bytes are left out.  A word or pair outside of the head gets its CRC
directly, from its bytes or by
carrying the state of what comes before over the next word -- CRCs are linear,
so a state moves over n bytes by four table look-ups.  Both ways give the same,
exact buckets; head and tail only differ in what they cost.

Plan: four passes over the texts (words, pairs, bucket totals, weights), each
with sums made in the task before anything is shuffled; only the head and the
bucket totals come to the driver.  Texts are worked through in
pieces cut between words, the last two words carried over, so a text of any
length needs bounded memory (one word of any length is held).  Ranks come from
a range-partitioned sort of the narrow score rows.

Edge cases: a null or empty text, or one without words, has no features and
weight 0; a null ``doc_id`` is hashed as ``null`` and comes last among equal
scores; rows that repeat an id draw alike, each with a rank of its own; equal
scores go to the smaller id, then to fewer features; other columns, whatever
their names, are not read; an empty target gives every bucket the gain of no
target; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import text_totals, whole_text, written
from caseload.operators.ordinal import with_ordinal

BUCKETS = 10000
LEAST_WORDS = 20
#: Share of the documents with enough words that is drawn, in hundredths.
PERCENT = 5
SEED = "42"
#: A word or pair is frequent if it occurs more than once in 2 ** SHARE bytes of text.
SHARE = 17
#: Bytes of the longest word of the head: a word is looked up as one 64-bit number.
WORD = 8
#: Slots of the word table and of the pair table, as powers of two.
WORD_SLOTS, PAIR_SLOTS = 16, 18
#: Bytes of text worked on at once, about, and entries counted before they are handed on.
PIECE, HELD = 2 << 20, 1 << 18
#: States are carried by table over words of so many bytes, longer words are worked out one by one.
LONG = 64

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 bytes, A-Z lower-cased
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")
_IN_WORD = np.array([b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" for b in range(256)])
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: What a CRC-32 state becomes by a byte.
_STEP = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)


def _shifts(most: int) -> np.ndarray:
    """At (n * 4 + byte) * 256 + value: what byte ``byte`` of a CRC-32 state becomes after ``n`` zero bytes."""
    steps = np.zeros((most + 1, 4, 256), np.uint32)
    for k in range(4):
        steps[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, most + 1):
        steps[n] = _STEP[steps[n - 1] & np.uint32(255)] ^ (steps[n - 1] >> np.uint32(8))
    return steps.ravel()


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * _ODD) >> np.uint64(64 - bits)).astype(np.int64)


class Head:
    """The broadcast head: CRC states of frequent words, states and buckets of
    frequent pairs, each in a slot of its own.  Of items that share a slot the
    most frequent has it; the others go the direct way."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]] = ()):
        self.shifts = _shifts(LONG + 1)
        keys = np.array([int.from_bytes(w, "little") for w in words], np.uint64)
        self.word, first = self._placed(keys, WORD_SLOTS)
        self.state, self.spaced = np.zeros((2, 1 << WORD_SLOTS), np.uint32)
        for k in first.tolist():
            slot = int(_slot(keys[k:k + 1], WORD_SLOTS)[0])
            self.state[slot], self.spaced[slot] = zlib.crc32(words[k]), zlib.crc32(b" " + words[k])
        keys = np.array([self.pair_key(a, b) for a, b in pairs], np.uint64)
        self.pair, first = self._placed(keys, PAIR_SLOTS)
        self.crc = np.zeros(1 << PAIR_SLOTS, np.uint32)
        for k in first.tolist():
            self.crc[int(_slot(keys[k:k + 1], PAIR_SLOTS)[0])] = zlib.crc32(b" ".join(pairs[k]))
        self.bucket = self.crc % np.uint32(BUCKETS)

    @staticmethod
    def _placed(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(key of each slot, 0 for none; indices of the keys that got one)."""
        slots, first = np.unique(_slot(keys, bits), return_index=True)
        table = np.zeros(1 << bits, np.uint64)
        table[slots] = keys[first]
        return table, first

    @staticmethod
    def pair_key(a: bytes, b: bytes) -> int:
        at = _slot(np.array([int.from_bytes(a, "little"), int.from_bytes(b, "little")], np.uint64), WORD_SLOTS)
        return (int(at[0]) << WORD_SLOTS) + int(at[1]) + 1

    def word_at(self, slot: int) -> bytes:
        return int(self.word[slot]).to_bytes(8, "little").rstrip(b"\0")

    def carry(self, before: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Each state carried over so many zero bytes, at most LONG + 1."""
        base, byte = n << 10, before.astype("<u4").view(np.uint8).reshape(-1, 4)
        out = self.shifts[base + byte[:, 0]]
        for k in range(1, 4):
            out ^= self.shifts[base + (256 * k) + byte[:, k]]
        return out


def pieces(text: bytes, size: int = PIECE) -> Iterator[tuple[bytes, int]]:
    """(piece, how many of its words only carry over) of a text, lower-cased and cut between words."""
    text, start, carried = text.lower(), 0, []  # of bytes: A-Z only
    while len(text) - start > size:
        gap = _BETWEEN.search(text, start + size)
        end = gap.start() if gap else len(text)
        piece = b" ".join([*carried, text[start:end]])
        yield piece, len(carried)
        carried, start = _WORDS.findall(piece)[-2:], end
    yield b" ".join([*carried, text[start:]]) if carried else text[start:], len(carried)


def _grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """(rows, pieces, carried) of pieces worked on together: about PIECE bytes of text."""
    rows, parts, carried, size = [], [], [], 0
    for batch in batches:
        for k, text in enumerate(batch.column(column).cast(pa.binary())):
            for part, old in pieces(text.as_py()):
                rows.append((batch, k))
                parts.append(part)
                carried.append(old)
                size += len(part)
                if size >= PIECE:
                    yield rows, parts, carried
                    rows, parts, carried, size = [], [], [], 0
    if rows:
        yield rows, parts, carried


class Words:
    """The words of some pieces: where they are, and which of them the head knows."""

    def __init__(self, parts: list[bytes], head: Head):
        self.data = b"\n".join([b"", *parts, b"\0" * 8])
        self.bytes = np.frombuffer(self.data, np.uint8)
        edge = np.flatnonzero(np.diff(_IN_WORD[self.bytes].view(np.int8))) + 1
        self.start, self.length = edge[::2], edge[1::2] - edge[::2]
        ends = np.cumsum([len(p) + 1 for p in parts])
        count = np.diff(np.searchsorted(self.start, ends), prepend=0)
        self.own = np.repeat(np.arange(len(parts)), count)
        self.place = np.arange(len(self.start)) - np.repeat(np.cumsum(count) - count, count)  # in the piece
        eight = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))[self.start]
        key = eight & (np.uint64(0xFFFFFFFFFFFFFFFF) >> np.uint64(8) * (8 - np.minimum(self.length, 8)).astype(np.uint64))
        self.slot = _slot(key, WORD_SLOTS)
        self.known = (head.word[self.slot] == key) & (self.length <= WORD)

    def __getitem__(self, k: int) -> bytes:
        return self.data[self.start[k]:self.start[k] + self.length[k]]

    def states(self, head: Head) -> tuple[np.ndarray, np.ndarray]:
        """CRC of each word, and of a blank and the word: the head's, or from its bytes."""
        state, spaced = head.state[self.slot], head.spaced[self.slot]
        tail = np.flatnonzero(~self.known)
        tail = tail[np.argsort(-np.minimum(self.length[tail], LONG + 1).astype(np.int8), kind="stable")]
        n, start = self.length[tail], self.start[tail]
        crc = np.full(len(tail), 0xFFFFFFFF, np.uint32)
        longer = np.cumsum(np.bincount(np.minimum(n, LONG + 1), minlength=LONG + 2)[::-1])[::-1]
        for j in range(LONG):  # byte by byte, the words that have one
            m = int(longer[j + 1])
            crc[:m] = _STEP[(crc[:m] ^ self.bytes[start[:m] + j]) & np.uint32(255)] ^ (crc[:m] >> np.uint32(8))
        crc ^= np.uint32(0xFFFFFFFF)
        # over a blank and a word: the state of the blank carried over the word, and that of the word
        after = head.carry(np.full(len(tail), zlib.crc32(b" "), np.uint32), np.minimum(n, LONG)) ^ crc
        for k in np.flatnonzero(n > LONG).tolist():
            word = self[tail[k]]
            crc[k], after[k] = zlib.crc32(word), zlib.crc32(b" " + word)
        state[tail], spaced[tail] = crc, after
        return state, spaced

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(index of the second word, key) of the neighbours in a piece; the key counts only if the head knows both."""
        second = np.flatnonzero(self.place >= 1)
        return second, ((self.slot[second - 1] << WORD_SLOTS) + self.slot[second] + 1).astype(np.uint64)


def features(parts: list[bytes], carried: list[int], head: Head) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, piece) of every feature that ends in a word that is not
    carried over, and the number of such words of each piece."""
    words = Words(parts, head)
    fresh = words.place >= np.array(carried, np.int64)[words.own]
    state, spaced = words.states(head)

    def over(before: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The states ``before`` carried over a blank and the words that end at ``ends``."""
        n = words.length[ends] + 1
        out = head.carry(before, np.minimum(n, LONG + 1)) ^ spaced[ends]
        for k in np.flatnonzero(n > LONG + 1).tolist():
            out[k] = zlib.crc32(b" " + words[ends[k]], int(before[k]))
        return out

    second, key = words.pairs()
    slot = _slot(key, PAIR_SLOTS)
    in_head = (head.pair[slot] == key) & words.known[second - 1] & words.known[second]
    two, bucket_two = np.zeros((2, len(words.start)), np.uint32)
    known, slot = second[in_head], slot[in_head]
    two[known], bucket_two[known] = head.crc[slot], head.bucket[slot]
    tail = second[~in_head]
    two[tail] = found = over(state[tail - 1], tail)
    bucket_two[tail] = found % np.uint32(BUCKETS)
    third = np.flatnonzero((words.place >= 2) & fresh)
    three = over(two[third - 1], third)
    second = second[fresh[second]]
    return (np.concatenate([state[fresh] % np.uint32(BUCKETS), bucket_two[second], three % np.uint32(BUCKETS)]),
            np.concatenate([words.own[fresh], words.own[second], words.own[third]]),
            np.bincount(words.own[fresh], minlength=len(parts)))


def frequent_words(texts: DataFrame, least: int) -> list[bytes]:
    """The words of at most WORD bytes that a column ``text`` holds ``least``
    times or more, the most frequent first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())],
                                              ["item", "n"])

        for _, parts, carried in _grouped(batches, 0):
            for part, old in zip(parts, carried):
                n.update(_WORDS.findall(part)[old:])
            if len(n) > HELD:
                yield counted()
                n.clear()
        if n:
            yield counted()

    per = texts.mapInArrow(run, "item binary, n long").groupBy("item").agg(F.sum("n").alias("n"))
    found = per.where((F.col("n") >= least) & (F.octet_length("item") <= WORD)).collect()
    return [bytes(r["item"]) for r in sorted(found, key=lambda r: (-r["n"], r["item"]))]


def frequent_pairs(texts: DataFrame, words: list[bytes], least: int) -> list[tuple[bytes, bytes]]:
    """The pairs of neighbours among ``words`` that occur ``least`` times or
    more, the most frequent first (words that got no slot left out)."""
    known = Head(words)
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], ["item", "n"])

        for _, parts, carried in _grouped(batches, 0):
            words = Words(parts, shared.value)
            second, key = words.pairs()
            fresh = words.place[second] >= np.array(carried, np.int64)[words.own[second]]
            held.append(key[words.known[second - 1] & words.known[second] & fresh])
            size += len(held[-1])
            if size > 16 * HELD:
                yield summed()
                held, size = [], 0
        if size:
            yield summed()

    per = texts.mapInArrow(run, "item long, n long").groupBy("item").agg(F.sum("n").alias("n"))
    found = sorted(per.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["item"]))
    return [tuple(known.word_at(x) for x in divmod(r["item"] - 1, 1 << WORD_SLOTS)) for r in found]


def head_of(docs: DataFrame) -> Head:
    """The words and pairs that make up more than a fixed share of all text."""
    texts = docs.select(whole_text().alias("text"))
    least = (text_totals(docs)[1] >> SHARE) + 1
    words = frequent_words(texts, least)  # a pair is no more frequent than its words
    return Head(words, frequent_pairs(texts, words, least))


def bucket_totals(docs: DataFrame, head) -> np.ndarray:
    """How many features of all rows fall into each bucket; ``head`` is broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, parts, carried in _grouped(batches, 0):
            total += np.bincount(features(parts, carried, head.value)[0], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["item", "n"])

    out = np.zeros(BUCKETS, np.int64)
    texts = docs.select(whole_text().alias("text"))
    for r in texts.mapInArrow(run, "item long, n long").groupBy("item").agg(F.sum("n").alias("n")).collect():
        out[r["item"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of the B buckets."""
    s_all, t_all, b = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, head, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document, as a written table."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value.astype(np.float64)
        last, held = None, [0, 0, 0]  # of a text whose pieces are worked on in several groups
        for rows, parts, carried in _grouped(batches, 1):
            bucket, own, n_words = features(parts, carried, head.value)
            n_features = np.bincount(own, minlength=len(rows))
            weight = np.rint(np.bincount(own, gain[bucket], minlength=len(rows))).astype(np.int64)
            out: list[list] = [[], [], [], []]
            for (batch, k), *found in zip(rows, n_words.tolist(), n_features.tolist(), weight.tolist()):
                if last is not None and (last[0] is not batch or last[1] != k):
                    for column, x in zip(out, [last[0].column(0)[last[1]].as_py(), *held]):
                        column.append(x)
                    held = [0, 0, 0]
                last, held = (batch, k), [a + b for a, b in zip(held, found)]
            yield _weights(out, batch.schema.field(0).type)
        if last is not None:
            yield _weights([[x] for x in (last[0].column(0)[last[1]].as_py(), *held)], last[0].schema.field(0).type)

    return written(docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, n_features long, weight long"), "importance-weights")


def _weights(columns: list[list], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                                      ["doc_id", "n_words", "n_features", "weight"])


def _noise(seed: str) -> Column:
    """floor(-1000 ln(-ln(u))): Gumbel noise from the id's digest."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
              seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document;
    rank counts the drawn ones from 1, highest score first, and is null otherwise."""
    head = docs.sparkSession.sparkContext.broadcast(head_of(docs))
    gain = gains(bucket_totals(docs, head), bucket_totals(target, head))
    scored = weighed(docs, head, gain).withColumn("score", F.col("weight") + _noise(seed))
    eligible = scored.where(F.col("n_words") >= least_words)
    n = percent * eligible.count() // 100
    order = {"neg_score": -F.col("score"), "no_id": F.col("doc_id").isNull()}
    ranked = with_ordinal(eligible.withColumns(order), [*order, "doc_id", "n_features"], name="rank").drop(*order)
    rank = F.when(F.col("rank") < n, F.col("rank") + 1)
    return ranked.withColumn("rank", rank).unionByName(
        scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def drawn(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The documents that the sample holds, each row with its columns; rows
    that repeat an id are all in it as soon as one is."""
    chosen = resampled(docs, target, **how).where("rank is not null").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
