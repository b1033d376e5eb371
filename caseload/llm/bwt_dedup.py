"""Suffix-array dedup: merging the Burrows-Wheeler transforms of shards.

A byte goes if a ``length``-byte string over it also starts in a document with
a smaller id.  Suffixes of the whole corpus are never sorted together:

1. *Anchored strings.*  Each window of ``length`` bytes is anchored at the
   least hash of its ``anchor``-byte substrings; the consecutive windows with
   one anchor make one short string.  Equal windows have equal anchors, so
   every repeat lies within the strings of one anchor.  Chunks send each
   anchor with the digest of its string.  An anchor that only one document has
   is done with.  Copies of a string are one string of the collection: if an
   anchor has but one distinct string, its windows are those of the smallest id.
2. *Merge.*  The other strings go to buckets.  Each sending chunk's strings
   are a shard with a transform of their own; the shards' transforms are
   interleaved by iterative refinement (``interleave``): starting from shard
   after shard, every round reads the transforms in the current order and
   deals the slots out, stably, by symbol, which extends the common prefix by
   one symbol.  Boundaries between slots that differ are kept per round; after
   ``length / SYMBOL`` rounds the slots between two boundaries are one repeated
   interval, and the least id in it decides for all.
3. *Hot anchors.*  The first and the last anchor of a passage that many
   documents share have a string for each document, as their strings reach into
   the documents' own bytes.  An anchor that chunks send more than ``most``
   strings of is split by a second key, the hash of a window's bytes: each
   window is a string of its own, its copies are one per chunk, and it has but
   one distinct string, so its windows are those of the smallest id: nothing is
   left to interleave.  No merge then holds more than ``most`` strings of an
   anchor.  (A second anchor instead would not bound it: a window that has one
   byte of its own and 49 of the passage mostly keeps an anchor in the passage.)
4. Chunks apply the answers to their bytes.

A symbol is a block of ``SYMBOL`` bytes, so a string counts as SYMBOL phase
strings and a suffix starts at every byte.  Anchors and strings are exchanged
packed (see ``chunks``): an anchor that a third of the documents share is one
entry per chunk, and one more per distinct string if it goes to a merge.
In a merge all that counts as equal is compared byte by byte: copies of a
string, and the windows of an interval.  Where bytes are not sent, strings
count as equal if a 64-bit digest and 32 bits and the bucket of their anchor
agree, windows of hot anchors if two independent 64-bit hashes do.

Edge cases: a null text is empty; texts shorter than ``length`` are kept, texts
of any length are worked on whole, in the memory of one task; of rows with
equal windows the smallest id keeps them; rows with equal ids never remove
bytes from one another; rows with a null id are kept as they are and remove
nothing; other columns, whatever their names, are carried or not read; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.chunks import BYTE_VALUES, Chunks, answered, answers, bits, by_bucket, first_of, flags, mixed
from caseload.llm.chunks import narrow_bytes, rolling, span_hashes, texts_of, wide_ints
from caseload.llm.common import written

LENGTH = 50
ANCHOR = 20
SYMBOL = 10
#: Windows of a string, at most (its answer is a 32-bit mask).
RUN = 32
#: Merge buckets for each bucket of anchors: a merge holds much more than the strings' bytes.
FINER = 4
#: Strings of an anchor in a merge, at most (a string takes some KB there).
MOST = 1000
_CACHED = 1 << 16


def sliding_min(values: np.ndarray, k: int) -> np.ndarray:
    span = 1
    while 2 * span <= k:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:len(values) - (k - span)], values[k - span:]) if span < k else values


def anchors_of(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the ``anchor`` bytes from each place, least such hash in the
    window of ``length`` bytes from each place), worked out in blocks that the
    processor's caches hold."""
    hashes = np.empty(len(data) - anchor + 1, np.uint64)
    least = np.empty(len(data) - length + 1, np.uint64)
    for at in range(0, len(least), _CACHED):
        n = min(_CACHED, len(least) - at)
        h = rolling(BYTE_VALUES[data[at:at + n + length - 1]], anchor)
        hashes[at:at + len(h)] = h
        least[at:at + n] = sliding_min(h, length - anchor + 1)
    return hashes, least


def _digests(hashes: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: int, most: int) -> np.ndarray:
    """Hashes of data[start:start + size] from those of pieces that cover it;
    as many pieces as ``most`` bytes take, so that all chunks hash alike."""
    out = size.astype(np.uint64)
    for k in range(0, most, anchor):
        piece = hashes[start + np.minimum(k, size - anchor)]
        out = out * np.uint64(0x9E3779B97F4A7C15) + piece
    return mixed(out)


class _Strings:
    """The anchored strings of a chunk, the distinct ones (entries) in sending order."""

    def __init__(self, rows: pa.Table, length: int, anchor: int, buckets: int):
        self.ids, known, self.texts = texts_of(rows)
        self.data = data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.bounds = np.cumsum([0, *map(len, self.texts)])
        self.start = self.n = self.of = self.rep = self.keys = self.digest = self.least = np.zeros(0, np.int64)
        self.anchors = self.strings = np.zeros(0, np.int64)
        self.many = np.zeros(0, bool)
        self.length, self.anchor, self.hashes = length, anchor, np.zeros(0, np.uint64)
        if len(data) < length:
            return
        self.hashes, least = anchors_of(data, length, anchor)
        inside = np.ones(len(least) + 1, bool)  # windows within one known document
        inside[-1] = False
        for k, (a, b) in enumerate(zip(self.bounds.tolist(), self.bounds[1:].tolist())):
            inside[(max(a, b - length + 1) if known[k] else a):b] = False
        new = np.empty(len(least) + 1, bool)
        new[0] = new[-1] = True
        np.not_equal(least[1:], least[:-1], out=new[1:-1])
        new[1:] |= inside[1:] != inside[:-1]
        edges = np.flatnonzero(new)
        begin, n = edges[:-1], np.diff(edges)
        begin, n = begin[inside[begin]], n[inside[begin]]
        if not len(begin):
            return
        pieces = -(-n // RUN)  # strings of RUN windows at most
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(begin, pieces) + within * RUN
        n = np.minimum(np.repeat(n, pieces) - within * RUN, RUN)
        digest = _digests(self.hashes, start, n + length - 1, anchor, length + RUN - 1)
        spread = mixed(least[start], 0x2545F4914F6CDD1D)
        bucket = ((spread >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        keys = bucket << 32 | (spread & np.uint64(0xFFFFFFFF)).astype(np.int64)
        order = np.lexsort((digest, keys))
        self.start, self.n, keys, digest = start[order], n[order], keys[order], digest[order]
        self.doc = self.ids[np.searchsorted(self.bounds, self.start, side="right") - 1]
        entry = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (digest[1:] != digest[:-1])])
        self.of = np.repeat(np.arange(len(entry)), np.diff(np.r_[entry, len(keys)]))
        self.rep = entry  # a place of each entry
        self.keys, self.digest, self.least = keys[entry], digest[entry], np.minimum.reduceat(self.doc, entry)
        group = first_of(keys)
        self.many = np.maximum.reduceat(self.doc, group) != np.minimum.reduceat(self.doc, group)
        self.anchors = first_of(self.keys)  # the first entry of each anchor
        self.strings = np.diff(np.r_[self.anchors, len(self.keys)])  # and how many it has


def _sent(chunk: int, parts: list[tuple]) -> pa.Table:
    columns = list(zip(*parts)) or [()] * 5
    return pa.table({"bucket": pa.array(columns[0], pa.int32()), "chunk": pa.array([chunk] * len(parts), pa.int32()),
                     **{c: pa.array(v, pa.binary()) for c, v in zip(("keys", "digests", "least", "many"), columns[1:])}})


_SENT = "bucket int, chunk int, keys binary, digests binary, least binary, many binary"
#: What a bucket says of a chunk's anchor: only one document has it; it has one
#: string and no smaller id has it; ... and a smaller one has; it has several
#: strings; or more than a merge takes.
_ALONE, _FIRST, _COPY, _SEVERAL, _HOT = range(5)


def _anchors(s: _Strings, buckets: int) -> list[tuple]:
    """For each bucket the anchors of a chunk: digest of the first string, number
    of strings, least id, whether several ids have it."""
    a = s.anchors
    least = np.minimum.reduceat(s.least, a) if len(a) else s.least
    out = []
    for b, p in by_bucket(s.keys[a] >> 32):
        several = s.strings[p] > 1
        out.append((b, s.keys[a][p].astype("<u4").tobytes(), s.digest[a][p].astype("<u8").tobytes(), narrow_bytes(least[p]),
                    bits(s.many[p]) + bits(several) + narrow_bytes(s.strings[p][several])))
    return out


def _compare(most: int):
    def run(table: pa.Table) -> list[bytes]:
        """In a bucket: the state of every anchor of every chunk, three bits each."""
        keys = [np.frombuffer(k.as_py(), "<u4") for k in table.column("keys")]
        sizes = np.cumsum([0, *map(len, keys)])
        digest = np.concatenate([np.frombuffer(d.as_py(), "<u8") for d in table.column("digests")])
        least = np.concatenate([wide_ints(x.as_py()) for x in table.column("least")])
        many, strings = np.zeros(sizes[-1], bool), np.ones(sizes[-1], np.int64)
        for x, a, b in zip(table.column("many"), sizes, sizes[1:]):
            sent, half = x.as_py(), -(-(b - a) // 8)
            many[a:b] = flags(sent[:half], b - a)
            strings[a:b][flags(sent[half:2 * half], b - a)] = wide_ints(sent[2 * half:])
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        start = first_of(joined[order])
        n = np.diff(np.r_[start, len(order)])
        low = np.minimum.reduceat(least[order], start)
        shared = (np.maximum.reduceat(least[order], start) != low) | np.logical_or.reduceat(many[order], start)
        one = np.maximum.reduceat(digest[order], start) == np.minimum.reduceat(digest[order], start)
        one &= np.maximum.reduceat(strings[order], start) == 1
        several = np.where(np.add.reduceat(strings[order], start) > most, _HOT, _SEVERAL)
        state = np.zeros(len(order), np.uint8)
        state[order] = np.repeat(np.where(shared, np.where(one, _FIRST, several), _ALONE), n)
        floor = np.zeros(len(order), np.int64)
        floor[order] = np.repeat(low, n)
        state[(state == _FIRST) & (floor < least)] = _COPY
        return [b"".join(bits(state[a:b] >> k & 1) for k in range(3)) for a, b in zip(sizes, sizes[1:])]

    return run


def _states(s: _Strings, buckets: int, got: dict[int, bytes]) -> np.ndarray:
    """The state of every entry: that of its anchor."""
    keys = s.keys[s.anchors]
    state = np.zeros(len(keys), np.uint8)
    for b, part in by_bucket(keys >> 32):
        n, third = part.stop - part.start, len(got[b]) // 3
        for k in range(3):
            state[part] += flags(got[b][k * third:(k + 1) * third], n).astype(np.uint8) << k
    return np.repeat(state, s.strings)


def _stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable argsort of non-negative integers below 2 ** (63 - places' bits),
    by sorting (key, place) in one number."""
    width = max(1, len(keys).bit_length())
    both = keys.astype(np.int64) << width
    both |= np.arange(len(keys))
    both.sort()
    both &= (1 << width) - 1
    return both.astype(np.int32)


def shard_transform(symbols: list[np.ndarray], before: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, their preceding symbols): the transform of every
    shard, one after the other.  ``symbols[r]`` is the symbol of each suffix
    after r symbols (0 past its end); orders are kept to that many symbols."""
    order = np.arange(len(before), dtype=np.int32)
    for column in reversed(symbols):
        order = order[_stable_order(column[order])]
    order = order[_stable_order(shard[order])]
    return order, before[order]


def interleave(transform: np.ndarray, sizes: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms (one after the other, of the given sizes) into one.

    Gives (slot, interval) of every transform entry: its slot in the merged
    order to ``rounds`` symbols, and the number of the interval of slots whose
    prefixes of so many symbols are equal.
    """
    n = len(transform)
    source = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    interval = np.zeros(n, np.int32)
    slots = np.arange(n, dtype=np.int32)  # of the entries, shard after shard
    symbol = np.empty(n, transform.dtype)
    for _ in range(rounds):
        symbol[slots] = transform  # the r-th slot of a shard reads its r-th symbol
        order = _stable_order(symbol)
        sorted_symbol, source, interval = symbol[order], source[order], interval[order]
        edge = np.zeros(n, bool)
        edge[1:] = interval[1:] != interval[:-1]
        edge &= sorted_symbol != 0  # all ends are alike
        edge[1:] |= sorted_symbol[1:] != sorted_symbol[:-1]
        interval = np.cumsum(edge, dtype=np.int32)
        slots = _stable_order(source)
    return slots, interval[slots]


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a:a + size] is data[b:b + size], of each (a, b, size)."""
    first = np.cumsum(size) - size
    step = np.arange(size.sum()) - np.repeat(first, size)
    return np.logical_and.reduceat(data[np.repeat(a, size) + step] == data[np.repeat(b, size) + step], first) if len(size) else size > 0


def _distinct(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct string, in order, the distinct string of
    each): found by hash and compared; should hashes ever meet, by the bytes."""
    _, one, same = np.unique(span_hashes(data, start, start + size), return_index=True, return_inverse=True)
    other = one[same]
    if (size == size[other]).all() and _same_bytes(data, start, start[other], size).all():
        first = np.sort(one)
        return first, np.searchsorted(first, one)[same]
    known: dict[bytes, int] = {}
    same = np.array([known.setdefault(data[a:a + n].tobytes(), len(known)) for a, n in zip(start, size)])
    return first_of(np.maximum.accumulate(same)), same


def _exact(data: np.ndarray, at: np.ndarray, interval: np.ndarray, length: int) -> np.ndarray:
    """The intervals of the windows at these places, split should one hold different bytes."""
    order = np.argsort(interval, kind="stable")
    first = first_of(interval[order])
    n = np.diff(np.r_[first, len(order)])
    mine = np.flatnonzero(np.repeat(n > 1, n))  # only these share an interval
    a, b = at[order][mine], at[order[np.repeat(first, n)]][mine]
    if _same_bytes(data, a, b, np.full(len(mine), length)).all():
        return interval
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(data[x:x + length].tobytes(), len(known)) for x in at.tolist()], interval.dtype)


def _merge(length: int):
    rounds = length // SYMBOL

    def repeated(data: np.ndarray, start: np.ndarray, size: np.ndarray, least: np.ndarray,
                 shard: np.ndarray) -> np.ndarray:
        """(string, window) -> least id of the interval that the window is in."""
        # every place of a string, its end included, is a suffix
        own = np.repeat(np.arange(len(size), dtype=np.int32), size + 1)
        place = (np.arange(len(own)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)).astype(np.int32)
        left = (size[own] - place).astype(np.int32)
        at = start[own] + place
        width = 63 - max(1, len(own).bit_length())
        block = (rolling(BYTE_VALUES[data], SYMBOL) >> np.uint64(64 - width)).astype(np.int64) | 1
        block = np.r_[block, np.zeros(length + SYMBOL, np.int64)]
        symbols = [np.where(left >= (k + 1) * SYMBOL, block[np.minimum(at + k * SYMBOL, len(block) - 1)], 0)
                   for k in range(rounds)]
        before = np.where(place >= SYMBOL, block[at - SYMBOL], 0)
        order, transform = shard_transform(symbols, before, shard[own])
        del symbols, before, at, block
        _, interval = interleave(transform, np.bincount(shard[own]), rounds)
        whole = left[order] >= length  # suffixes that hold a window
        interval, own, place = interval[whole], own[order][whole], place[order][whole]
        interval = _exact(data, start[own] + place, interval, length)
        low = np.full(int(interval.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, interval, least[own])
        out = np.full((len(size), RUN), np.iinfo(np.int64).max)
        out[own, place] = low[interval]
        return out

    def run(table: pa.Table) -> list[bytes]:
        """In a bucket: for each window of each string, whether a smaller id has it."""
        lengths = [np.frombuffer(x.as_py(), np.uint8) for x in table.column("keys")]
        data = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column("digests")])
        least = np.concatenate([wide_ints(x.as_py()) for x in table.column("least")])
        shard = np.repeat(np.arange(len(lengths), dtype=np.int32), [len(x) for x in lengths])
        size = np.concatenate(lengths).astype(np.int64)
        start = np.cumsum(size) - size
        # a string that several shards sent stays in the first one
        first, same = _distinct(data, start, size)
        floor = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(floor, same, least)
        low = repeated(data, start[first], size[first], floor, np.unique(shard[first], return_inverse=True)[1].astype(np.int32))
        masks = np.packbits(low[same] < least[:, None], axis=1, bitorder="little")
        ends = np.cumsum([0, *map(len, lengths)])
        return [masks[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    return run


class _Windows:
    """The windows of a chunk's strings at hot anchors, the distinct ones in
    sending order; ``at`` are their places, ``of`` the distinct window of each."""

    def __init__(self, s: _Strings, state: np.ndarray, length: int, buckets: int):
        hot = np.flatnonzero(state[s.of] == _HOT)
        n = s.n[hot]
        at = np.repeat(s.start[hot] - np.cumsum(n) + n, n) + np.arange(n.sum())
        doc = np.repeat(s.doc[hot], n) if len(hot) else at
        hashes = span_hashes(s.data, at, at + length) if len(at) else at.astype(np.uint64)
        others = _digests(s.hashes, at, np.full(len(at), length), s.anchor, length) if len(at) else hashes
        bucket = (mixed(hashes, 0x5851F42D4C957F2D) >> np.uint64(32)) % np.uint64(buckets * FINER)
        order = np.lexsort((others, hashes, bucket))
        self.at, self.doc, hashes, others, bucket = at[order], doc[order], hashes[order], others[order], bucket[order]
        first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (others[1:] != others[:-1])]) if len(at) else at
        self.of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(hashes)]))
        self.hashes, self.others = hashes[first], others[first]
        self.bucket = bucket[first].astype(np.int64)
        self.least = np.minimum.reduceat(self.doc, first) if len(first) else self.doc


def _least(table: pa.Table) -> list[bytes]:
    """In a bucket of windows: whether a smaller id has each."""
    hashes = [np.frombuffer(k.as_py(), "<u8") for k in table.column("keys")]
    ends = np.cumsum([0, *map(len, hashes)])
    least = np.concatenate([wide_ints(x.as_py()) for x in table.column("least")])
    joined = np.concatenate(hashes)
    others = np.concatenate([np.frombuffer(d.as_py(), "<u8") for d in table.column("digests")])
    order = np.lexsort((others, joined))
    start = np.flatnonzero(np.r_[True, np.diff(joined[order]) != 0] | np.r_[True, np.diff(others[order]) != 0])
    floor = np.zeros(len(order), np.int64)
    floor[order] = np.repeat(np.minimum.reduceat(least[order], start), np.diff(np.r_[start, len(order)]))
    return [bits(floor[a:b] < least[a:b]) for a, b in zip(ends, ends[1:])]


def _several(s: _Strings, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries to merge, in sending order, and the merge bucket of each."""
    several = np.flatnonzero(state == _SEVERAL)
    bucket = (s.keys[several] >> 32) * FINER + (s.keys[several] & 0xFFFFFFFF) % FINER
    order = np.argsort(bucket, kind="stable")
    return several[order], bucket[order]


class _Dedup:
    """The three passes over the chunks of a corpus."""

    def __init__(self, docs: DataFrame, length: int, anchor: int, most: int = MOST, **sizes):
        self.chunks = Chunks(docs, **sizes)
        buckets = self.chunks.buckets
        merge = _merge(length)

        def anchors(chunk: int, rows: pa.Table, _) -> pa.Table:
            return _sent(chunk, _anchors(_Strings(rows, length, anchor, buckets), buckets))

        def strings(chunk: int, rows: pa.Table, replies: pa.Table) -> pa.Table:
            s = _Strings(rows, length, anchor, buckets)
            state = _states(s, buckets, answers(replies))
            several, part = _several(s, state)
            raw, out = s.data.tobytes(), []
            for b, p in by_bucket(part):
                mine = several[p]
                begin, size = s.start[s.rep[mine]], s.n[s.rep[mine]] + length - 1
                text = b"".join(raw[x:x + n] for x, n in zip(begin.tolist(), size.tolist()))
                out.append((b, size.astype(np.uint8).tobytes(), text, narrow_bytes(s.least[mine]), b""))
            w = _Windows(s, state, length, buckets)
            out += [(buckets * FINER + b, w.hashes[p].astype("<u8").tobytes(), w.others[p].astype("<u8").tobytes(), narrow_bytes(w.least[p]), b"")
                    for b, p in by_bucket(w.bucket)]
            return _sent(chunk, out)

        def decide(table: pa.Table) -> list[bytes]:
            return (merge if table.column("bucket")[0].as_py() < buckets * FINER else _least)(table)

        self.states = written(answered(self.chunks.run(anchors, _SENT), _compare(most)), "bwt-states")
        self.masks = written(answered(self.chunks.run(strings, _SENT, self.states), decide), "bwt-masks")
        self.replies = self.states.withColumn("kind", F.lit(0)).unionByName(self.masks.withColumn("kind", F.lit(1)))


def _removed(rows: pa.Table, replies: pa.Table, length: int, anchor: int, buckets: int) -> tuple[_Strings, np.ndarray]:
    """The strings of a chunk and which of its bytes go."""
    s = _Strings(rows, length, anchor, buckets)
    cover = np.zeros(len(s.data) + 1, np.int64)
    if len(s.keys):
        state = _states(s, buckets, answers(replies, 0))
        full = (state[s.of] == _COPY) | (s.doc > s.least[s.of])
        np.add.at(cover, s.start[full], 1)
        np.add.at(cover, s.start[full] + s.n[full] + length - 1, -1)
        several, part = _several(s, state)
        masks = answers(replies, 1)
        found = np.zeros((len(s.keys), RUN), bool)
        for b, p in by_bucket(part):
            found[several[p]] = np.unpackbits(np.frombuffer(masks[b], np.uint8).reshape(-1, RUN // 8), axis=1,
                                              bitorder="little").astype(bool)
        partly = np.flatnonzero(~full & (state[s.of] == _SEVERAL))
        string, window = np.nonzero(found[s.of[partly]])
        at = s.start[partly[string]] + window
        w = _Windows(s, state, length, buckets)
        smaller = np.zeros(len(w.hashes), bool)
        for b, p in by_bucket(w.bucket):
            smaller[p] = flags(masks[buckets * FINER + b], p.stop - p.start)
        at = np.r_[at, w.at[smaller[w.of] | (w.doc > w.least[w.of])]]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
    return s, np.cumsum(cover[:-1]) > 0


def dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, **sizes) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` is the bytes left.
    ``sizes``: chunk_bytes, bucket_bytes (see ``chunks``), most."""
    if length % SYMBOL or anchor >= length:
        raise ValueError(f"length must be a multiple of {SYMBOL} and larger than the anchor")
    work = _Dedup(docs.select("doc_id", "text"), length, anchor, **sizes)
    buckets = work.chunks.buckets

    def finish(chunk: int, rows: pa.Table, replies: pa.Table) -> pa.Table:
        s, gone = _removed(rows, replies, length, anchor, buckets)
        total = np.r_[0, np.cumsum(gone)]
        begins = gone & ~np.r_[False, gone[:-1]]
        begins[s.bounds[:-1][s.bounds[:-1] < len(gone)]] |= gone[s.bounds[:-1][s.bounds[:-1] < len(gone)]]
        spans = np.r_[0, np.cumsum(begins)]
        kept = [s.data[a:b][~gone[a:b]].tobytes() for a, b in zip(s.bounds, s.bounds[1:])]
        return pa.table({"doc_id": rows.column("doc_id"), "n_bytes": pa.array(np.diff(s.bounds), pa.int64()),
                         "n_removed": pa.array(np.diff(total[s.bounds]), pa.int64()),
                         "n_spans": pa.array(np.diff(spans[s.bounds]), pa.int64()), "kept": pa.array(kept, pa.binary())})

    return work.chunks.run(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", work.replies)


def deduplicated(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, **sizes) -> DataFrame:
    """``docs`` with the repeats gone from ``text`` and ``n_chars`` (if there is
    such a column) counted again.  A character that loses a byte goes with it."""
    work = _Dedup(docs, length, anchor, **sizes)
    buckets = work.chunks.buckets

    def finish(chunk: int, rows: pa.Table, replies: pa.Table) -> pa.Table:
        s, gone = _removed(rows, replies, length, anchor, buckets)
        column = rows.schema.get_field_index("text")
        null = rows.column(column).is_null().to_numpy()
        text = [None if null[k] else s.data[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore")
                for k, (a, b) in enumerate(zip(s.bounds, s.bounds[1:]))]
        rows = rows.set_column(column, rows.schema.field(column), pa.array(text, rows.schema.field(column).type))
        if "n_chars" in rows.schema.names:
            k = rows.schema.get_field_index("n_chars")
            counted = pa.array([None if t is None else len(t) for t in text], pa.int64())
            rows = rows.set_column(k, rows.schema.field(k), counted.cast(rows.schema.field(k).type))
        return rows

    return work.chunks.run(finish, docs.schema, work.replies)
