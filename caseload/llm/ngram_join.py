"""N-gram Jaccard join by MinHash banding.

1. One pass over the texts gives every document a digest of its word sequence
   and the hashes of its MinHash bands; band and row counts follow from the
   threshold and the target recall (``choose_bands``).  Copies (equal word
   sequences) are one node from here on, represented by the smallest id.
2. Band hashes are shuffled; each node is tied to the smallest node of its
   band bucket, a row per node and band, never a pair within a bucket.  The
   components of these ties are the candidate groups: whoever shares a band
   is in one group.
3. The full n-gram sets of the nodes in candidate groups meet in blocks: a
   group of more than ``BLOCK`` nodes is split by a hash, and each pair of its
   blocks is one task unit, so no task holds a whole large group.  All pairs in
   a block pair are verified on the full sets; what leaves is one row per
   node: its number of links and its smallest linked neighbour's group.
4. The components of the verified links are the classes.

Edge cases: a null text counts as empty; a text of fewer than ``n`` words has
one n-gram, all its words; texts without words are copies of one another;
texts of any length are compared by their whole sets; rows with equal ids are
one document; a class goes by its smallest id; rows with a null id have no
class and no links; other columns, whatever their names, are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.chunks import mixed, powers, rolling, word_hashes
from caseload.llm.common import whole_text, written
from caseload.llm.components import components

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Hashes per n-gram that the banding may use.
HASHES = 256
#: Nodes of a candidate group that one verification unit takes from each side.
BLOCK = 128
_PART = 1 << 20  # bytes of text handled at once
_COLUMNS = 4096


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, hence the fewest false candidates,
    such that pairs at the threshold share a band with probability ``recall``."""
    best = None
    for rows in range(1, hashes + 1):
        p = threshold ** rows
        bands = 1 if p >= recall else math.ceil(math.log(1 - recall) / math.log1p(-p))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("no band count within the given number of hashes reaches the recall")
    return best


def ngram_hashes(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, word bounds, n-gram hashes, n-gram bounds) of the texts."""
    words, first = word_hashes(texts)
    count = np.diff(first)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bounds = np.r_[0, np.cumsum(grams)]
    out = np.zeros(bounds[-1], np.uint64)
    if len(words) >= n:
        windows = rolling(words, n)
        own = np.repeat(np.arange(len(count)), grams)
        at = first[:-1][own] + np.arange(len(own)) - bounds[own]
        long = count[own] >= n
        out[long] = windows[at[long]]
    for k in np.flatnonzero((count > 0) & (count < n)):
        out[bounds[k]] = rolling(words[first[k]:first[k + 1]], int(count[k]))[0] ^ np.uint64(count[k])
    return words, first, out, bounds


def _parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= _PART:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _reduce(ufunc, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """reduceat over the non-empty spans; 0 for an empty one."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    full = np.diff(bounds) > 0
    if full.any():
        out[full] = ufunc.reduceat(values, bounds[:-1][full])
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, d1, d2, bands) of every document with an id: a 128-bit digest of
    its words and the hash of each band (none without words)."""
    rng = np.random.Generator(np.random.PCG64(7))
    multiply = (rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    add = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)

    def sign(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, first, grams, bounds = ngram_hashes(texts, n)
        place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
        power = powers(0x9E3779B97F4A7C15, int(place.max()) + 1 if len(place) else 0)
        digests = [_reduce(np.add, mixed(words, seed) * power[place], first) + np.diff(first).astype(np.uint64)
                   for seed in (1, 2)]
        short = (grams >> np.uint64(32)).astype(np.uint32)
        out = np.zeros((len(texts), bands), np.uint64)
        for b in range(bands):
            h = np.full(len(texts), b + 1, np.uint64)
            for r in range(b * rows, b * rows + rows):
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + _reduce(np.minimum, short * multiply[r] + add[r], bounds))
            out[:, b] = h
        return digests[0], digests[1], out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1).cast(pa.binary())]
            for start, end in _parts(texts):
                d1, d2, hashes = sign(texts[start:end])
                filled = np.array([bool(t.strip(b"\t\n\v\f\r ")) for t in texts[start:end]])
                offsets = np.r_[0, np.cumsum(filled * bands)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[filled].ravel().view(np.int64)))],
                    ["doc_id", "d1", "d2", "bands"])

    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        run, "doc_id long, d1 long, d2 long, bands array<long>")


def gram_sets(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` with the text replaced by ``grams``: its distinct n-gram hashes, ascending, as bytes."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text").cast(pa.binary())]
            for start, end in _parts(texts):
                _, _, grams, bounds = ngram_hashes(texts[start:end], n)
                sets = [np.unique(grams[a:b]).astype("<u8").tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(start, end - start) for c in keep], pa.array(sets, pa.binary())], [*keep, "grams"])

    return docs.select(*keep, "text").mapInArrow(
        run, ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text") + ", grams binary")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sets of distinct values."""
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    joined = np.concatenate(sets)
    order = np.argsort(joined, kind="stable")
    member, joined = member[order], joined[order]
    start = np.flatnonzero(np.r_[True, joined[1:] != joined[:-1]])
    n = np.diff(np.r_[start, len(joined)])
    shared = np.repeat(n > 1, n)  # a value of one set meets nothing
    member, column = member[shared], np.cumsum(np.r_[True, joined[shared][1:] != joined[shared][:-1]]) - 1
    out = np.zeros((len(sets), len(sets)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, (low, low + _COLUMNS))
        table = np.zeros((len(sets), _COLUMNS), np.float32)
        table[member[a:b], column[a:b] - low] = 1
        out += table @ table.T
    return out


def _verify(threshold: float):
    """Rows sorted by unit (grp, lo, hi) -> (node, links, root) of the nodes with a link in the unit."""
    def unit(key: tuple, rows: list[tuple]) -> list[tuple]:
        _, lo, hi = key
        node, block, copies = (np.array([r[k] for r in rows]) for k in range(3))
        sets = [np.frombuffer(r[3], "<u8") for r in rows]
        size = np.array([len(s) for s in sets], float)
        if not size.any():
            return []
        both = overlaps(sets)
        linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
        node, first, of = np.unique(node, return_index=True, return_inverse=True)
        if len(node) < len(rows):  # rows that repeat an id are one node
            order = np.argsort(of, kind="stable")
            start = np.searchsorted(of[order], np.arange(len(node)))
            linked = np.logical_or.reduceat(linked[order], start, axis=0)
            linked = np.logical_or.reduceat(linked[:, order], start, axis=1)
        else:
            linked = linked[first][:, first]
        block, copies = block[first], copies[first]
        np.fill_diagonal(linked, False)
        if lo != hi:
            linked &= block[:, None] != block[None, :]
        links = linked @ copies
        root = np.arange(len(node))
        while True:
            low = np.minimum(root, np.where(linked, root[None, :], len(node)).min(axis=1))
            low = low[low]
            if (low == root).all():
                break
            root = low
        return [(int(node[k]), int(links[k]), int(node[root[k]])) for k in np.flatnonzero(links)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def table(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])

        for batch in batches:
            out: list[tuple] = []
            for *at, node, block, copies, grams in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if tuple(at) != key:
                    if rows:
                        out += unit(key, rows)
                    key, rows = tuple(at), []
                rows.append((node, block, copies, grams))
            yield table(out)
        if rows:
            yield table(unit(key, rows))

    return run


def join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) of every document: the smallest id
    of its class, the number of other documents with a Jaccard similarity of at
    least ``threshold``, and how many of the documents have its very words."""
    bands, rows = choose_bands(threshold, recall)
    signed = written(signatures(docs, n, bands, rows), "join-signatures")
    once = signed.groupBy("d1", "d2", "doc_id").agg(F.first("bands").alias("bands"))  # rows that repeat an id
    nodes = written(once.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "join-nodes")

    keyed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = written(components(keyed.join(buckets.drop("n"), "key").where("node != low").select("node", "low"),
                                "node", "low").withColumnsRenamed({"root": "grp"}), "join-groups")

    sizes = groups.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = groups.join(sizes, "grp").join(nodes.select("node", "copies"), "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), whole_text().alias("text")).join(placed, "node")
    sets = gram_sets(texts.select("grp", "node", "block", "blocks", "copies", "text"), n)
    units = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "node", "block", "copies", "grams")
    verified = written(units.repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi").mapInArrow(
        _verify(threshold), "node long, links long, root long"), "join-verified")

    classes = components(verified, "node", "root").withColumnsRenamed({"root": "class_id"})
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    found = written(nodes.drop("bands").join(links, "node", "left").join(classes, "node", "left"), "join-classes")
    out = signed.select("doc_id", "d1", "d2").join(found, ["d1", "d2"]).select(
        "doc_id", F.coalesce("class_id", "node").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.col("copies").alias("n_copies"))
    unnamed = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long"),
                                                  F.lit(0).cast("long"), F.lit(1).cast("long"))
    return out.union(unnamed)


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of every class: the one with the smallest id.
    Rows that repeat both id and text are one document (of other columns, those
    of the least hash), an id with several texts keeps them all or, if one of
    them is a near copy of a smaller id, none; rows without an id all stay."""
    names = docs.columns
    gone = join(docs, **how).where("doc_id != class_id").select(F.col("doc_id").alias("__gone")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), F.sha2(whole_text(), 256).alias("__text"),
                       F.xxhash64(F.to_json(row)).alias("__hash"), row.alias("__row"))
    left = rows.where("__id is not null").join(gone, F.col("__id") == F.col("__gone"), "left_anti")
    one = left.groupBy("__id", "__text").agg(F.min_by("__row", "__hash").alias("__row"))
    return one.select("__row").unionByName(rows.where("__id is null").select("__row")).select(
        *[F.col("__row")[c].alias(c) for c in names])
