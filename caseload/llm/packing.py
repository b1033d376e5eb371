"""Best-fit packing by swap-based local search.

Documents are tokenized once into pieces of at most ``size`` tokens; only the
narrow piece rows (ids, lengths) are packed.  Pieces are dealt into blocks of
about ``BLOCK`` pieces by a hash, one block per task, so the work of a task
does not grow with the corpus and a block wastes less than one sequence.  In a
block, pieces are placed best-fit by falling length; local search then moves
pieces between underfull sequences -- one, one against one, two against one --
whenever that raises the sum of squared fills, until sequences run empty.

Edge cases: a null or empty text is one piece holding only the separator; a
text of any length is encoded whole and cut into pieces, a very long run of
white space by the slower of two equal encoders; repeated rows are packed as
documents of their own; of exchanges that gain the same, the first found is
made, in an order that hangs on the pieces alone, so reruns agree; other
columns, whatever their names, are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from caseload.llm.common import whole_text, written
from caseload.llm.tokens import encoder

SIZE = 2048
SEPARATOR = 0
BLOCK = 16384


def pieces(docs: DataFrame, vocabulary: str, ranks: str, size: int = SIZE, separator: int = SEPARATOR,
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document: its
    ids and the separator, cut into pieces of ``size``; a shorter piece is the first."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, batch.num_rows, 512):
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
                for doc_id, text in zip(batch.column(0).slice(at, 512).to_pylist(), texts.slice(at, 512).to_pylist()):
                    ids = np.array([*encode(text), separator], dtype="<u4")
                    first = len(ids) % size or size
                    ends = range(first, len(ids) + 1, size)
                    for k, end in enumerate(ends):
                        start = max(0, end - size) if k else 0
                        part = ids[start:end]
                        out["doc_id"].append(doc_id)
                        out["piece"].append(k)
                        out["start"].append(start)
                        out["length"].append(end - start)
                        out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            out["ids"].append(part)
                columns = [pa.array(out["doc_id"], batch.schema.field(0).type), pa.array(out["piece"], pa.int32()),
                           *[pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32")]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(cut, schema)


class _Bins:
    """Sequences being filled: their items (lengths by index) and fills."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.lengths, self.size = lengths.tolist(), size
        self.bins: list[list[int]] = []
        self.fill: list[int] = []
        self._best_fit()

    def _best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room."""
        room: list[tuple[int, int]] = []  # (gap, bin) in order, open sequences only
        for item in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            length = self.lengths[item]
            k = bisect_left(room, (length, -1))
            if k == len(room):
                b, gap = len(self.bins), self.size
                self.bins.append([])
                self.fill.append(0)
            else:
                gap, b = room.pop(k)
            self.bins[b].append(item)
            self.fill[b] += length
            if gap > length:
                insort(room, (gap - length, b))

    def search(self) -> None:
        """Local search between underfull sequences until no exchange raises
        the sum of squared fills.  Fuller sequences are topped up first, from
        emptier ones, so that the emptiest run empty."""
        improved = True
        while improved:
            improved = False
            order = sorted((b for b, f in enumerate(self.fill) if 0 < f < self.size), key=lambda b: -self.fill[b])
            at = {b: k for k, b in enumerate(order)}
            singles: dict[int, set] = {}
            doubles: dict[int, set] = {}
            for b in order:
                self._index(b, singles, doubles, add=True)
            lengths = sorted(singles)
            sums = sorted(doubles)
            for b in order:
                while 0 < self.fill[b] < self.size and self._top_up(b, at, singles, doubles, lengths, sums):
                    improved = True

    def _index(self, b: int, singles: dict, doubles: dict, add: bool) -> None:
        """Enter a sequence under every length, and every sum of two lengths,
        that it can give -- or take it out.  Pieces of one length are alike, so
        there are at most about ``size`` such sums, however many pieces it has."""
        if add and not 0 < self.fill[b] < self.size:
            return
        count = Counter(self.lengths[x] for x in self.bins[b])
        kinds = sorted(count)
        found = [(singles, a, (b, a)) for a in kinds]
        found += [(doubles, a + c, (b, a, c)) for i, a in enumerate(kinds) for c in kinds[i:] if a != c or count[a] > 1]
        for table, key, entry in found:
            if add:
                table.setdefault(key, set()).add(entry)
            elif key in table:
                table[key].discard(entry)

    def _top_up(self, b: int, at, singles, doubles, lengths, sums) -> bool:
        """The exchange that fills ``b`` most: an item or two come in, at most one goes out."""
        gap, best = self.size - self.fill[b], None
        for gone in [0, *sorted({self.lengths[x] for x in self.bins[b]})]:
            for keys, table in ((lengths, singles), (sums, doubles)):
                k = bisect_left(keys, gone + gap + 1) - 1
                while k >= 0 and keys[k] - gone > (best[0] if best else 0):
                    gain = keys[k] - gone
                    found = next((e for e in table.get(keys[k], ()) if e[0] != b and self.fill[b] + gain > self.fill[e[0]]),
                                 None)
                    if found:
                        best = (gain, gone, found)
                        break
                    k -= 1
            if best and best[0] == gap:
                break
        if best is None:
            return False
        gain, gone, (other, *come) = best
        self._index(b, singles, doubles, add=False)
        self._index(other, singles, doubles, add=False)
        leaves = self._taken(b, gone) if gone else None
        for length in come:
            self.bins[b].append(self._taken(other, length))
        if leaves is not None:
            self.bins[other].append(leaves)
        self.fill[b] += gain
        self.fill[other] -= gain
        for k in (b, other):
            known = len(singles), len(doubles)
            self._index(k, singles, doubles, add=True)
            if known != (len(singles), len(doubles)):
                lengths[:], sums[:] = sorted(singles), sorted(doubles)
        return True

    def _taken(self, b: int, length: int) -> int:
        """A piece of this length, taken out of the sequence."""
        x = next(x for x in self.bins[b] if self.lengths[x] == length)
        self.bins[b].remove(x)
        return x


def place(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each length and the number of sequences."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    whole = np.flatnonzero(lengths >= size)
    sequence[whole] = np.arange(len(whole))
    rest = np.flatnonzero(lengths < size)
    bins = _Bins(lengths[rest], size)
    bins.search()
    n = len(whole)
    for items in bins.bins:
        if items:
            here = 0
            for x in items:
                sequence[rest[x]], offset[rest[x]] = n, here
                here += bins.lengths[x]
            n += 1
    return sequence, offset, n


def pack(parts: DataFrame, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """``parts`` (with doc_id, piece, length, ...) and sequence_id, offset.

    ``parts`` should be a written table: it is counted, then dealt into blocks.
    """
    blocks = max(1, math.ceil(parts.count() / block))
    dealt = parts.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).cast("int"))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]).drop(["block"])
        sequence, offset, _ = place(rows.column("length").to_numpy(), size)
        return (rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + sequence))
                    .append_column("offset", pa.array(offset)))

    # by range, so that no two blocks of these few meet in one task
    return dealt.repartitionByRange(blocks, "block").groupBy("block").applyInArrow(run, StructType([
        *parts.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def packed(docs: DataFrame, vocabulary: str, ranks: str, size: int = SIZE) -> DataFrame:
    """One row per piece of every document with its place."""
    return pack(written(pieces(docs, vocabulary, ranks, size), "pack-pieces"), size)


def sequences(docs: DataFrame, vocabulary: str, ranks: str, size: int = SIZE) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids), at most ``size`` ids each."""
    places = pack(written(pieces(docs, vocabulary, ranks, size, with_ids=True), "pack-ids"), size)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return places.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
