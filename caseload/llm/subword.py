"""Quality classifier: supervised subword embeddings.

Every word and every character n-gram of a word (its edges marked) is hashed
to a row of a table of learned vectors; a document is the average of its rows
and a softmax layer tells its label.  Table and layer are trained together by
stochastic gradient descent in numpy on a bounded sample: at most ``SAMPLE``
labelled documents of ``SAMPLE_BYTES`` together, whole texts, chosen by a hash
of the id; a text above ``LARGEST`` bytes is not learned from, only scored.

The output layer is linear, so a document's logit is the average of one number
per table row: scoring the corpus needs those numbers only (a table of fixed
size), in one pass without a shuffle.

Edge cases: a null or empty text has no features and gets the score of the
bias alone; a text of any length is scored whole; without labels every score
is 0.5; rows that repeat an id are learned from once each; repeated rows score
alike; other columns, whatever their names, are not read; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseload.llm.chunks import BYTE_VALUES, rolling, word_hashes
from caseload.llm.common import smallest_hashes, whole_text

#: Labelled documents that the model is trained on, at most, and bytes of their texts.
SAMPLE = 6000
SAMPLE_BYTES = 128 << 20
#: Bytes of the largest text that is learned from; so the sample has 64 texts at least, if there are as many.
LARGEST = SAMPLE_BYTES // 64
ROWS_LOG2 = 18
DIM = 16
GRAMS = (3, 4, 5)
#: Words of a run whose return counts as repetition.
REPEAT = 5
EPOCHS = 5
RATE = 0.1
FOLDS = 5
THRESHOLD = 0.3
_PART = 1 << 20
_REPEATED = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def features(texts: list[bytes], rows_log2: int = ROWS_LOG2) -> tuple[np.ndarray, np.ndarray]:
    """(table row, text) of every word and n-gram occurrence of the texts.

    A word of two kinds stands for repetition, whatever is repeated: one for
    every word equal to the word before it, one for every run of ``REPEAT``
    words that the text had before.
    """
    shift = np.uint64(64 - rows_log2)
    hashes, first = word_hashes(texts)
    word_own = np.repeat(np.arange(len(texts)), np.diff(first))
    rows, own = [(hashes >> shift).astype(np.uint32)], [word_own]
    for k, again in enumerate((_equal_to_last(hashes, word_own), _had_before(hashes, word_own))):
        rows.append(np.full(len(again), (_REPEATED[k] >> shift), np.uint32))
        own.append(word_own[again])
    data = np.frombuffer(b" " + b" ".join([*texts, b""]), np.uint8)
    space = _SPACE[data]
    data = np.where(space, np.uint8(32), data)
    spaces = np.r_[0, np.cumsum(space)]
    text = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    for n in GRAMS:
        if len(data) < n:
            continue
        at = np.flatnonzero(spaces[n - 1:-1] - spaces[1:-n + 1] == 0)  # blanks at its ends only
        h = rolling(BYTE_VALUES[data], n)[at] + np.uint64(n)
        rows.append((h >> shift).astype(np.uint32))
        own.append(text[np.minimum(at, len(text) - 1)])
    return np.concatenate(rows), np.concatenate(own)


def _equal_to_last(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    return 1 + np.flatnonzero((hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1]))


def _had_before(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    if len(hashes) < REPEAT:
        return np.zeros(0, np.int64)
    runs = rolling(hashes, REPEAT) + own[:len(hashes) - REPEAT + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(runs, kind="stable")
    later = order[1:][runs[order][1:] == runs[order][:-1]]
    return later[own[later] == own[later + REPEAT - 1]]


def bags(texts: list[bytes], rows_log2: int = ROWS_LOG2) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct table rows and the share of its features that each has."""
    out = []
    for t in texts:
        row, n = np.unique(features([t], rows_log2)[0], return_counts=True)
        out.append((row, (n / max(n.sum(), 1)).astype(np.float32)))
    return out


@dataclass
class Model:
    table: np.ndarray  # rows x DIM
    layer: np.ndarray  # DIM x 2
    bias: np.ndarray  # 2

    def weights(self) -> tuple[np.ndarray, float]:
        """(logit of label 1 against 0 per table row, bias)."""
        return (self.table @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(texts: list[bytes], labels: np.ndarray, rows_log2: int = ROWS_LOG2, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 1) -> Model:
    """Stochastic gradient descent, a document a step, the rate falling to 0."""
    rng = np.random.Generator(np.random.PCG64(seed))
    model = Model(rng.uniform(-1 / dim, 1 / dim, (1 << rows_log2, dim)).astype(np.float32),
                  np.zeros((dim, 2), np.float32), np.zeros(2, np.float32))
    examples = bags(texts, rows_log2)
    steps, step = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            row, share = examples[k]
            now = rate * (1 - step / steps)
            step += 1
            hidden = share @ model.table[row] if len(row) else np.zeros(dim, np.float32)
            logits = hidden @ model.layer + model.bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = model.layer @ p
            model.layer -= now * np.outer(hidden, p)
            model.bias -= now * p
            if len(row):
                # the share of a feature is tiny: scaled by the number of rows, a step moves a document's average by the rate
                model.table[row] -= np.outer(share * (now * len(row)), back)
    return model


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled documents that are not held out.

    The ids are chosen on narrow rows; only their texts come to the driver.
    """
    known = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sizes = docs.groupBy("doc_id").agg(F.sum(F.octet_length(whole_text())).alias("bytes"))
    found = smallest_hashes(sizes.where(F.col("bytes") <= LARGEST).join(known, "doc_id").where(~held_out()).withColumn(
        "h", F.xxhash64("doc_id").bitwiseAND(F.lit(0xFFFFFFFF))), sample)
    # at most ``sample`` narrow rows
    chosen = found.withColumn("so_far", F.sum("bytes").over(Window.orderBy("h", "doc_id"))).where(
        F.col("so_far") <= SAMPLE_BYTES).drop("bytes", "so_far")
    rows = (docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
            .orderBy("h", "doc_id", "text").limit(sample).select("text", "quality").collect())
    return train([r["text"].encode() for r in rows], np.array([r["quality"] for r in rows], int))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""
    weights, bias = model.weights()
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        rows_log2 = len(table).bit_length() - 1
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1).cast(pa.binary())]
            start = 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= _PART):
                    size += len(texts[end])
                    end += 1
                row, own = features(texts[start:end], rows_log2)
                n = np.bincount(own, minlength=end - start)
                logit = np.bincount(own, table[row], minlength=end - start) / np.maximum(n, 1) + bias
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(1 / (1 + np.exp(-logit)))], ["doc_id", "score"])
                start = end

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def classified(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return scored(docs, fit(docs, labels, sample)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
