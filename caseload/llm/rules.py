"""Quality rules: a learned decision list.

Statistics of every whole text come from one pass over the documents.  From a
bounded sample of labelled statistics (``SAMPLE`` rows, chosen by a hash of
the id) sequential covering grows rules -- conjunctions of thresholds on
ratios of the statistics -- on two thirds of the sample, prunes them on the
rest and removes what they cover, until no rule is precise enough.  The list
is emitted as one ordered Spark conditional expression, so verdicts on the
corpus are plain column arithmetic.

Edge cases: a null text has no words; texts with few words fail the base rule
before the list is asked; repeated rows are judged alike; with no labelled
rows (or no bad ones) the list is empty and keeps everything; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import smallest_hashes, whole_text, written

#: Labelled rows that the list is learned from, at most.
SAMPLE = 20000
#: A rule must be right on so much of what it covers, in either part of the sample.
PRECISION = 0.97
#: ... and cover so many bad rows of the growing part.
SUPPORT = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_marks", "n_distinct_words", "max_word")
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?'\"-")] = True


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that the text has twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    width = int(ids.max()) + 1
    if width ** window < 1 << 62:
        keys = ids[:n].astype(np.int64)
        for k in range(1, window):
            keys = keys * width + ids[k:n + k]
    else:  # rank the prefixes so that a key stays exact in 64 bits
        keys = ids[:n].astype(np.int64)
        for k in range(1, window):
            keys = np.unique(keys, return_inverse=True)[1] * width + ids[k:n + k]
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids) + 1, np.int32)
    covered[:n] += twice
    covered[window:window + n] -= twice
    return int((np.cumsum(covered) > 0).sum())


def counts(text: str) -> tuple[int, ...]:
    """The COUNTS of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    data = np.frombuffer(raw, np.uint8)
    chars = int(((data & 0xC0) != 0x80).sum())
    blanks = int(((data == 32) | ((data >= 9) & (data <= 13))).sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), chars - blanks, int(_SYMBOLS[data].sum()), len(lines) - len(set(lines)), repeated_words(ids),
            len(lines), int(((data >= 65) & (data <= 90)).sum()), int(((data >= 48) & (data <= 57)).sum()),
            int(_MARKS[data].sum()), len(seen), max(map(len, seen), default=0))


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every document and the COUNTS of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.array([counts(t.as_py()) for t in batch.column(len(keep))], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], *[pa.array(table[:, k]) for k in range(len(COUNTS))]],
                [*keep, *COUNTS])

    fields = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    for c in COUNTS:
        fields = fields.add(c, "long")
    return docs.select(*[F.col(f"`{c}`") for c in keep], whole_text().alias("__text")).mapInArrow(run, fields)


def features() -> dict[str, Column]:
    """Ratios that the rules compare with thresholds; 0 for a text without words."""
    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "chars_per_word": per("word_chars", "n_words"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "upper_share": per("n_upper", "word_chars"),
        "digit_share": per("n_digits", "word_chars"),
        "mark_share": per("n_marks", "n_words"),
        "distinct_share": per("n_distinct_words", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
        "max_word": F.col("max_word").cast("double"),
    }


@dataclass(frozen=True)
class Test:
    """``feature`` at least (or at most) ``threshold``."""
    feature: str
    at_least: bool
    threshold: float

    def on(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.at_least else values <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.at_least else value <= self.threshold


Rule = tuple[Test, ...]


def _covers(rule: Rule, names: list[str], x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for t in rule:
        hit &= t.on(x[:, names.index(t.feature)])
    return hit


def _best_test(names: list[str], x: np.ndarray, bad: np.ndarray) -> tuple[float, Test] | None:
    """The test with the largest information gain for the bad rows (FOIL)."""
    p, n = bad.sum(), len(bad)
    base = np.log2(p / n)
    best = None
    for k, name in enumerate(names):
        order = np.argsort(x[:, k], kind="stable")
        v, b = x[order, k], bad[order]
        ends = np.flatnonzero(np.r_[v[1:] != v[:-1], True])  # last row of each value
        pos_to, all_to = np.cumsum(b)[ends], ends + 1
        for at_least in (True, False):
            if at_least:  # rows after an end
                pos, every = p - pos_to[:-1], n - all_to[:-1]
            else:
                pos, every = pos_to[:-1], all_to[:-1]
            ok = pos > 0
            if not ok.any():
                continue
            gain = np.full(len(pos), -np.inf)
            gain[ok] = pos[ok] * (np.log2(pos[ok] / every[ok]) - base)
            g = int(np.argmax(gain))
            if best is None or gain[g] > best[0] + 1e-12:
                middle = float((v[ends[g]] + v[ends[g] + 1]) / 2)
                best = (float(gain[g]), Test(name, at_least, middle))
    return best if best and best[0] > 1e-9 else None


def _worth(rule: Rule, names, x, bad) -> float:
    """(right - wrong) / covered on held-back rows; -1 if it covers none."""
    hit = _covers(rule, names, x)
    return (2 * bad[hit].sum() - hit.sum()) / hit.sum() if hit.any() else -1.0


def learn(names: list[str], x: np.ndarray, bad: np.ndarray, grow: np.ndarray,
          precision: float = PRECISION, support: int = SUPPORT) -> list[Rule]:
    """Rules for the bad rows in the order found.  ``grow`` marks the rows that
    rules are grown on; the others prune them."""
    left = np.ones(len(x), bool)
    found: list[Rule] = []
    while True:
        g, h = left & grow, left & ~grow
        if bad[g].sum() < support:
            return found
        rule: Rule = ()
        now = g.copy()
        while bad[now].sum() < now.sum() and len(rule) < len(names):
            step = _best_test(names, x[now], bad[now])
            if step is None:
                break
            rule += (step[1],)
            now &= step[1].on(x[:, names.index(step[1].feature)])
        if not rule:
            return found
        best = max(range(len(rule), 0, -1), key=lambda k: _worth(rule[:k], names, x[h], bad[h]))
        if _worth(rule[:best], names, x[h], bad[h]) >= _worth(rule, names, x[h], bad[h]):
            rule = rule[:best]
        for part in (g, h):
            hit = _covers(rule, names, x) & part
            if (part is g and bad[hit].sum() < support) or bad[hit].sum() < precision * hit.sum():
                return found
        found.append(rule)
        left &= ~_covers(rule, names, x)


def sample(stats: DataFrame, labels: DataFrame, size: int = SAMPLE):
    """(names, x, bad, grow) from at most ``size`` labelled rows, smallest hash of the id first."""
    columns = features()
    labelled = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = smallest_hashes(stats.join(labelled, "doc_id").select(
        F.crc32(F.col("doc_id").cast("string")).alias("h"), "doc_id", "quality",
        *[c.alias(k) for k, c in columns.items()]), size).toPandas()
    names = list(columns)
    return (names, rows[names].to_numpy(float).reshape(-1, len(names)), (rows["quality"] == 0).to_numpy(),
            (rows["h"] % 3 != 0).to_numpy())


def rejected(rules: list[Rule]) -> Column:
    """The decision list: the first rule that applies decides, else the row stays."""
    out = F.lit(False)
    for rule in reversed(rules):
        test = F.lit(True)
        for t in rule:
            test = test & t.column()
        out = F.when(test, F.lit(True)).otherwise(out)
    return out


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judged(stats: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``stats`` (a written table) with base_failed and kept.  Rows that the
    base rule rejects are not learned from: the list is asked about the rest."""
    rules = learn(*sample(stats.where(~base_failed()), labels, size))
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~(F.col("base_failed") | rejected(rules)))


def keep_good(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The documents that the rules keep, columns as they were."""
    names = docs.columns
    stats = statistics(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "text"),
                       ("doc_id", "row"))
    stats = written(stats, "rules-statistics")
    return judged(stats, labels, size).where("kept").select(*[F.col("row")[c].alias(c) for c in names])
