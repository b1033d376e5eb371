"""Fingerprints, packing, mixing, rules, classifier: brute force, round trips, edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseload.llm import fingerprint, mixing, packing, queries, rules, subword
from caseload.llm.common import read_table

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(30000))
#: nulls, empty and very long texts, ties, repeated rows, several sources
ROWS = [(5, "a b c d e f g h i j k l", "en", "b", 23), (1, None, None, None, None), (2, "", "en", "a", 0),
        (3, LONG, "en", "a", len(LONG)), (5, "a b c d e f g h i j k l", "en", "b", 23), (9, "éß 漢字 \n\n x", "de", None, 9),
        (7, "same text here", "en", "c", 14), (8, "same text here", "en", "c", 14), (None, "no id at all", "en", "b", 12)]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names the operators use themselves
    return spark.createDataFrame(ROWS, DOC).selectExpr("*", "1 AS size", "'x' AS chunk", "2 AS kept", "3 AS n_words",
                                                       "4 AS `row`", "5 AS copies")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


# ------------------------------------------------------------ fingerprints

def test_digest_bounds_and_order():
    a = fingerprint.digest("the quick brown fox jumps over the lazy dog " * 20)
    b = fingerprint.digest("the quick brown fox jumps over the lazy cat " * 20)
    c = fingerprint.digest("0123456789 zzzz qqqq 9876543210 " * 20)
    assert fingerprint.likeness(a, a) == 1.0
    assert fingerprint.likeness(a, b) > fingerprint.likeness(a, c) >= 0.0
    assert fingerprint.difference(a, c) <= fingerprint.bound()
    assert fingerprint.digest("") == fingerprint.digest("") and len(fingerprint.digest("ab")) == len(a)


def test_bucket_counts_count_every_triplet():
    text = b"abcdefghij"
    want = sum(max(0, len(text) - c) for _, _, c in fingerprint.TRIPLETS)
    assert fingerprint.bucket_counts(np.frombuffer(text, np.uint8)).sum() == want


def brute_next(rows):
    known = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for k, r in enumerate(known):
        own, after = r[1] or "", known[(k + 1) % len(known)][1] or ""
        cut = len(own) // 4
        edited = own[:len(own) - cut] + after[:cut]
        out.append((r[0], len(own), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.digest(own),
                    fingerprint.likeness(fingerprint.digest(own), fingerprint.digest(after))))
    return sorted(out, key=str)


@pytest.mark.parametrize("range_bytes", [1 << 20, 64])
def test_next_document(docs, range_bytes, monkeypatch):
    monkeypatch.setattr(fingerprint.with_next, "__defaults__", (range_bytes,))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_next) for r in fingerprint.compared(docs).collect()]
    assert sorted(got, key=str) == brute_next(ROWS)


def test_next_document_on_a_table(spark, monkeypatch):
    monkeypatch.setattr(fingerprint.with_next, "__defaults__", (1 << 14,))
    table = read_table(spark, SF, "documents")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_next) for r in fingerprint.compared(table).collect()]
    assert sorted(got, key=str) == brute_next(rows)


def test_fingerprints_alone(docs, none):
    assert {r.fingerprint for r in fingerprint.fingerprints(docs).where("doc_id in (7, 8)").collect()} == {
        fingerprint.digest("same text here")}
    assert fingerprint.compared(none).count() == 0


# ------------------------------------------------------------ packing

def brute_pieces(rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [0]
        ends = list(range(len(ids), 0, -2048))[::-1]
        start = 0
        for k, end in enumerate(ends):
            out.append((r[0], k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start = end
    return sorted(out, key=str)


def check_places(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by)


def test_pieces_and_places(docs):
    rows = packing.packed(docs, **queries.tokenizer_paths()).collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == brute_pieces(ROWS)
    check_places(rows)


def test_special_token_text(spark):
    row = [(1, "a <|endoftext|> b", "en", "s", 17)]
    rows = packing.packed(spark.createDataFrame(row, DOC), **queries.tokenizer_paths()).collect()
    assert [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows] == brute_pieces(row)


@pytest.mark.parametrize("blank", [" ", "\n", "\u00a0", " \n\t"])
def test_very_long_white_space(spark, blank):
    run = blank * (2_000_000 // len(blank))
    rows = [(1, run, "en", "s", 0), (2, f"a{run}b", "en", "s", 0), (3, f"a {run}", "en", "s", 0)]
    got = packing.pieces(spark.createDataFrame(rows, DOC), **queries.tokenizer_paths()).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_pieces(rows)


def test_exchanges_reach_sequences_of_many_short_pieces():
    # best fit leaves gaps here that only short pieces from sequences of very many pieces close
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.concatenate([rng.integers(1, 60, 400), rng.integers(900, 1100, 40)])
        sequence, offset, n = packing.place(lengths, 2048)
        fill = np.bincount(sequence, lengths, n)
        assert fill.max() <= 2048 and n == math.ceil(lengths.sum() / 2048)
        for k in range(n):
            own = np.argsort(offset[sequence == k])
            assert (np.cumsum(lengths[sequence == k][own])[:-1] == np.sort(offset[sequence == k])[1:]).all()


def test_two_for_one_from_a_sequence_of_more_than_sixteen_pieces():
    bins = packing._Bins(np.array([], int), 100)
    bins.lengths = [60, 30, *[7] * 10, *[3] * 9]
    bins.bins, bins.fill = [[0, 1], list(range(2, 21))], [90, 97]
    bins.size = 100
    bins.search()
    # 10 = 7 + 3 comes over; then both hold what they can
    assert bins.fill[0] == 100 and sum(bins.fill) == 187 and sum(map(len, bins.bins)) == 21


def test_packing_query_is_tight(spark):
    rows = queries.op2_best_fit_packing(spark, SF).collect()
    table = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == brute_pieces(table)
    assert check_places(rows) <= math.ceil(sum(r.length for r in rows) / 2048) + 1


def test_sequences_hold_the_ids(docs):
    from pyspark.sql.functions import size
    ids = packing.pieces(docs, **queries.tokenizer_paths(), with_ids=True)
    want = Counter(x for r in ids.collect() for x in r.ids)
    got = packing.sequences(docs, **queries.tokenizer_paths())
    assert Counter(x for r in got.collect() for x in r.ids) == want
    assert got.where(size("ids") > 2048).count() == 0


def test_local_search_empties_sequences():
    """From a poor start, moves and swaps reach the packing that fills whole sequences."""
    lengths = np.array([60, 60, 40, 40, 50, 50, 30, 70] * 5)
    bins = packing._Bins(np.zeros(0, int), 100)
    bins.lengths = lengths.tolist()
    bins.bins = [[k] for k in range(len(lengths))]
    bins.fill = lengths.tolist()
    bins.search()
    assert sorted(x for b in bins.bins for x in b) == list(range(len(lengths)))
    assert all(f == sum(bins.lengths[x] for x in b) <= 100 for f, b in zip(bins.fill, bins.bins))
    assert sum(f > 0 for f in bins.fill) == math.ceil(lengths.sum() / 100)
    # two-for-one: 35 + 25 change places with 50
    bins.lengths, bins.bins, bins.fill = [50, 40, 35, 25, 30], [[0, 1], [2, 3, 4]], [90, 90]
    bins.search()
    assert sorted(bins.fill) == [80, 100]


def test_packing_nothing(none):
    assert packing.packed(none, **queries.tokenizer_paths()).count() == 0


# ------------------------------------------------------------ mixing

def brute_targets(sizes, share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_and_copies(spark):
    got = queries.op3_source_mixing(spark, SF).collect()
    table = read_table(spark, SF, "documents").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in table}
    source = {r.doc_id: r.source for r in table}
    sizes = Counter()
    for d, n in size.items():
        sizes[source[d]] += n
    target = brute_targets(sizes)
    mixed = Counter()
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken <= 2 * r["size"]
        rate = r.target / r.source_size
        if r["size"]:
            assert r.taken // r["size"] in (math.floor(rate), math.floor(rate) + 1)
        mixed[source[r.doc_id]] += r.taken
    assert sum(abs(mixed[s] - target[s]) for s in sizes) < 0.1 * sum(target.values())
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op3_source_mixing(spark, SF).collect()))


def test_mix_of_edge_cases(docs, none):
    rows = mixing.taken(docs).collect()
    assert len(rows) == len(ROWS)
    want = brute_targets({"a": 30000, "b": 28, "c": 6, None: 3})
    assert {r.source_size: r.target for r in rows} == pytest.approx({30000: want["a"], 28: want["b"], 6: want["c"], 3: want[None]})
    twice = [r.taken for r in rows if r.doc_id == 5]
    assert twice[0] == twice[1]  # repeated rows draw alike
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    taken = Counter()
    for r in rows:
        taken[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +taken
    assert mixing.taken(none).count() == 0 and mixing.mix(none).count() == 0


def test_mix_without_words(spark):
    rows = mixing.taken(spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", "b", 0)], DOC)).collect()
    assert [(r.target, r.taken) for r in rows] == [(0.0, 0), (0.0, 0)]


# ------------------------------------------------------------ rules

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = set()
    for k in range(len(words) - 4):
        if windows[tuple(words[k:k + 5])] > 1:
            covered |= set(range(k, k + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark, docs):
    texts = [r.text for r in read_table(spark, SF, "documents").collect()] + [r[1] or "" for r in ROWS] + [
        "a a a a a a", "a b c d e a b c d e", "x\n \nx\ny\nx", " ".join(f"{i % 7000} {i % 7000}" for i in range(9000))]
    for t in texts:
        assert rules.counts(t)[:5] == brute_counts(t)


def test_rules_query(spark):
    got = {r.doc_id: r for r in queries.op4_quality_rules(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    for r in read_table(spark, SF, "documents").collect():
        g, want = got[r.doc_id], brute_counts(r.text or "")
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (g.base_failed and g.kept)
    fine = [d for d in labels if not got[d].base_failed]
    assert np.mean([got[d].kept == (labels[d] == 1) for d in fine]) > 0.95


def test_learned_list_is_found_again():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    bad = (x[:, 0] > 0.8) & (x[:, 1] < 0.5) | (x[:, 2] > 0.95)
    found = rules.learn(["a", "b", "c"], x, bad, np.arange(4000) % 3 != 0)
    verdict = np.zeros(4000, bool)
    for rule in found:
        verdict |= rules._covers(rule, ["a", "b", "c"], x)
    assert (verdict == bad).mean() > 0.98
    assert rules.learn(["a", "b", "c"], x, np.zeros(4000, bool), np.arange(4000) % 3 != 0) == []


def test_rules_edge_cases(spark, docs, none):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    kept = rules.keep_good(docs, no_labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 5]  # the others have too few words
    assert rules.keep_good(none, no_labels).count() == 0
    odd = spark.createDataFrame([(5, None), (5, 1), (None, 0)], "doc_id long, quality int")
    assert rules.keep_good(docs, odd).count() == 3


# ------------------------------------------------------------ classifier

def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op5_subword_quality(spark, sf).collect()}
    table = read_table(spark, sf, "documents")
    assert len(rows) == table.count()
    labels = read_table(spark, sf, "labels").collect()
    out = [(rows[r.doc_id].predicted, r.quality) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(rows[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in labels)
    assert np.mean([p == q for p, q in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_score_is_the_softmax_of_the_average():
    texts = [b"good words here", b"### bad *** words ###", b"good text", b"$$$ bad"]
    model = subword.train(texts, np.array([1, 0, 1, 0]), rows_log2=10, epochs=20)
    weights, bias = model.weights()
    for t in texts:
        row, _ = subword.features([t], 10)
        hidden = model.table[row].mean(axis=0)
        logits = hidden @ model.layer + model.bias
        p = np.exp(logits - logits.max())
        assert 1 / (1 + np.exp(-(weights[row].mean() + bias))) == pytest.approx(p[1] / p.sum(), abs=1e-4)


def test_features_of_a_text_do_not_hang_on_its_neighbours():
    texts = [b"one two two", b"", b"three one two three one two three", b"x"]
    row, own = subword.features(texts)
    for k, t in enumerate(texts):
        assert Counter(row[own == k].tolist()) == Counter(subword.features([t])[0].tolist())


def test_a_huge_text_first_in_the_sample_does_not_end_it(spark, monkeypatch):
    monkeypatch.setattr(subword, "SAMPLE_BYTES", 1 << 16)
    monkeypatch.setattr(subword, "LARGEST", (1 << 16) // 64)
    rows = [(i, f"good words here {i}" if i % 2 else f"### bad *** {i}", i % 2) for i in range(100)]
    known = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    # by the order of the sample the first of all that are not held out
    first = known.where(~subword.held_out()).orderBy(F.xxhash64("doc_id").bitwiseAND(F.lit(0xFFFFFFFF))).first().doc_id
    docs = known.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("very long "), 20000)).otherwise(F.col("text")))
    got = subword.classified(docs.select("doc_id", "text"), known.select("doc_id", "quality")).collect()
    assert len({r.score for r in got}) > 2 and all(r.predicted == r.doc_id % 2 for r in got if r.doc_id != first)


def test_classifier_edge_cases(spark, docs, none):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = subword.classified(docs, no_labels).collect()
    assert len(rows) == len(ROWS) and {r.score for r in rows} == {0.5}
    assert subword.classified(none, no_labels).count() == 0
    assert docs.select(F.col("doc_id")).count() == len(ROWS)
