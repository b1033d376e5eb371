"""Centroid clustering, token files, importance resampling: brute force, round trips, edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from caseload.llm import hilbert, importance, queries, token_files
from caseload.llm.common import read_table
from caseload.session import list_files

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


# ------------------------------------------------------------ centroid clustering

def brute_clusters(rows, k=40, rounds=5, limit=1 << 27):
    kept = [(i, [max(-limit, min(limit, math.floor(max(-1e300, min(1e300, 256 * x))))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        best = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, b) in zip(kept, best) if b == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    best = assign()
    per = Counter()
    for d, j in best:
        per[j] += d
    total = sum(per.values())

    def fit(x):
        return x if x < 1 << 63 else None

    return sorted(((i, j, d, fit(per[j]), fit(total),
                    hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, best)), key=str)


def clusters_of(df):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def vectors(seed, n):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(7)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (5, rows[6][1])]            # repeated ids and vectors, no id
    rows += [(1000 + i, [0.25] * 64) for i in range(n // 3)]                  # a third are equal: ties everywhere
    rows += [(2000, None), (2001, [0.1] * 63), (2002, [0.1] * 65), (2003, []), (2004, [None] + [0.1] * 63),
             (2005, [math.nan] + [0.1] * 63), (2006, [math.inf] + [0.1] * 63), (2007, [-math.inf] * 64)]
    return rows


CLASH = [f"{k} AS {c}" for k, c in enumerate(("v", "ids", "cluster", "key", "at", "distance", "low", "h"))]


@pytest.mark.parametrize("block", [4, 256])
def test_clusters_against_brute_force(spark, block):
    rows = vectors(1, 150)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", *CLASH)
    assert clusters_of(hilbert.clustered(df, block=block)) == brute_clusters(rows)


def test_few_vectors_and_none(spark):
    rows = vectors(2, 9)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clusters_of(hilbert.clustered(df)) == brute_clusters(rows)
    empty = hilbert.clustered(df.limit(0))
    assert empty.collect() == [] and empty.columns == hilbert.clustered(df).columns


def test_huge_components_keep_exact_distances(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((-1, 1)) * rng.uniform(0, 10 ** rng.choice((0, 4, 7, 300))) for _ in range(64)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clusters_of(hilbert.clustered(df, k=5, block=8)) == brute_clusters(rows, k=5)


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_steps_to_neighbours(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = [bytes(k) for k in hilbert.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_a_box_keeps_every_nearest_centroid():
    rng = np.random.default_rng(5)
    pruned = 0
    for _ in range(50):
        v = rng.integers(-40, 40, (20, 8)) + rng.integers(-100, 100, 8)
        c = rng.integers(-150, 150, (30, 8))
        near = hilbert.candidates(v.min(axis=0), v.max(axis=0), c)
        assert set(hilbert.nearest(v, c)[0]) <= set(near)
        pruned += 30 - len(near)
    assert pruned > 300


# ------------------------------------------------------------ token files

def brute_tokens(rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def tokens_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


#: nulls, empty and very long texts, long runs of white space, the special token, negative and large ids
TEXTS = [(7, "plain words here"), (2, None), (-4, ""), (1 << 40, "a <|endoftext|> b"), (None, "no id"),
         (11, " ".join(f"w{i}" for i in range(30000))), (12, "x" + " " * 1_100_000 + "y"), (13, "\n" * 1_100_000),
         (14, " " * 1_100_000), (15, "éß 漢字 😀 \n\n x"), (16, "z" * 200_000)]


@pytest.fixture(scope="module")
def token_rows(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr(
        "*", "1 AS null_id", "2 AS text_hash", "3 AS at", "4 AS file", "5 AS base", "6 AS n_ids")


@pytest.mark.parametrize("size", [None, 64])
def test_token_files_against_the_tokenizer(spark, tmp, token_rows, size):
    token_files.write(token_rows, tmp, **queries.tokenizer_paths(), bytes_per_range=size)
    assert tokens_of(token_files.read(spark, tmp)) == brute_tokens(TEXTS)


def test_repeated_rows_and_ids_fill_several_ranges(spark, tmp):
    rows = [(5, "same text")] * 300 + [(5, f"other {i % 7}") for i in range(100)] + [(i, f"text {i}") for i in range(200)]
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tmp,
                      **queries.tokenizer_paths(), bytes_per_range=500)
    got = tokens_of(token_files.read(spark, tmp))
    assert [r[0] for r in got] == sorted(r[0] for r in rows)
    assert [r[1] for r in got] == list(itertools.accumulate([0, *(r[2] for r in got)]))[:-1]
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter((r[0], r[2], r[3]) for r in brute_tokens(rows))
    assert len({f.rsplit(".", 1)[0] for f in list_files(spark, f"{tmp}/files")}) > 5


def test_windows_cross_files(spark, tmp):
    token_files.write(read_table(spark, SF, "documents"), tmp, **queries.tokenizer_paths(), bytes_per_range=40_000)
    rows = tokens_of(token_files.read(spark, tmp))
    reader = token_files.Reader(spark, tmp)
    assert len(reader.rows) > 3 and len(reader) == rows[-1][1] + rows[-1][2]
    whole = reader.window(0, len(reader))
    for _, start, n, crc in rows:
        assert whole[start + n - 1] == 2 and zlib.crc32(whole[start:start + n].tobytes()) == crc
    for start in range(0, len(reader), 9973):
        assert (reader.window(start, start + 4096) == whole[start:start + 4096]).all()


def test_files_of_lost_attempts_are_not_read(spark, tmp, token_rows):
    token_files.write(token_rows, tmp, **queries.tokenizer_paths())
    local = tmp.removeprefix("file:")
    with open(f"{local}/files/{'0' * 32}.bin", "wb") as f:
        f.write(b"left by a task that was lost")
    assert tokens_of(token_files.read(spark, tmp)) == brute_tokens(TEXTS)
    damaged = next(f for f in list_files(spark, f"{tmp}/files") if f.endswith(".bin") and "0" * 32 not in f)
    with open(damaged.removeprefix("file:"), "ab") as f:
        f.write(b"xx")
    with pytest.raises(Exception, match="is not of the length"):
        token_files.read(spark, tmp).collect()


def test_no_documents_no_files(spark, tmp, token_rows):
    token_files.write(token_rows.limit(0), tmp, **queries.tokenizer_paths())
    assert token_files.read(spark, tmp).collect() == [] and len(token_files.Reader(spark, tmp)) == 0


def test_range_sizes_follow_the_input():
    sizes = [token_files.range_bytes(1 << k) for k in range(20, 48)]
    assert sizes == sorted(sizes) and sizes[0] == token_files.LEAST and sizes[-1] == token_files.MOST


def test_token_files_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert tokens_of(queries.op12_token_files(spark, SF)) == brute_tokens(rows)


# ------------------------------------------------------------ importance resampling

def brute_features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(f.encode()) % 10000 for f in runs]


def brute_resampled(docs, target):
    found = [(i, *brute_features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in brute_features(x)[1])
    s_all, t_all = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for k, r in enumerate(fit[:5 * len(fit) // 100], 1):
        r[5] = k
    return sorted((tuple(r) for r in out), key=str)


def words(seed, n):
    rng = random.Random(seed)
    pool = ["the", "Of", "an", "É", "漢字", "x" * 70, "y" * 64, "z" * 63, "7", "a-b", "q_r", "tab\tbed", "\x00", "ÄB"]
    return rng.choice([" ", "\n", ", "]).join(rng.choice(pool) + str(rng.randrange(4)) * rng.randrange(2) for _ in range(n))


def test_resampling_against_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, words(i, rng.choice((0, 1, 2, 3, 19, 20, 21, 60)))) for i in range(400)]
    docs += [(1, docs[1][1]), (1, words(77, 30)), (None, words(5, 40)), (None, None), (900, ""), (901, " -- "), (902, words(6, 400_000))]
    target = [words(k, 50) for k in range(1000, 1010)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 AS rank", "2 AS score", "3 AS weight", "4 AS item", "5 AS n", "6 AS neg_score")
    other = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resampled(df, other)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_resampled(docs, target)
    want = {r[0] for r in brute_resampled(docs, target) if r[5]}
    assert {r["doc_id"] for r in importance.drawn(df, other).collect()} == want


def test_no_documents_and_no_target(spark):
    docs = spark.createDataFrame([(i, words(i, 30)) for i in range(40)], "doc_id long, text string")
    none = docs.limit(0)
    assert importance.resampled(none, docs).collect() == []
    got = sorted((tuple(r) for r in importance.resampled(docs, none).collect()), key=str)
    assert got == brute_resampled([(i, words(i, 30)) for i in range(40)], [])


@pytest.mark.parametrize("size", [1, 7, 40, 1 << 20])
@pytest.mark.parametrize("n_words,n_pairs", [(0, 0), (5, 0), (9, 30)])
def test_head_tail_and_cuts_do_not_change_buckets(size, n_words, n_pairs):
    texts = [words(k, n) for k, n in enumerate((0, 1, 2, 3, 50, 200))] + ["w" * 300, "a " * 100 + "b" * 65 + " c"]
    common = [w for w, _ in Counter(
        x for t in texts for x in importance._WORDS.findall(t.encode().lower()) if len(x) <= importance.WORD).most_common(n_words)]
    head = importance.Head(common, list(itertools.product(common, repeat=2))[:n_pairs])
    for text in texts:
        parts = list(importance.pieces(text.encode(), size))
        bucket, _, n = importance.features([p for p, _ in parts], [c for _, c in parts], head)
        assert (n.sum(), Counter(bucket.tolist())) == (brute_features(text)[0], Counter(brute_features(text)[1]))
    together = [t.encode().lower() for t in texts]
    bucket, own, _ = importance.features(together, [0] * len(texts), head)
    assert [Counter(bucket[own == k].tolist()) for k in range(len(texts))] == [Counter(brute_features(t)[1]) for t in texts]


def test_words_that_share_a_slot():
    pool = [f"w{k}".encode() for k in range(3000)]
    slots = importance._slot(np.array([int.from_bytes(w, "little") for w in pool], np.uint64), importance.WORD_SLOTS)
    twice = [k for k, n in Counter(slots.tolist()).items() if n > 1]
    same = [w for w, s in zip(pool, slots) if s in twice]
    assert len(same) > 50
    head = importance.Head(same, list(zip(same, same[1:])))
    text = " ".join(w.decode() for w in same)
    assert Counter(importance.features([text.encode()], [0], head)[0].tolist()) == Counter(brute_features(text)[1])


def test_head_is_counted_over_all_rows(spark):
    texts = spark.createDataFrame([("b a b",), ("B b c a",), ("",), ("é " * 3,), (("w" * 65 + " ") * 9,)], "text string")
    found = importance.frequent_words(texts.repartition(3), 2)
    assert found == [b"b", "é".encode(), b"a"]
    assert importance.frequent_pairs(texts.repartition(3), found, 2) == [(found[1], found[1])]
    assert set(importance.frequent_pairs(texts.repartition(3), found, 1)) == {
        (b"b", b"a"), (b"a", b"b"), (b"b", b"b"), (found[1], found[1])}
