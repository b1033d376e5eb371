"""Joins and dedup against brute force; the archive's round trip; HTML; the pipeline."""

import base64
import collections
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseload.llm import block_dedup, bwt_dedup, chunks, components, html_text, ngram_join, queries, warc
from caseload.llm.common import read_table

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(params=[(2 << 20, 16 << 20), (1 << 14, 1 << 15)])
def sizes(request, monkeypatch):
    """Usual chunk sizes, and small ones that spread a small table over many chunks and buckets."""
    monkeypatch.setattr(chunks, "CHUNK_BYTES", request.param[0])
    monkeypatch.setattr(chunks, "TASK_BYTES", 4 * request.param[0])
    monkeypatch.setattr(chunks, "BUCKET_BYTES", request.param[1])


def planted(seed=1, n=60):
    """Documents that share passages of many lengths; copies, repeats, nulls, equal ids, missing ids."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    passages = [" ".join(word() for _ in range(k)) for k in (3, 20, 49, 50, 51, 75, 120)]
    rows = []
    for d in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), " ".join(word() for _ in range(rng.randint(0, 30)))]
        rows.append((rng.randint(0, 500), rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [rows[0], rows[1], (600, rows[2][1]), (601, rows[2][1]), (602, None), (603, ""), (604, "x y"), (605, "a " * 3000),
             (606, "b" + "a " * 2000), (None, rows[2][1]), (None, passages[-1]), (607, " ".join(passages))]
    rng.shuffle(rows)
    return [(i, t, "en", "s", 0) for i, t in rows]


# ------------------------------------------------------------ op 8 and 10

def brute_windows(rows, cut, k):
    """(row -> flags of the units that go): windows of k units that also start in a smaller id."""
    units = [cut(t or "") for _, t in rows]
    least = {}
    for (i, _), u in zip(rows, units):
        for s in range(len(u) - k + 1):
            if i is not None:
                w = tuple(u[s:s + k])
                least[w] = min(least.get(w, i), i)
    out = []
    for (i, _), u in zip(rows, units):
        gone = [False] * len(u)
        for s in range(len(u) - k + 1):
            if i is not None and least[tuple(u[s:s + k])] < i:
                gone[s:s + k] = [True] * k
        out.append((u, gone))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_block_dedup_equals_brute_force(spark, sizes, seed):
    rows = planted(seed)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in
                 block_dedup.dedup(spark.createDataFrame(rows, DOC)).collect())
    want = []
    for (i, *_), (u, gone) in zip(rows, brute_windows([r[:2] for r in rows], lambda t: t.encode().split(), 50)):
        want.append((str(i), len(u), sum(gone), b" ".join(w for w, g in zip(u, gone) if not g).decode()))
    assert got == sorted(want) and sum(w[2] for w in want) > 0


@pytest.mark.parametrize("seed", [1, 2])
def test_bwt_dedup_equals_brute_force(spark, sizes, seed):
    rows = planted(seed)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in
                 bwt_dedup.dedup(spark.createDataFrame(rows, DOC)).collect())
    want = []
    for (i, *_), (u, gone) in zip(rows, brute_windows([r[:2] for r in rows], lambda t: t.encode(), 50)):
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        want.append((str(i), len(u), sum(gone), spans, bytes(b for b, g in zip(u, gone) if not g)))
    assert got == sorted(want) and sum(w[2] for w in want) > 0


@pytest.mark.parametrize("most", [1, 7])
def test_bwt_dedup_splits_hot_anchors(spark, sizes, most):
    rows = planted(3)
    docs = spark.createDataFrame(rows, DOC)
    got = sorted((str(r.doc_id), r.n_removed, bytes(r.kept)) for r in bwt_dedup.dedup(docs, most=most).collect())
    want = [(str(i), sum(gone), bytes(b for b, g in zip(u, gone) if not g))
            for (i, *_), (u, gone) in zip(rows, brute_windows([r[:2] for r in rows], lambda t: t.encode(), 50))]
    assert got == sorted(want)


def test_a_passage_in_many_surroundings_fills_no_merge(spark, monkeypatch):
    rng = random.Random(5)
    own = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    passage = own(90)
    rows = [(d, own(60) + passage + own(60), "en", "s", 0) for d in range(1500)]

    def bounded(length, plain=bwt_dedup._merge):
        merge = plain(length)

        def run(table):
            n = sum(len(k.as_py()) for k in table.column("keys"))
            if n > 1000:
                raise ValueError(f"{n} strings in a merge")
            return merge(table)

        return run

    monkeypatch.setattr(bwt_dedup, "_merge", bounded)
    out = bwt_dedup.dedup(spark.createDataFrame(rows, DOC), chunk_bytes=1 << 15).collect()
    want = {i: sum(gone) for (i, *_), (_, gone) in
            zip(rows, brute_windows([r[:2] for r in rows], lambda t: t.encode(), 50))}
    assert {r.doc_id: r.n_removed for r in out} == want and sum(want.values()) >= 1499 * 90


def test_dedup_queries_on_a_table(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    words = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op8_block_anchor_dedup(spark, SF).collect()}
    for (i, _), (u, gone) in zip(rows, brute_windows(rows, lambda t: t.encode().split(), 50)):
        assert words[i] == (len(u), sum(gone), sha(b" ".join(w for w, g in zip(u, gone) if not g)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in queries.op10_bwt_merge_dedup(spark, SF).collect()}
    for (i, _), (u, gone) in zip(rows, brute_windows(rows, lambda t: t.encode(), 50)):
        assert got[i] == (len(u), sum(gone), sha(bytes(b for b, g in zip(u, gone) if not g)))


def test_deduplicated_documents_keep_their_columns(spark):
    a = "é" * 30 + "the same passage of more than fifty bytes, shared by both of them"
    docs = spark.createDataFrame([(1, a, "en", "s", len(a)), (2, "own start " + a[25:], "en", "s", 75), (3, None, "en", "s", None)],
                                 DOC).selectExpr("*", "'k' AS chunk", "1 AS `rows`", "2 AS kept")
    out = {r.doc_id: r for r in bwt_dedup.deduplicated(docs).collect()}
    assert bwt_dedup.deduplicated(docs).schema.names == docs.columns
    assert out[1].text == a and out[1].chunk == "k" and out[1]["rows"] == 1
    assert out[2].text == "own start " and out[2].n_chars == 10 and out[3].text is None and out[3].n_chars is None


def test_dedup_of_nothing(spark, none):
    assert block_dedup.dedup(none).count() == 0
    assert bwt_dedup.dedup(none).count() == 0
    assert bwt_dedup.deduplicated(none).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None)], DOC)
    assert [(r.n_words, r.n_removed, r.kept) for r in block_dedup.dedup(blank).collect()] == [(0, 0, "")] * 2
    assert [(r.n_bytes, r.n_removed, r.n_spans) for r in bwt_dedup.dedup(blank).collect()] == [(0, 0, 0)] * 2


def test_interleave_equals_sorting_everything():
    """Merged shard transforms give the order and the intervals of one sort of all suffixes."""
    rng = np.random.default_rng(5)
    strings = [rng.integers(1, 4, rng.integers(1, 12)) for _ in range(40)]
    shard = np.sort(rng.integers(0, 6, 40))
    rounds, suffixes = 3, []
    for k, s in enumerate(strings):
        suffixes += [(k, p) for p in range(len(s) + 1)]
    own = np.array([k for k, _ in suffixes])
    symbol = lambda k, p: int(strings[k][p]) if 0 <= p < len(strings[k]) else 0
    symbols = [np.array([symbol(k, p + r) for k, p in suffixes]) for r in range(rounds)]
    before = np.array([symbol(k, p - 1) for k, p in suffixes])
    order, transform = bwt_dedup.shard_transform(symbols, before, shard[own])
    slot, interval = bwt_dedup.interleave(transform, np.bincount(shard[own], minlength=6), rounds)
    prefix = [tuple(int(c[k]) for c in symbols) for k in order]
    whole = [k for k, p in enumerate(prefix) if 0 not in p]
    by = collections.defaultdict(set)
    for k in whole:
        by[prefix[k]].add(int(interval[k]))
    assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)
    assert sorted(slot.tolist()) == list(range(len(order)))
    ranked = [prefix[k] for k in sorted(whole, key=lambda k: slot[k])]
    assert ranked == sorted(ranked)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    for values in ([], [5], [-3, 1 << 40, 7], rng.integers(-(1 << 62), 1 << 62, 50)):
        values = np.array(values, np.int64)
        assert (chunks.wide_ints(chunks.narrow_bytes(values)) == values).all()
    some = rng.random(13) < 0.5
    assert (chunks.flags(chunks.bits(some), 13) == some).all()
    data = np.frombuffer(b"abcabcabd abc", np.uint8)
    h = chunks.rolling(chunks.BYTE_VALUES[data], 3)
    same = [[bytes(data[i:i + 3]) == bytes(data[j:j + 3]) for j in range(len(h))] for i in range(len(h))]
    assert ((h[:, None] == h[None, :]) == np.array(same)).all()


# ------------------------------------------------------------ op 6

def brute_join(rows, n=5, threshold=0.8):
    words = {}
    for i, t in rows:
        words.setdefault(i, tuple((t or "").encode().split()))
    sets = {i: frozenset(w[k:k + n] for k in range(max(1, len(w) - n + 1))) if w else frozenset() for i, w in words.items()}
    near = collections.defaultdict(set)
    for a, b in itertools.combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if words[a] == words[b] or either and both >= threshold * either - 1e-9:
            near[a].add(b)
            near[b].add(a)
    root = {}
    for i in sorted(sets):
        stack = [] if i in root else [i]
        while stack:
            x = stack.pop()
            if x not in root:
                root[x] = i
                stack += near[x]
    return {i: (root[i], len(near[i])) for i in sets}


def near_copies(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    rows = []
    for g in range(12):
        base = [word() for _ in range(rng.randint(6, 150))]
        for _ in range(rng.choice([1, 2, 3, 30])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [None, "", " \n", "one two", "one two", "one two three", "a b c d e"]
    return [(3 * k + 1, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("block", [128, 4])
def test_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(docs).collect()}
    assert got == brute_join(rows)


def test_join_counts_repeated_rows_once(spark):
    rows = near_copies()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows + rows[:40]], DOC)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(docs).collect()}
    assert got == brute_join(rows)
    again = rows + [(rows[5][0], rows[6][1])]  # an id with two texts joins their classes
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in again], DOC)
    out = ngram_join.join(docs).collect()
    assert len(out) == len(again)
    classes = {r.doc_id: r.class_id for r in out}
    assert classes[rows[5][0]] == classes[rows[6][0]]
    assert len(ngram_join.one_of_each(docs).collect()) == len(set(classes.values()))


@pytest.mark.parametrize("block", [128, 16])
def test_join_of_one_large_group_of_different_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(11)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(400)]
    rows = []
    for k in range(150):
        copy = list(base)
        for at in rng.sample(range(400), rng.randint(0, 9)):
            copy[at] = f"x{k}n{at}"
        rows.append((1000 - k, " ".join(copy)))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(docs).collect()}
    assert got == brute_join(rows)


def test_join_query_on_a_table(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op6_ngram_jaccard_join(spark, SF).collect()}
    assert got == brute_join(rows)


def test_join_edge_cases(spark, none):
    assert ngram_join.join(none).count() == 0 and ngram_join.one_of_each(none).count() == 0
    rows = [(1, "a b c d e f", "en", "s", 0), (1, "a b c d e f", "en", "s", 0), (2, "a b c d e f", "en", "s", 0),
            (None, "a b c d e f", "en", "s", 0), (4, "x " * 50000, "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS node", "2 AS grp", "3 AS class_id")
    assert sorted(map(tuple, ngram_join.join(docs).select("doc_id", "class_id").collect()), key=str) == sorted(
        [(1, 1), (1, 1), (2, 1), (4, 4), (None, None)], key=str)
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [1, 4, None]


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.99), (0.95, 0.999)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall and bands * rows <= ngram_join.HASHES
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.01, 0.9999, 10)


def test_overlaps_are_intersections():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(0, 6000)).astype(np.uint64)) for _ in range(7)]
    got = ngram_join.overlaps(sets)
    assert all(got[a, b] == len(np.intersect1d(sets[a], sets[b])) for a, b in itertools.combinations(range(7), 2))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (2000, 1999)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(41)} | {k: 1000 for k in range(1000, 1100)} | {1999: 1999, 2000: 1999}


# ------------------------------------------------------------ op 9

def test_archive_round_trip(spark, tmp):
    rows = [(3, "http://a/x", "<p>é</p>"), (1, "http://b\r\nX: y", "<p>é</p>"), (2, None, None), (4, "u", ""), (5, "u", "x" * 300000),
            (7, "u", "same"), (7, "u", "same"), (None, "u", "<p>é</p>"), (8, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS sha256", "2 AS payload")
    warc.write_archive(pages, tmp)
    assert spark.read.parquet(f"{tmp}/payloads").count() == 4  # every payload once
    archive = warc.read_archive(spark, tmp)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        kind = "response" if i == first[h or ""] else "revisit"
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind,
                     first[h or ""] if kind == "revisit" else None))
    assert sorted(map(tuple, warc.parsed(archive).collect()), key=str) == sorted(want, key=str)
    for r in warc.records(archive).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and block.endswith(b"\r\n\r\n")
        assert len(block) == int(fields["Content-Length"]) + 4


def test_small_payloads_may_all_be_responses(spark, tmp):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")],
                                  "page_id long, url string, html string")
    warc.write_archive(pages, tmp, min_bytes=4)
    assert {r.page_id: r.record_type for r in warc.parsed(warc.read_archive(spark, tmp)).collect()} == {
        1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_damage_is_noticed(spark, tmp):
    warc.write_archive(spark.createDataFrame([(1, "u", "ab")], "page_id long, url string, html string"), tmp)
    stored = spark.read.parquet(f"{tmp}/payloads")
    import zstandard
    bad = zstandard.compress(b"other")
    rows = [(r.sha256, bad) for r in stored.collect()]
    spark.createDataFrame(rows, "sha256 string, payload binary").write.mode("overwrite").parquet(f"{tmp}/payloads")
    with pytest.raises(Exception, match="damaged"):
        warc.parsed(warc.read_archive(spark, tmp)).collect()


def test_archive_query(spark):
    pages = read_table(spark, SF, "pages").collect()
    got = {r.page_id: r for r in queries.op9_content_addressed_warc(spark, SF).collect()}
    by = collections.defaultdict(list)
    for p in pages:
        by[p.html or ""].append(p.page_id)
    for p in pages:
        data, first = (p.html or "").encode(), min(by[p.html or ""])
        g = got[p.page_id]
        assert (g.payload_bytes, g.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (g.record_type, g.refers_to) == (("response", None) if p.page_id == first else ("revisit", first))
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(empty, path := queries.work_dir(spark, "empty"))
    assert warc.parsed(warc.read_archive(spark, path)).count() == 0


# ------------------------------------------------------------ op 7

@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("a<br>b", "a\nb"), ("<p>a<p>b", "a\n\nb"), ("<div>a<div>b</div></div>c", "a\nb\nc"),
    ("<title>t</title><script>var x='</p>'</script><style>p{}</style>seen", "seen"),
    ("<p hidden>no</p><p style='color:red; display : none'>no</p><p>yes</p>", "yes"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"), ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<table><tr><td>long cell<td>x<tr><td>s<td>y</table>", "long cell  x\ns          y"),
    ("<table><tr><th>漢字<td>x<tr><td>ab<td>y</table>", "漢字  x\nab    y"),
    ("<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>", "wide cell\na  b"),
    ("<table><tr><td>a<table><tr><td>in</table><td>b</table>", "a   b\n\nin"),
    ("<pre>  x\n   y</pre>z", "  x\n   y\n\nz"), ("&lt;p&gt; &amp;amp; &eacute;", "<p> &amp; é"), ("a<!-- no -->b", "ab"),
    ("<details><summary>s</summary>no</details>", "s"), ("<details open><summary>s</summary>yes</details>", "s\nyes"),
    ("<blockquote>q<p>r</blockquote>e", "  q\n\n  r\n\ne"), ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("x</p>y", "x\n\ny"),
    ("one  <b> two</b>\n three <a href='x", "one two three"), ("<div>" * 5000 + "deep", "deep"),
    ("a<![foo[x]]>b", "ab"), ("<![ @x]>y", "y"), ("a<![CDATA[x]]>b", "ab"), ("<svg><text><![CDATA[x<]]></text></svg>", "x<"),
    ("a<![", "a"), ("<!x>y", "y"), ("<?x>y", "y"), ("</>y", "y"),
    (f"<ol start={'9' * 5000}><li>a</ol>", "2147483647. a"), (f"<ol><li value=-{'9' * 5000}>a</ol>", "-2147483647. a"),
    ("<ol start=-1><li>a<li value=x>b<li value=' 7 '>c</ol>", "-1. a\n0. b\n7. c"),
    (f"a&#{'1' * 5000};b&#0000000065;c", "a\ufffdbAc"), (f"&#{'0' * 5000}66;", "B"), (f"<p title='&#{'1' * 5000}'>b", "b"),
    (f"<table><tr><td rowspan={'9' * 5000}>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
    ("<table><tr><td rowspan=2>a<td colspan=0>b<td rowspan=2>c<tr><td>d<td>e</table>", "a  b  c\n   d     e"),
    ("<svg><title>t</title><desc>d</desc>z<text>hi</text><defs><text>no</text></defs></svg>x", "hi\nx"),
    ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"), ("a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b", "a x=1 b"),
    ("<math><semantics><mi>x</mi><annotation>no</annotation></semantics></math>", "x"),
    ("a<select><option>one<option selected>two<option>three</select>b", "a two b"),
    ("<select><option disabled>one<optgroup label=g><option>two</optgroup></select>", "two"),
    ("<select multiple><option>one<option>two</select>", "one\ntwo"), ("<select size=2><option>one<option hidden>no</select>", "one"),
    ("<select></select>x", "x"), ("<object data=x><param name=a>fallback</object>", "fallback"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b><br>no</div>", "yes"),
    ("<p style='VISIBILITY: hidden !important'>no</p><p style='visibility:inherit'>yes", "yes"),
    ("<ul style='visibility:collapse'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
    ("<p>a<plaintext>b <p>c</plaintext>&amp;", "a\n\nb <p>c</plaintext>&amp;"), ("<xmp><b>x</b></xmp>y", "<b>x</b>\n\ny"),
    ("<xmp><b>x", "<b>x"), ("<iframe>no</iframe><canvas>no</canvas><video>no</video>yes", "yes"),
])
def test_rendering(html, text):
    assert html_text.text_of(html) == text


def test_random_markup_never_fails():
    import random
    rng = random.Random(11)
    bits = ["<", ">", "</", "/>", "<!", "<![", "]]>", "<!--", "-->", "--!>", "<?", "&", "&#", "&#x", ";", "=", "'", '"', " ", "\n", "\0",
            "[", "]", "]>", "@", "<![CDATA[", "<!DOCTYPE", "9" * 5000, "12", "-", "x", "é", "rowspan=", "colspan=", "start=", "value=",
            "style=visibility:", "hidden", "visible", "display:none", "size=3", "selected", "multiple",
            *[f"<{t}>" for t in "table tr td th caption ol ul li p div select option optgroup svg text math mi object pre textarea xmp "
              "plaintext script style title head body html br q dl dt dd blockquote details summary template a b".split()],
            *[f"</{t}>" for t in "table tr td ol ul li p div select option svg text math object pre xmp script q dl a".split()]]
    for _ in range(20000):
        html = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))
        assert isinstance(html_text.text_of(html), str)


def test_spans_cost_no_more_than_their_columns():
    import time
    began = time.process_time()
    assert html_text.text_of("<table>" + ("<tr>" + "<td rowspan=65534 colspan=1000>x" * 4) * 50 + "</table>").split() == ["x"] * 200
    assert time.process_time() - began < 5


def test_every_visible_word_of_the_pages_comes_out(spark):
    """The words between the tags of a page's body, in order, are the words of its text."""
    import html as entities
    import re
    for p, got in zip(read_table(spark, SF, "pages").orderBy("page_id").collect(),
                      queries.op7_html_text(spark, SF).orderBy("page_id").collect()):
        bare = re.sub(r"<(script|style|title)>.*?</\1>|<!--.*?-->|<!DOCTYPE[^>]*>", " ", p.html, flags=re.S)
        want = entities.unescape(re.sub(r"<[^>]*>|<[^>]*$", " ", bare)).split()
        assert [w for w in got.text.split() if w != "-"] == [w for w in want if w != "-"]


def test_pages_edge_cases(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, "<p>x"), (2, None, "<p>x")], "page_id long, url string, html string")
    out = html_text.extracted(pages.selectExpr("*", "'z' AS text")).collect()
    assert sorted((r.page_id, r.text) for r in out) == [(1, ""), (2, "x"), (2, "x")]
    assert html_text.extracted(pages.limit(0)).count() == 0


# ------------------------------------------------------------ pipeline

def test_stages(spark):
    import corpus_pipeline
    docs = read_table(spark, SF, "documents")
    names, seen = docs.columns, {}
    from caseload.llm.common import written
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == names
        seen[name] = docs.collect()
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in seen["quality_rules"]}
    assert not [d for d, q in labels.items() if q == 0 and d in kept and len(labels) > 50][5:]
    rows = [(r.doc_id, r.text) for r in seen["quality_rules"]]
    classes = brute_join(rows)
    assert {r.doc_id for r in seen["near_duplicates"]} == {c for c, _ in classes.values()}
    rows = [(r.doc_id, r.text) for r in seen["near_duplicates"]]
    cut = {i: bytes(b for b, g in zip(u, gone) if not g).decode("utf-8", "ignore")
           for (i, _), (u, gone) in zip(rows, brute_windows(rows, lambda t: t.encode(), 50))}
    assert {r.doc_id: r.text for r in seen["repeated_passages"]} == cut
    assert all(r.n_chars == len(r.text) for r in seen["repeated_passages"])
    mixed = collections.Counter(r.doc_id for r in seen["source_mixing"])
    assert set(mixed) <= set(cut) and max(mixed.values()) <= 2
    out = corpus_pipeline.run(spark, SF).collect()
    assert collections.Counter(r.doc_id for r in out if r.piece == 0) == mixed


def test_run_is_repeatable_and_handles_nothing(spark, none, tmp):
    import corpus_pipeline
    none.write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    assert corpus_pipeline.run(spark, tmp).count() == 0


def test_everything_is_registered():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    import __spark_entry__
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def test_oracle_of_the_mix(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLES["op3_source_mixing"]).df()
    got = queries.op3_source_mixing(spark, SF)
    rows = lambda df: sorted(df[sorted(df.columns)].itertuples(index=False, name=None))
    assert rows(got.toPandas()) == rows(want)
    assert got.where(F.col("target").isNull()).count() == 0


# ------------------------------------------------------------ exactness of the merge

def test_equal_hashes_of_different_strings_are_told_apart(monkeypatch):
    data = np.frombuffer(b"aaaabbbbaaaabbbc", np.uint8)
    start, size = np.array([0, 4, 8, 12]), np.array([4, 4, 4, 4])
    assert [x.tolist() for x in bwt_dedup._distinct(data, start, size)] == [[0, 1, 3], [0, 1, 0, 2]]
    monkeypatch.setattr(bwt_dedup, "span_hashes", lambda d, a, b: np.zeros(len(a), np.uint64))
    assert [x.tolist() for x in bwt_dedup._distinct(data, start, size)] == [[0, 1, 3], [0, 1, 0, 2]]
    same = bwt_dedup._exact(data, np.array([0, 8, 4, 12]), np.array([5, 5, 7, 7]), 4)
    assert same[0] == same[1] and len({same[0], same[2], same[3]}) == 3
    assert bwt_dedup._exact(data, np.array([0, 8, 4]), np.array([5, 5, 7]), 4).tolist() == [5, 5, 7]


def test_chunk_sizes_follow_the_input():
    sizes = [chunks.sizes_for(1 << k) for k in range(10, 48)]
    assert sizes == sorted(sizes) and sizes[0] == (chunks.CHUNK_BYTES, chunks.BUCKET_BYTES)
    assert sizes[-1] == (chunks.MOST_CHUNK_BYTES, chunks.MOST_BUCKET_BYTES)


def test_buckets_are_those_that_have_keys():
    assert chunks.by_bucket(np.array([], np.int64)) == []
    assert chunks.by_bucket(np.array([2, 2, 900_000_000])) == [(2, slice(0, 2)), (900_000_000, slice(2, 3))]


def test_unrelated_texts_of_one_id_both_stay(spark):
    words = lambda k: " ".join(f"{k}word{i}" for i in range(60))
    rows = [(5, words("a"), {"k": 1}), (5, words("b"), {"k": 2}), (5, words("b"), {"k": 2}), (7, words("c"), None),
            (8, words("c"), None), (None, words("c"), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string, int>")
    got = sorted((str(r.doc_id), r.text[:6]) for r in ngram_join.one_of_each(docs).collect())
    assert got == [("5", "aword0"), ("5", "bword0"), ("7", "cword0"), ("None", "cword0")]
