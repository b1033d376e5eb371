"""Ordinals (K1/K2), delta state (A2/A4, K5, K6, S4/S5) and documents (K4)."""

import json
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseload.operators.ordinal import with_ordinal
from caseload.plans import serve, state
from caseload.schemas import RESULTS_TWO_METRICS

PAIR = ["practitioner", "diagnosis"]


def _rows(n=3000, seed=5):
    rnd = random.Random(seed)
    return [(str(i), rnd.choice(["flu", "gout", "sprain", "a", "b"]), rnd.randint(1, 50)) for i in range(n)]


def test_ordinal_equals_row_number(spark):
    df = spark.createDataFrame(_rows(), "practitioner string, diagnosis string, n_visits long").repartition(7)
    got = with_ordinal(df, ["practitioner"], ["diagnosis"]).select(*PAIR, "_id")
    w = Window.partitionBy("diagnosis").orderBy("practitioner")
    want = df.select(*PAIR, (F.row_number().over(w) - 1).alias("_id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    glob = with_ordinal(df, ["diagnosis", "practitioner"]).orderBy("_id").collect()
    assert [r._id for r in glob] == list(range(len(glob)))
    assert [(r.diagnosis, r.practitioner) for r in glob] == sorted((r.diagnosis, r.practitioner) for r in glob)


def test_documents(spark):
    df = spark.createDataFrame([("7", "flu", 3), ("2", "flu", 1), ("7", "gout", 4)],
                               "practitioner string, diagnosis string, n_visits long")
    docs = sorted(map(tuple, serve.to_documents(df).collect()))
    assert docs == [("flu", 0, '{"Practitioner":"2","Number of patients":1}'),
                    ("flu", 1, '{"Practitioner":"7","Number of patients":3}'),
                    ("gout", 0, '{"Practitioner":"7","Number of patients":4}')]
    glob = sorted(r._id for r in serve.to_documents(df, per_diagnosis=False).collect())
    assert glob == [0, 1, 2]
    assert json.loads(docs[0][2])["Number of patients"] == 1


def test_fold_of_any_split_equals_one_shot(spark):
    rows = _rows(2000)
    df = spark.createDataFrame(rows, "practitioner string, diagnosis string, n_visits long")
    one = {(r.practitioner, r.diagnosis): r.n_visits for r in
           df.groupBy(*PAIR).agg(F.sum("n_visits").alias("n_visits")).collect()}
    parts = [df.where(F.pmod(F.hash("practitioner"), F.lit(3)) == i) for i in range(3)]
    folded = state.fold(parts, PAIR, "n_visits")
    assert {(r.practitioner, r.diagnosis): r.n_visits for r in folded.collect()} == one


def test_delta_state_replay_compact_clear(spark, tmp):
    a = spark.createDataFrame([("1", "flu", 2), ("2", "gout", 1)], "practitioner string, diagnosis string, n_visits long")
    b = spark.createDataFrame([("1", "flu", 5)], "practitioner string, diagnosis string, n_visits long")

    def current(**kw):
        return sorted(map(tuple, state.read_totals(spark, tmp, PAIR, "n_visits", **kw).collect()))

    assert current() == []
    state.append_delta(spark, a, tmp, 0)
    state.append_delta(spark, a, tmp, 0)          # replay: replaced, not added
    assert current() == [("1", "flu", 2), ("2", "gout", 1)]
    state.append_delta(spark, b, tmp, 1)
    assert current() == [("1", "flu", 7), ("2", "gout", 1)]
    assert current(diagnosis="flu") == [("1", "flu", 7)]
    assert state.compact(spark, tmp, PAIR, "n_visits") == 1
    assert current() == [("1", "flu", 7), ("2", "gout", 1)]
    assert not state.append_delta(spark, b, tmp, 1, replay=True)   # a stream repeats a compacted batch
    with pytest.raises(ValueError):               # a correction of it is not lost in silence
        state.append_delta(spark, a, tmp, 1)
    assert current() == [("1", "flu", 7), ("2", "gout", 1)]
    state.append_delta(spark, b, tmp, 2)
    assert current() == [("1", "flu", 12), ("2", "gout", 1)]
    assert state.clear(spark, tmp)
    assert current() == []


def test_tiers_rewrite_n_log_n(spark, tmp, monkeypatch):
    """Over 60 batches, compacted two at a time, a batch is rewritten about
    log2(60) times and few snapshots are left; totals are those of one fold."""
    schema = "practitioner string, diagnosis string, n_visits long"
    rewritten, want = [], {}
    read = state.read_delta
    monkeypatch.setattr(state, "read_delta", lambda s, f, k, m: rewritten.append(f) or read(s, f, k, m))
    spans = {}
    for batch in range(60):
        state.append_delta(spark, spark.createDataFrame([(str(batch % 7), "flu", batch)], schema).coalesce(1), tmp, batch)
        want[str(batch % 7)] = want.get(str(batch % 7), 0) + batch
        if batch % 2:
            state.compact(spark, tmp, PAIR, "n_visits")
            spans[batch] = list(state.snapshots(spark, tmp))
    batches = 0
    for f in rewritten:
        name = f.rstrip("/").rsplit("/", 1)[-1]
        first, last = name.removeprefix("over=").split("-") if name.startswith("over=") else (0, 0)
        batches += int(last) - int(first) + 1
    assert batches <= 60 * 7                                   # folding all history every time would be 60 * 15
    assert all(len(s) <= 6 for s in spans.values())
    assert spans[59][-1][1] == 59
    got = {r.practitioner: r.n_visits for r in state.read_totals(spark, tmp, PAIR, "n_visits").collect()}
    assert got == want


def test_a_compaction_killed_before_it_cleans_counts_nothing_twice(spark, tmp, monkeypatch):
    schema = "practitioner string, diagnosis string, n_visits long"
    add = lambda batch: state.append_delta(spark, spark.createDataFrame([("1", "flu", 1)], schema), tmp, batch)
    total = lambda: [r.n_visits for r in state.read_totals(spark, tmp, PAIR, "n_visits").collect()]

    def killed(*_):
        raise KeyboardInterrupt

    for batch in range(4):
        add(batch)
        if batch % 2:
            with monkeypatch.context() as m:
                m.setattr(state, "delete_path", killed)
                with pytest.raises(KeyboardInterrupt):
                    state.compact(spark, tmp, PAIR, "n_visits")
            assert total() == [batch + 1]
    add(4)
    assert total() == [5] and state.compact(spark, tmp, PAIR, "n_visits") == 4 and total() == [5]


def test_a_half_written_delta_does_not_count(spark, tmp):
    """Until a new attempt is complete, the old delta is the one that is read."""
    from caseload.session import delete_path
    schema = "practitioner string, diagnosis string, n_visits long"
    state.append_delta(spark, spark.createDataFrame([("1", "flu", 2)], schema), tmp, 0)
    half = f"{tmp}/batch_id=0/attempt=1"
    spark.createDataFrame([("1", "flu", 9)], schema).write.partitionBy("diagnosis").parquet(half)
    delete_path(spark, f"{half}/_SUCCESS")
    assert [r.n_visits for r in state.read_totals(spark, tmp, PAIR, "n_visits").collect()] == [2]
    state.append_delta(spark, spark.createDataFrame([("1", "flu", 3)], schema), tmp, 0)
    assert [r.n_visits for r in state.read_totals(spark, tmp, PAIR, "n_visits").collect()] == [3]


def test_null_group_keeps_its_rows(spark):
    df = spark.createDataFrame([("1", None, 3), ("2", None, 1), ("2", "flu", 1)],
                               "practitioner string, diagnosis string, n_visits long")
    docs = serve.to_documents(df).collect()
    assert sorted((r.diagnosis or "", r._id) for r in docs) == [("", 0), ("", 1), ("flu", 0)]


def test_documents_name_every_column(spark):
    both = spark.createDataFrame([("7", 2, 3, "a b", "e", "h", "flu")], RESULTS_TWO_METRICS)
    assert json.loads(serve.to_documents(both).first().doc) == {
        "Practitioner": "7", "Number of patients": 2, "Number of cases": 3, "Full name": "a b", "E-mail": "e", "Hospital": "h"}
    cases = spark.createDataFrame([("7", "flu", "p", 3)], "practitioner string, diagnosis string, patient string, n_cases long")
    assert json.loads(serve.to_documents(cases).first().doc) == {"Practitioner": "7", "Patient": "p", "Number of cases": 3}
    with pytest.raises(ValueError):
        serve.to_documents(both.withColumn("extra", F.lit(1)))


def test_full_build_replaces_and_incremental_build_removes_what_it_empties(spark, tmp):
    from caseload.schemas import RESULTS
    row = lambda d, n=1: ("1", n, "a b", "e", "h", d)
    serve.write_results(spark.createDataFrame([row("flu"), row("gout")], RESULTS), tmp)
    serve.write_results(spark.createDataFrame([row("flu", 2), row("a/b=c", 1)], RESULTS), tmp)
    read = lambda: sorted((r.diagnosis, r.n_visits) for r in serve.read_results(spark, tmp).collect())
    assert read() == [("a/b=c", 1), ("flu", 2)]
    touched = spark.createDataFrame([("flu",), ("a/b=c",)], "diagnosis string")
    serve.write_results(spark.createDataFrame([row("flu", 3)], RESULTS), tmp, touched)
    assert read() == [("flu", 3)]


def test_results_overwrite_per_diagnosis(spark, tmp):
    from caseload.schemas import RESULTS
    old = spark.createDataFrame([("1", 5, "a b", "e", "h", "flu"), ("9", 1, "z z", "e", "h", "flu"),
                                 ("1", 2, "a b", "e", "h", "gout")], RESULTS)
    new = spark.createDataFrame([("1", 6, "a b", "e", "h", "flu")], RESULTS)
    serve.write_results(old, tmp)
    serve.write_results(new, tmp, new.select("diagnosis"))
    got = sorted(map(tuple, serve.read_results(spark, tmp).collect()))
    assert got == [("1", 2, "a b", "e", "h", "gout"), ("1", 6, "a b", "e", "h", "flu")]
    assert [r.n_visits for r in serve.read_results(spark, tmp, diagnosis="gout").collect()] == [2]


def test_a_build_killed_before_its_switch_leaves_the_old_table(spark, tmp, monkeypatch):
    from caseload.plans import published
    from caseload.schemas import RESULTS
    frame = lambda *rows: spark.createDataFrame([("1", n, "a b", "e", "h", d) for d, n in rows], RESULTS)
    read = lambda: sorted((r.diagnosis, r.n_visits) for r in serve.read_results(spark, tmp).collect())
    with pytest.raises(FileNotFoundError):
        read()
    serve.write_results(frame(("flu", 1), ("gout", 1), ("cold", 1)), tmp)
    touched = frame(("flu", 0), ("gout", 0)).select("diagnosis")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(published, "_switch", killed)
        for again in range(2):
            with pytest.raises(KeyboardInterrupt):
                serve.write_results(frame(("flu", 2)), tmp, touched)
            with pytest.raises(KeyboardInterrupt):
                serve.write_results(frame(("flu", 2)), tmp)
            assert read() == [("cold", 1), ("flu", 1), ("gout", 1)]
    before = serve.read_results(spark, tmp)
    serve.write_results(frame(("flu", 3)), tmp, touched)
    assert read() == [("cold", 1), ("flu", 3)]
    assert sorted(r.diagnosis for r in before.collect()) == ["cold", "flu", "gout"]  # a reader that began before the switch
    serve.write_results(frame(("flu", 4)), tmp)
    assert read() == [("flu", 4)]
    assert sorted(published._folders(spark, f"{tmp}/_manifests")) == ["1", "2"]       # nothing of the killed builds
    assert len(published._folders(spark, f"{tmp}/data")) == 3


def test_of_two_builds_at_once_the_second_fails(spark, tmp, monkeypatch):
    from caseload.plans import published
    from caseload.schemas import RESULTS
    frame = lambda n: spark.createDataFrame([("1", n, "a b", "e", "h", "flu")], RESULTS)
    serve.write_results(frame(1), tmp)
    switch = published._switch

    def late(session, draft, name):
        monkeypatch.setattr(published, "_switch", switch)
        serve.write_results(frame(2), tmp)             # another build comes first
        switch(session, draft, name)

    monkeypatch.setattr(published, "_switch", late)
    with pytest.raises(Exception, match="(?i)exist"):
        serve.write_results(frame(3), tmp)
    assert [r.n_visits for r in serve.read_results(spark, tmp).collect()] == [2]


def test_many_builds_leave_few_versions(spark, tmp, monkeypatch):
    from caseload.plans import published
    from caseload.schemas import RESULTS
    monkeypatch.setattr(published, "VERSIONS", 3)
    want = {f"d{k}": 0 for k in range(5)}
    frame = lambda rows: spark.createDataFrame([("1", n, "a b", "e", "h", d) for d, n in rows.items()], RESULTS)
    serve.write_results(frame(want), tmp)
    for k in range(1, 9):
        some = {f"d{k % 5}": k, f"d{(2 * k) % 5}": k}
        gone = f"d{(k + 1) % 5}" if k in (4, 6) else None
        some.pop(gone, None)
        want = {d: n for d, n in (want | some).items() if d != gone}
        touched = spark.createDataFrame([(d,) for d in [*some, *([gone] if gone else [])]], "diagnosis string")
        serve.write_results(frame(some), tmp, touched)
        assert {r.diagnosis: r.n_visits for r in serve.read_results(spark, tmp).collect()} == want
        assert len(published._live(spark, tmp, published.current(spark, tmp))) <= 3


def test_numeric_looking_diagnosis_stays_text(spark, tmp):
    from caseload.schemas import RESULTS
    df = spark.createDataFrame([("1", 5, "a b", "e", "h", "007")], RESULTS)
    serve.write_results(df, tmp)
    assert serve.read_results(spark, tmp).first().diagnosis == "007"


def folder_store(folder, poison=None):
    import json  # the store goes to workers that cannot import this module
    import os
    import uuid

    class FolderStore:
        """A document store of files: staged ones have a dot in front; a request with the poison fails once it is staged."""

        def __init__(self, folder, poison=None):
            self.folder, self.poison = folder, poison

        def stage(self, docs):
            name = uuid.uuid4().hex
            with open(f"{self.folder}/.{name}", "w") as f:
                f.write("\n".join(json.dumps(d) for d in docs))
            if self.poison and any(d["doc"] == self.poison for d in docs) and not os.path.exists(f"{self.folder}/failed"):
                open(f"{self.folder}/failed", "w").close()
                raise RuntimeError("the store is away")
            return name

        def publish(self, names):
            for n in names:
                os.rename(f"{self.folder}/.{n}", f"{self.folder}/{n}")

        def discard(self, names):
            for n in names:
                os.remove(f"{self.folder}/.{n}")

    return FolderStore(folder, poison)


def _sent(folder):
    return [[json.loads(line) for line in open(f"{folder}/{n}")] for n in os.listdir(folder) if n[0] != "." and n != "failed"]


def _store_docs(spark):
    df = spark.createDataFrame([(str(i), "flu" if i % 5 else "gout", i) for i in range(2500)],
                               "practitioner string, diagnosis string, n_visits long").repartition(2)
    return serve.to_documents(df)


def test_send_in_chunks(spark, tmp):
    folder = tmp.replace("file:", "") + "-sent"
    os.makedirs(folder)
    serve.send_in_chunks(_store_docs(spark), folder_store(folder), chunk=1000)
    sent = _sent(folder)
    assert sorted(map(len, sent)) == [500, 1000, 1000]
    assert all(len({d["diagnosis"] for d in r}) == 1 and [d["_id"] for d in r] == list(range(r[0]["_id"], r[0]["_id"] + len(r)))
               for r in sent)
    assert not [n for n in os.listdir(folder) if n[0] == "."]


def test_a_failed_task_sends_nothing_twice(spark, tmp):
    """A write that fails publishes nothing; run again, every document is there once."""
    folder = tmp.replace("file:", "") + "-sent"
    os.makedirs(folder)
    docs = _store_docs(spark)
    poison = docs.where("diagnosis = 'flu' and _id = 700").first().doc
    store = folder_store(folder, poison)
    with pytest.raises(Exception, match="away"):
        serve.send_in_chunks(docs, store, chunk=100)
    assert _sent(folder) == []
    serve.send_in_chunks(docs, store, chunk=100)
    got = [(d["diagnosis"], d["_id"]) for r in _sent(folder) for d in r]
    assert sorted(got) == [("flu", i) for i in range(2000)] + [("gout", i) for i in range(500)]


def test_requests_are_formed_without_python(spark, capsys):
    serve.requests(_store_docs(spark)).explain()
    p = capsys.readouterr().out
    assert "Python" not in p and "InPandas" not in p


def test_ids_last_and_only_new_documents_are_numbered(spark, tmp, capsys):
    from caseload.plans import identity
    frame = lambda *rows: spark.createDataFrame([(p, d, 1) for p, d in rows],
                                                "practitioner string, diagnosis string, n_visits long")
    ids = lambda df: {(r.practitioner, r.diagnosis): r._id for r in identity.with_lasting_id(df, tmp).collect()}
    assert ids(frame(("5", "flu"), ("7", "flu"), ("5", "gout"))) == {("5", "flu"): 0, ("7", "flu"): 1, ("5", "gout"): 0}
    second = frame(("1", "flu"), ("7", "flu"), ("9", "flu"), ("1", "cold"))          # 5 is away
    assert ids(second) == {("7", "flu"): 1, ("1", "flu"): 2, ("9", "flu"): 3, ("1", "cold"): 0}
    assert ids(second) == {("7", "flu"): 1, ("1", "flu"): 2, ("9", "flu"): 3, ("1", "cold"): 0}
    assert ids(frame(("5", "flu"), ("2", "flu"))) == {("5", "flu"): 0, ("2", "flu"): 4}
    # a build that ended while it wrote its numbers
    from caseload.session import delete_path
    ids(frame(("3", "flu")))
    delete_path(spark, f"{tmp}/build=4/_SUCCESS")
    assert ids(frame(("4", "flu"))) == {("4", "flu"): 5}
    assert ids(frame(("3", "flu"), ("3", "flu"))) == {("3", "flu"): 6}


def test_ordinal_for_a_hot_group_spanning_partitions(spark):
    rows = [(f"{i:05d}", "hot" if i % 3 else f"d{i % 7}", 1) for i in range(6000)]
    df = spark.createDataFrame(rows, "practitioner string, diagnosis string, n_visits long").repartition(5)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")          # small input: keep every range partition
    try:
        spans = (df.orderBy("diagnosis", "practitioner").withColumn("p", F.spark_partition_id())
                   .where("diagnosis = 'hot'").select("p").distinct().count())
        res = with_ordinal(df, ["practitioner"], ["diagnosis"]).collect()
    finally:
        spark.conf.set(key, old)
    assert spans > 1                                            # the hot group spans several tasks
    hot = sorted((r.practitioner, r._id) for r in res if r.diagnosis == "hot")
    assert [i for _, i in hot] == list(range(len(hot))) and len(hot) == 4000
    cold = sorted((r.diagnosis, r.practitioner, r._id) for r in res if r.diagnosis != "hot")
    for d in {c[0] for c in cold}:
        assert [i for dd, _, i in cold if dd == d] == list(range(sum(1 for c in cold if c[0] == d)))
