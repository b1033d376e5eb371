"""The malformed-line fixture and practitioner extraction."""

from conftest import lines_df

from caseload.operators import extract

L1 = '{"participant":[{"individual":"7"}],"diagnosis":[{"condition":"flu"}],"subject":"1"}'
FIXTURE = [
    L1,                                                                          # 1
    '{"participant":[],"diagnosis":[{"condition":"flu"}]}',                      # 2
    '{bad',                                                                      # 3
    '{"participant":[{"individual":5}],"diagnosis":[{"condition":null}]}',       # 4
    '{"participant":[{"individual":true}],"diagnosis":[{"condition":1.50}]}',    # 5
    '{"participant":{"individual":"9"},"diagnosis":[{"condition":"x"}]}',        # 6
    '[1]',                                                                       # 7
    '',                                                                          # 8
    '{"participant":[{"individual":"7"},{"individual":"8"}],'
    '"diagnosis":[{"condition":"flu"},{"condition":"gout"}],"subject":"2"}',    # 9
    '{"participant":[{}],"diagnosis":[{"condition":"flu"}]}',                   # 10
    '{"participant":[{"individual":{"a":1}}],"diagnosis":[{"condition":"flu"}]}',  # 11
    L1 + ' trailing',                                                            # 12
]
GOOD = {1: ("7", "flu"), 5: ("true", "1.5"), 9: ("7", "flu"), 11: ('{"a":1}', "flu"), 12: ("7", "flu")}


def _pairs(df):
    return sorted((r.practitioner, r.diagnosis) for r in df.collect())


def test_quarantine_keeps_only_well_formed(spark):
    df = extract.encounters(lines_df(spark, FIXTURE))
    assert _pairs(df) == sorted(GOOD.values())


def test_sentinel_maps_malformed_to_zero(spark):
    df = extract.encounters(lines_df(spark, FIXTURE), on_malformed="sentinel")
    want = sorted(list(GOOD.values()) + [("0", "0")] * (len(FIXTURE) - len(GOOD)))
    assert _pairs(df) == want


def test_rejects_are_the_other_lines(spark):
    rej = extract.rejects(lines_df(spark, FIXTURE)).collect()
    bad = {i + 1 for i, v in enumerate(FIXTURE)} - set(GOOD)
    assert sorted(r.value for r in rej) == sorted(FIXTURE[i - 1] for i in bad)
    assert {r.module for r in rej} == {"encounter"}
    assert {r.file_path for r in rej} == {"mem"}


def test_patient_reading_requires_subject(spark):
    df = extract.encounters(lines_df(spark, FIXTURE), require_patient=True)
    assert sorted((r.practitioner, r.diagnosis, r.patient) for r in df.collect()) == sorted(
        [("7", "flu", "1"), ("7", "flu", "2"), ("7", "flu", "1")])


def test_blank_diagnosis_is_malformed(spark):
    df = extract.encounters(lines_df(spark, ['{"participant":[{"individual":"1"}],"diagnosis":[{"condition":" "}]}']))
    assert df.count() == 0


def test_practitioners(spark):
    good = ('{"identifier":"3","name":"ana reyes","telecom":"areyes@a.example",'
            '"qualification":[{"identifier":"st. orla\'s clinic"}]}')
    lines = [good, '{"identifier":"4","name":"x","telecom":"y","qualification":[]}', "nope"]
    df = extract.practitioners(lines_df(spark, lines))
    assert [tuple(r) for r in df.collect()] == [("3", "ana reyes", "areyes@a.example", "st. orla's clinic")]
    assert extract.rejects(lines_df(spark, lines), module="practitioner").count() == 2
    sent = extract.practitioners(lines_df(spark, lines), on_malformed="sentinel").collect()
    assert sorted(r.practitioner for r in sent) == ["0", "0", "3"]


def test_parse_happens_once_per_line(spark, capsys):
    """The malformed filter must not re-inline from_json into other nodes."""
    extract.encounters(lines_df(spark, FIXTURE)).explain("formatted")
    plan = capsys.readouterr().out
    physical = plan.split("== Physical Plan ==")[-1].split("\n\n(")[0]
    assert physical.count("Generate") == 1
    assert plan.count("from_json(") == 1


def test_latest_practitioner_record_per_id(spark):
    rows = [('{"identifier":"3","name":"old name","telecom":"o@x","qualification":[{"identifier":"h1"}]}', "a/f1"),
            ('{"identifier":"3","name":"new name","telecom":"n@x","qualification":[{"identifier":"h2"}]}', "a/f2"),
            ('{"identifier":"4","name":"solo","telecom":"s@x","qualification":[{"identifier":"h3"}]}', "a/f1")]
    lines = spark.createDataFrame(rows, "value string, file_path string")
    got = sorted(map(tuple, extract.practitioners(lines, duplicates="latest").collect()))
    assert got == [("3", "new name", "n@x", "h2"), ("4", "solo", "s@x", "h3")]
    assert extract.practitioners(lines).count() == 3
