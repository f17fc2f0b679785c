import json

from quirework.operators import drift

SCHEMA = "record_id bigint, feed string, record_kind string, file_no int, line_no int, exported_at timestamp, raw_json string, body string, m int"
NAMES = [("jobs", "source_size", "source_size"), ("jobs", "size_bytes", "source_size"), ("jobs", "status", "status"), ("jobs", "state", "status"), ("jobs", "source_path", "source_path"), ("pages", "rec_texts", "rec_texts"), ("pages", "rec_text", "rec_texts")]


def table(spark, rows):
    return spark.createDataFrame([(i, f, k, n, 0, None, j if j is None or isinstance(j, str) else json.dumps(j), "clash", 1) for i, (f, k, n, j) in enumerate(rows)], SCHEMA)


def names(spark):
    return spark.createDataFrame(NAMES, "record_kind string, spelling string, field_name string")


def found(spark, rows):
    return sorted(tuple(r) for r in drift.changes(drift.file_fields(table(spark, rows), names(spark))).collect())


def test_every_kind_of_change(spark):
    rows = [
        ("f", "jobs", 1, {"source_size": 1, "status": "ok", "note": None}),
        ("f", "jobs", 1, {"source_size": 1, "status": "ok"}),  # delivered twice
        ("f", "jobs", 3, {"size_bytes": "1", "status": None}),  # number 2 is missing
        ("f", "jobs", 3, "{damaged"),
        ("f", "jobs", 4, {"source_size": "2", "status": True, "note": 5}),
        ("f", "jobs", 9, None),
        ("f", "jobs", 10, {"status": True}),
    ]
    assert found(spark, rows) == sorted([
        ("f", 3, "source_size", "renamed"), ("f", 3, "source_size", "retyped"), ("f", 3, "note", "removed"),
        ("f", 4, "source_size", "renamed"), ("f", 4, "status", "retyped"), ("f", 4, "note", "added"),
        ("f", 9, "source_size", "removed"), ("f", 9, "status", "removed"), ("f", 9, "note", "removed"),
        ("f", 10, "status", "added"),
    ])


def test_envelopes_and_kinds(spark):
    rows = [
        ("p", "pages", 1, {"rec_texts": ["a"]}), ("p", "pages", 2, {"res": {"rec_text": ["a"]}}), ("p", "pages", 3, {"res": {"rec_text": "a"}, "other": 1}),
        ("j", "jobs", 1, {"res": {"status": "x"}}), ("j", "jobs", 2, {"res": 5}), (None, "jobs", 1, {"a": 1}), ("j", "jobs", None, {"zz": 1}), ("one", "jobs", 7, {"a": 1}),
    ]
    assert found(spark, rows) == sorted([("p", 2, "rec_texts", "renamed"), ("p", 3, "rec_texts", "removed"), ("p", 3, "res", "added"), ("p", 3, "other", "added"), ("j", 2, "res", "retyped")])


def test_versions(spark):
    rows = [("f", "jobs", 1, {"a": 1}), ("f", "jobs", 2, {"a": "x"}), ("f", "jobs", 3, {"a": 2}), ("f", "jobs", 4, None)]
    got = {r["file_no"]: (r["version"], r["n_fields"]) for r in drift.versions(drift.file_fields(table(spark, rows), names(spark))).collect()}
    assert got == {1: (1, 1), 2: (2, 1), 3: (1, 1), 4: (3, 0)}


def test_unified_table(spark):
    rows = [
        ("f", "jobs", 1, {"source_size": 5, "status": "success", "queue": 3}), ("f", "jobs", 2, {"size_bytes": "7", "state": ["failed"], "source_path": {"root": "/r", "rel": "a/b"}}),
        ("f", "jobs", 3, {"size_bytes": "many", "source_size": None, "status": True}), ("f", "jobs", 4, "{"), ("f", "pages", 1, {"rec_texts": []}),
    ]
    got = [r.asDict() for r in drift.unified(table(spark, rows), names(spark), "jobs").orderBy("record_id").collect()]
    assert [(r["source_size"], r["status"], r["source_path"], r["n_failed"], r["extra"]) for r in got] == [
        (5, "success", None, 0, {"queue": "3"}), (7, "failed", "/r/a/b", 0, {}), (None, "true", None, 1, {}),
    ]
    assert [r["failed"] for r in got] == [[], [], ["source_size"]]


def test_every_failed_cast_is_named_and_lost_files_keep_their_records(spark):
    listed = [*NAMES, ("jobs", "started_at", "started_at"), ("jobs", "begun", "started_at")]
    named = spark.createDataFrame(listed, "record_kind string, spelling string, field_name string")
    rows = [("f", "jobs", 1, {"started_at": "no time", "source_size": {"a": 1}}), (None, "jobs", 1, {"begun": "2025-01-02T03:04:05Z", "size_bytes": 4}), ("f", "jobs", None, {"state": "x"})]
    got = [r.asDict() for r in drift.unified(table(spark, rows), named, "jobs").orderBy("record_id").collect()]
    assert got[0]["failed"] == ["source_size", "started_at"] and got[0]["n_failed"] == 2
    assert got[1]["source_size"] == 4 and got[1]["started_at"] is not None and got[1]["failed"] == [] and got[2]["status"] == "x"


def test_versions_are_stored_once(spark, tmp_path):
    folder = str(tmp_path / "steps")
    rows = [("f", "jobs", n, {"size_bytes": 1, "state": "x"}) for n in (1, 2, 3)] + [("g", "jobs", 1, {"size_bytes": 1, "state": "x"}), ("g", "jobs", 2, {"source_size": 1})]
    fields = drift.file_fields(table(spark, rows), names(spark))
    starts = drift.version_starts(drift.fingerprints(fields)).select("feed", "file_no").collect()
    assert sorted(map(tuple, starts)) == [("f", 1), ("g", 1), ("g", 2)]
    known = drift.store_steps(fields, folder)
    assert known.count() == 3 and drift.store_steps(fields, folder).count() == 3
    more = drift.file_fields(table(spark, [*rows, ("g", "jobs", 3, {"status": 1})]), names(spark))
    assert drift.store_steps(more, folder).select("fingerprint").distinct().count() == 3


def test_empty(spark):
    assert found(spark, []) == []
    assert drift.unified(table(spark, []), names(spark), "jobs").count() == 0
