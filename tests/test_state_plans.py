import random

import pytest
from pyspark.sql import functions as F

from quirework.operators import fold, matching, planning, reporting, retry, validate
from quirework.plans.engine_queries import job_events
from quirework.schemas import EVENTS, JOBS, JOBS_LEGACY
from quirework.streaming.jobs import apply_event, counts_by_window, event_stream, fold_stream


def event(seq, op, key="a", size=1, mtime=1, **more):
    e = dict.fromkeys(EVENTS.fieldNames()) | {"source_path": key, "stage": "ocr", "seq": seq, "op": op, "size": size, "mtime_ns": mtime, "at": f"t{seq}"}
    return e | more


def folded(spark, events):
    rows = fold.fold(spark.createDataFrame([tuple(e[f] for f in EVENTS.fieldNames()) for e in events], EVENTS)).collect()
    return {r["source_path"]: r.asDict() for r in rows}


def test_report_fixture(spark):
    events = [
        event(1, "started", "a.png", worker="pid-1", device="cpu"), event(2, "success", "a.png", result="a.json", duration_s=1.5),
        event(3, "started", "b.png", worker="pid-2"), event(4, "failure", "b.png", err_class="ValueError", err_msg="bad page", duration_s=2.0), event(5, "failure", "b.png", err_class="ValueError", err_msg="bad page again", duration_s=2.5),
        event(6, "started", "c.pdf"),
    ]
    got = folded(spark, events)
    assert {k: v["status"] for k, v in got.items()} == {"a.png": "success", "b.png": "failed", "c.pdf": "running"}
    assert got["b.png"]["retry_count"] == 2 and got["b.png"]["error_message"] == "bad page again" and got["a.png"]["intended"] == "a.json" and got["a.png"]["profile"] is None
    rows = [(k, "render" if k == "c.pdf" else "ocr", 1, 1, v["status"], v["result_path"], v["retry_count"], v["error_class"], None, None, None, None, None, v["duration_s"], v["intended"], v["profile"]) for k, v in got.items()]
    jobs = spark.createDataFrame(rows, JOBS)
    t = reporting.totals(jobs).first()
    assert (t["total"], t["retry_total"], t["duration_total_s"]) == (3, 2, 4.0)
    assert {r["error_class"]: r["n"] for r in reporting.error_classes(jobs).collect()} == {"ValueError": 1}
    assert reporting.stage_status_map(jobs).first()["by_stage"] == {"ocr": {"failed": 1, "success": 1}, "render": {"running": 1}}
    assert reporting.totals(jobs.where("false")).first()["retry_total"] == 0
    assert reporting.jobs_page(jobs, limit=1, offset=1).first()["source_path"] == "b.png" and reporting.matching(jobs, status="failed") == 1
    for bad in ({"limit": 0}, {"limit": True}, {"offset": -1}, {"limit": 10_001}, {"status": "odd"}, {"stage": " "}):
        with pytest.raises(ValueError):
            reporting.jobs_page(jobs, **bad)
    old = reporting.with_all_columns(jobs.select(JOBS_LEGACY.fieldNames()), backfill=True)
    assert old.columns == JOBS.fieldNames() and old.where("intended_result_path = 'a.json'").count() == 1


def test_resets_and_learning(spark):
    got = folded(spark, [
        event(1, "failure", "src", err_class="E"), event(2, "success", "src", result="r"), event(3, "needs_run", "src", size=2),
        event(1, "success", "legacy", result="r"), event(2, "needs_run", "legacy", req_result="r", req_profile="p"),
        event(1, "needs_run", "learn"), event(2, "needs_run", "learn", req_result="r", req_profile="p"), event(3, "needs_run", "learn", req_profile="other"),
        event(1, "failure", "keep", req_result="r", req_profile="p"), event(2, "needs_run", "keep", req_result="r", req_profile="p"),
    ])
    assert (got["src"]["status"], got["src"]["retry_count"], got["src"]["result_path"]) == ("pending", 0, None)
    assert (got["legacy"]["status"], got["legacy"]["intended"], got["legacy"]["profile"]) == ("success", "r", None)
    assert (got["learn"]["status"], got["learn"]["intended"], got["learn"]["profile"]) == ("pending", "r", "other")
    assert (got["keep"]["status"], got["keep"]["retry_count"], got["keep"]["profile"]) == ("failed", 1, "p")


def random_events(n):
    rng = random.Random(7)
    pick = lambda *x: rng.choice(x)
    return [
        event(i, pick("needs_run", "started", "success", "failure"), f"k{rng.randint(0, 25)}", size=pick(1, 1, 1, 2), mtime=pick(1, 1, 1, 2), req_result=pick(None, "r", "r", "s"), req_profile=pick(None, "p", "p", "q"), result=pick("r", "s", None), worker=pick("w", None), device="cpu", err_class="E", err_msg=f"m{i}", duration_s=float(i))
        for i in range(n)
    ]


def expected(events):
    state = {}
    for e in sorted(events, key=lambda e: e["seq"]):
        state[e["source_path"]] = apply_event(state.get(e["source_path"]), e)
    return state


def test_fold_equals_the_rules_in_plain_python(spark):
    events = random_events(700)
    got = folded(spark, random.Random(1).sample(events, len(events)))
    assert {k: {f: v[f] for f in fold.FIELDS} for k, v in got.items()} == expected(events)
    assert folded(spark, []) == {}


def test_stream_equals_batch(spark, tmp_path):
    events = random_events(120)
    for i in range(3):
        part = [tuple(e[f] for f in EVENTS.fieldNames()) for e in events[i * 40 : i * 40 + 40]]
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    last = {}

    def keep(df, _):
        last.update({r["source_path"]: r.asDict() for r in df.collect()})

    q = fold_stream(event_stream(spark, str(tmp_path / "in"), 1)).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = expected(events)
    assert {k: {f: v[f] for f in fold.FIELDS} for k, v in last.items()} == {k: {f: v[f] for f in fold.FIELDS} for k, v in want.items()}


def test_events_of_job_rows(spark):
    rows = [(1, 1, "a", "ocr", 5, 5, "failed", None, 1, "E", "m", "w", "d", "s", "f", 1.0, "t", "p")]
    cols = "job_row_id bigint, run_no int, source_path string, stage string, source_size bigint, source_mtime_ns bigint, status string, result_path string, retry_count bigint, error_class string, error_message string, worker string, device string, started_at string, finished_at string, duration_s double, intended_result_path string, execution_profile_json string"
    assert [r["op"] for r in job_events(spark.createDataFrame(rows, cols)).orderBy("seq").collect()] == ["started", "failure"]


@pytest.mark.parametrize(
    "facts,want",
    [
        (dict(exists=True, valid=True, known=False, needs=True), ("skipped", 1)), (dict(exists=True, valid=False, known=False, needs=True, overwrite=True), ("failed", 2)),
        (dict(exists=True, valid=True, known=True, needs=False), ("skipped", 3)), (dict(exists=True, valid=False, known=True, needs=False, overwrite=True), ("failed", 4)),
        (dict(exists=True, valid=True, known=True, needs=True), ("failed", 5)), (dict(exists=True, valid=True, known=False, needs=True, resume=False), ("failed", 6)),
        (dict(exists=True, valid=True, known=True, needs=True, overwrite=True), ("run", 7)), (dict(exists=False, valid=False, known=False, needs=True), ("run", 7)),
        (dict(exists=True, valid=True, known=False, needs=True, tracked=False), ("skipped", 3)),
    ],
)
def test_ocr_decisions(spark, facts, want):
    d = spark.range(1).select(planning.ocr_decision(**facts).alias("d")).first()["d"]
    assert (d["outcome"], d["rule"]) == want


def test_needs_run(spark):
    rows = [("success", None, False, False), ("success", "r", True, False), ("success", "r", False, True), ("failed", None, False, True), (None, None, False, True)]
    df = spark.createDataFrame(rows, "s string, r string, e boolean, want boolean").select(planning.needs_run("s", "r", "e").alias("n"), "want")
    assert all(r["n"] == r["want"] for r in df.collect())
    res = spark.createDataFrame([("d1", "skipped"), ("d1", "success"), ("d2", "skipped")], "doc string, status string")
    assert {r["doc"]: r["force"] for r in planning.must_rebuild(res, "doc").collect()} == {"d1": True, "d2": False}


def test_sequences_and_sides(spark):
    pages = [("ok", 1), ("ok", 2), ("gap", 1), ("gap", 3), ("dup", 1), ("dup", 1), ("zero", 0), ("far", 15), ("nulls", None), ("nulls", 1)]
    got = {r["d"]: (r["status"], r["missing"]) for r in validate.page_sequences(spark.createDataFrame(pages, "d string, p int"), "d", "p").collect()}
    assert got == {"ok": ("ok", ""), "gap": ("gap", "2"), "dup": ("duplicate", ""), "zero": ("invalid", "1"), "far": ("gap", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10..."), "nulls": ("ok", "")}
    a, b = spark.createDataFrame([(1,), (2,)], "p int"), spark.createDataFrame([(2,), (3,), (3,)], "p int")
    assert {tuple(r) for r in validate.expected_against_actual(a, b, ["p"]).collect()} == {(1, "missing"), (3, "extra")}


def test_matching(spark):
    images = spark.createDataFrame([("d", "page_0001.png"), ("d", "cover.png"), ("e", "page_0001.png")], "dir string, name string")
    results = spark.createDataFrame([("d", "page_0001_result.json"), ("d", "page_00001.json"), ("d", "cover_ocr.json"), ("d", "cover.json")], "dir string, name string")
    assert {(r["dir"], r["name"]): r["result_name"] for r in matching.match_results(images, results).collect()} == {("d", "page_0001.png"): "page_00001.json", ("d", "cover.png"): "cover.json", ("e", "page_0001.png"): None}
    assert [r["dir"] for r in matching.missing_results(images, results).collect()] == ["e"]
    files = spark.createDataFrame([("r", "same.png"), ("r", "same.jpg"), ("r", "a/b/page_2.JPG"), ("r", "ignore.txt")], "root string, rel string")
    tasks = matching.image_tasks(files, "/out")
    assert {r["output_json"] for r in tasks.collect()} == {"/out/same_result.json", "/out/a/b/page_2_result.json"}
    assert [r["rel"] for r in matching.output_collisions(tasks).collect()] == ["same.png"]
    paths = spark.createDataFrame([("/a/b/c",), ("/a/bc",), ("/a/b",), (None,)], "path string")
    roots = spark.createDataFrame([("/a/b/",), ("/zz",)], "root string")
    assert {r["path"] for r in matching.within_roots(paths, roots).collect()} == {"/a/b/c", "/a/b"}


OCR = '{"schema":2,"kind":"paddlex_ocr","pipeline":{"type":"file","path":"/p","sha256":"%s","size":1},"device":"cpu","engine":null,"use_hpip":null,"predict":{"use_doc_orientation_classify":false,"use_doc_unwarping":false,"use_textline_orientation":true}}' % ("a" * 64)


def test_retry_reasons(spark):
    rows = [
        ("/in/a.png", "/out/a_result.json", OCR, None), ("/in/a.png", "/out/b.json", OCR, "not where"), ("/in/gone.png", "/out/x", OCR, "gone"), ("/in/a.png", "/out/there.json", OCR, "already"),
        ("/in/a.png", None, OCR, "no target"), ("/in/a.png", "/elsewhere/x", OCR, "outside the output"), ("/in/a.png", "/out/a_result.json", "[]", "no object"), ("/in/a.png", "/out/a_result.json", OCR.replace('"cpu"', '"gpu"'), "explicit"),
        ("/in/a.png", "/out/a_result.json", OCR.replace('"size":1', '"size":true'), "size"), ("/in/link/a.png", "/out/l", OCR, "link"), ("/in/a.png", "/out", OCR, "itself"),
    ]
    jobs = spark.createDataFrame([(s, "ocr", 5, 5, "failed", t, p, i) for i, (s, t, p, _) in enumerate(rows)], "source_path string, stage string, source_size bigint, source_mtime_ns bigint, status string, intended_result_path string, execution_profile_json string, i int")
    files = spark.createDataFrame([("/in/a.png", False, False, 5, 5), ("/out/there.json", False, False, 1, 1), ("/in/link", False, True, 0, 0), ("/in/link/a.png", False, False, 5, 5)], "path string, is_dir boolean, is_symlink boolean, size bigint, mtime_ns bigint")
    got = {r["i"]: (r["reason"], r["state"]) for r in retry.plan(jobs, files, "/out", ["/in"]).collect()}
    for i, (*_, want) in enumerate(rows):
        assert (got[i][0] is None) if want is None else want in got[i][0], (i, got[i])
    assert got[0][1] == "eligible" and got[3][1] == "blocked" and got[1][1] == "ineligible"
    assert retry.plan(jobs.where("i = 3"), files, "/out", ["/in"], overwrite=True).first()["state"] == "ineligible"  # blocked hid another reason
    now = jobs.withColumn("source_size", F.when(F.col("i") == 0, 6).otherwise(F.col("source_size")))
    assert [r["change"] for r in retry.revalidate(jobs.where("i = 0"), now.where("i = 0")).collect()] == ["source changed"]


def test_windowed_counts_drop_what_is_too_late(spark, tmp_path):
    times = [["2025-01-01T00:00:00+00:00", "2025-01-01T00:05:00+00:00"], ["2025-01-01T05:00:00+00:00"], ["2025-01-01T00:01:00+00:00", "2025-01-01T09:00:00+00:00"]]
    for i, part in enumerate(times):
        rows = [tuple(event(j, "started", at=t)[f] for f in EVENTS.fieldNames()) for j, t in enumerate(part)]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = counts_by_window(event_stream(spark, str(tmp_path / "in"), 1)).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    got = {str(r["window"]["start"]): r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["2025-01-01 00:00:00"] == 2 and got.get("2025-01-01 05:00:00") == 1  # the late event of 00:01 is gone
