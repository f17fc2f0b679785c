import hashlib
import json

from quirework import stages
from quirework.functions.profiles import OCR_KIND
from quirework.plans import documents, project
from quirework.safety import canonical_profile
from quirework.session import cut


def profile_for(path):
    data = path.read_bytes()
    pipeline = {"type": "file", "path": str(path), "size": len(data), "sha256": hashlib.sha256(data).hexdigest()}
    flags = {"use_doc_orientation_classify": False, "use_doc_unwarping": False, "use_textline_orientation": False}
    return canonical_profile({"schema": 2, "kind": OCR_KIND, "pipeline": pipeline, "device": "cpu", "engine": None, "use_hpip": None, "predict": flags})


def run(spark, tmp_path, renderer=None, reader=None, **options):
    rows = documents.run_documents(spark, [str(tmp_path / "in")], str(tmp_path / "out"), str(tmp_path / "ev"), renderer or stages.FakeRenderer(3), reader or stages.FakeRecogniser(), stages.FakeBuilder(), "p", **options)
    return {(r["source"].rsplit("/", 1)[-1], r["stage"]): (r["status"], r["error"]) for r in rows.collect()}


def test_documents_from_end_to_end(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name in ("a.pdf", "bad.pdf", "sub/half é.PDF"):
        (tmp_path / "in" / name).write_bytes(b"x")
    first = run(spark, tmp_path, stages.FakeRenderer(3, fail="bad"), stages.FakeRecogniser(fail="half é/pages/page_00002"))
    assert {k: s for k, (s, _) in first.items()} == {
        ("a.pdf", "render"): "success", ("a.pdf", "ocr"): "success", ("a.pdf", "searchable_pdf"): "success",
        ("bad.pdf", "render"): "failed", ("bad.pdf", "searchable_pdf"): "blocked",
        ("half é.PDF", "render"): "success", ("half é.PDF", "ocr"): "failed", ("half é.PDF", "searchable_pdf"): "blocked",
    }
    assert first["bad.pdf", "render"][1].startswith("OSError")
    root = tmp_path / "out" / "source-001" / "pdf"
    assert (root / "a" / "document.pdf").read_text() == "page_00001.png\npage_00002.png\npage_00003.png"
    assert sorted(p.name for p in (root / "a" / "pages").iterdir()) == ["page_00001.png", "page_00002.png", "page_00003.png"] and not (root / "bad" / "pages").exists()
    # what is done is skipped, what failed is done now
    second = run(spark, tmp_path)
    assert {s for k, (s, _) in second.items() if k[0] == "a.pdf"} == {"skipped"}
    assert {s for k, (s, _) in second.items() if k[0] == "bad.pdf"} == {"success"}
    assert {k[1]: s for k, (s, _) in second.items() if k[0] == "half é.PDF"} == {"render": "skipped", "ocr": "success", "searchable_pdf": "success"}
    state = {(r["source_path"].rsplit("/", 1)[-1], r["stage"]): r for r in project.state(spark, str(tmp_path / "ev")).collect()}
    assert {r["status"] for r in state.values()} == {"success"} and state["bad.pdf", "render"]["retry_count"] == 1
    done = state["a.pdf", "render"]
    assert done["started_at"] < done["finished_at"]
    # a page read anew makes its document stale: refused unless it may be overwritten
    (root / "a" / "ocr" / "page_00002_result.json").unlink()
    third = run(spark, tmp_path)
    assert third["a.pdf", "ocr"][0] == "success" and third["a.pdf", "searchable_pdf"][0] == "failed" and "stale" in third["a.pdf", "searchable_pdf"][1]
    assert run(spark, tmp_path, overwrite=True)["a.pdf", "searchable_pdf"][0] == "success"


def test_retries_look_again_before_they_act(spark, tmp_path):
    folder, out, events = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ev")
    folder.mkdir()
    pipe = tmp_path / "pipe.json"
    pipe.write_text("{}")
    for name in ("a.png", "b.png", "gone.png", "good.png"):
        (folder / name).write_bytes(b"x")
    profile = profile_for(pipe)
    project.recognise_folder(spark, str(folder), out, events, stages.FakeRecogniser(fail="in/"), profile).collect()
    plan = lambda: documents.plan_retries(spark, documents.as_jobs(project.state(spark, events)).where("status = 'failed'"), out, [str(folder)])
    planned = cut(plan())
    assert {r["state"] for r in planned.collect()} == {"eligible"}
    # the world moves between the plan and its execution
    (folder / "gone.png").unlink()
    (folder / "b.png").write_bytes(b"longer")
    rows = documents.execute_retries(spark, planned, out, [str(folder)], events, stages.FakeRecogniser(fail="good"))
    got = {r["source_path"].rsplit("/", 1)[-1]: (r["status"], r["error"]) for r in rows.collect()}
    assert got["a.png"] == ("success", None) and got["b.png"] == ("refused", "the source changed in size") and got["gone.png"] == ("refused", "the source is gone")
    assert got["good.png"][0] == "failed" and got["good.png"][1].startswith("ValueError")
    state = {r["source_path"].rsplit("/", 1)[-1]: r for r in project.state(spark, events).collect()}
    assert state["a.png"]["status"] == "success" and state["good.png"]["retry_count"] == 2 and state["b.png"]["retry_count"] == 1
    assert json.loads((tmp_path / "out" / "a_result.json").read_text())["rec_texts"] == ["a.png"]
    # executed again, nothing is left to do for what succeeded meanwhile
    again = {r["source_path"].rsplit("/", 1)[-1]: (r["status"], r["error"]) for r in documents.execute_retries(spark, planned, out, [str(folder)], events, stages.FakeRecogniser()).collect()}
    assert again["a.png"] == ("refused", "no longer failed") and again["good.png"] == ("success", None)
    # a pipeline file that has changed makes its jobs ineligible
    (folder / "c.png").write_bytes(b"x")
    project.recognise_folder(spark, str(folder), out, events, stages.FakeRecogniser(fail="c.png"), profile).collect()
    pipe.write_text("[]")
    late = {r["source_path"].rsplit("/", 1)[-1]: (r["state"], r["reason"]) for r in plan().collect()}
    assert late["c.png"] == ("ineligible", "the pipeline file changed")
