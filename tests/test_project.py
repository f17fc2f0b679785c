import json

import numpy as np
import pytest

from quirework import adapters, cli, stages
from quirework.plans import project
from pyspark.sql import functions as F


class Result:
    def __init__(self, data):
        self.json = data


class Pipeline:
    def __init__(self, device=None):
        self.device = device

    def predict(self, input):
        return [Result({"res": {"rec_texts": np.array(["a"]), "rec_polys": np.zeros((1, 4, 2)), "page_index": None}})]


def test_adapters(tmp_path):
    r = adapters.PipelineRecogniser(Pipeline, device="cpu", engine=None)
    assert r.options == {"device": "cpu"} and r.predict("x") == [{"rec_texts": ["a"], "rec_polys": [[[0.0, 0.0]] * 4], "page_index": None}]
    assert adapters.page_of({"rec_text": [], "res": {"x": 1}}) == {"rec_text": [], "res": {"x": 1}}
    for bad, where in (({"a": {1: 2}}, "$.a"), ({"a": [object()]}, "$.a[0]")):
        with pytest.raises(TypeError, match=where.replace("$", r"\$").replace("[", r"\[")):
            adapters.json_safe(bad)
    (tmp_path / "p.yaml").write_text("model: A")
    one = adapters.pipeline_identity(str(tmp_path / "p.yaml"))
    assert one["type"] == "file" and len(one["sha256"]) == 64 and adapters.pipeline_identity("fast") == {"type": "name", "value": "fast"}
    with pytest.raises(FileNotFoundError):
        adapters.pipeline_identity(tmp_path / "none")
    with pytest.raises(ValueError):
        adapters.predict_flags({"use_doc_unwarping": "yes"})
    assert adapters.cpu_config({"Global": {"use_gpu": True, "x": 1}}) == {"Global": {"device": "cpu", "x": 1}}


def run(spark, tmp_path, engine=None, profile="p1", **options):
    out = project.recognise_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "events"), engine or stages.FakeRecogniser(), profile, **options)
    return {r["source"].rsplit("/", 1)[-1]: (r["status"], r["error"]) for r in out.collect()}


def test_runs_resume_and_refuse(spark, tmp_path):
    (tmp_path / "in" / "sub dir").mkdir(parents=True)
    for name in ("a.png", "bad.png", "sub dir/c é.JPG", "notes.txt"):
        (tmp_path / "in" / name).write_bytes(b"x")
    first = run(spark, tmp_path, stages.FakeRecogniser(fail="bad"))
    assert {k: s for k, (s, _) in first.items()} == {"a.png": "success", "bad.png": "failed", "c é.JPG": "success"}
    assert json.loads((tmp_path / "out" / "sub dir" / "c é_result.json").read_text())["rec_texts"] == ["c é.JPG"]
    second = run(spark, tmp_path)
    assert {k: s for k, (s, _) in second.items()} == {"a.png": "skipped", "bad.png": "success", "c é.JPG": "skipped"}
    state = {r["source_path"].rsplit("/", 1)[-1]: r for r in project.state(spark, str(tmp_path / "events")).collect()}
    assert state["bad.png"]["retry_count"] == 1 and {r["status"] for r in state.values()} == {"success"}
    # another profile makes the results stale; overwriting makes them anew
    third = run(spark, tmp_path, profile="p2")
    assert {s for s, _ in third.values()} == {"failed"} and "stale" in third["a.png"][1]
    assert {s for s, _ in run(spark, tmp_path, profile="p2", overwrite=True).values()} == {"success"}
    # a changed source and a damaged result
    (tmp_path / "in" / "a.png").write_bytes(b"longer")
    (tmp_path / "out" / "bad_result.json").write_text("{")
    fourth = run(spark, tmp_path, profile="p2")
    assert fourth["a.png"][0] == "failed" and "invalid" in fourth["bad.png"][1] and fourth["c é.JPG"][0] == "skipped"
    outcomes = spark.createDataFrame([("d/1", "success"), ("d/2", "skipped"), ("e/1", "failed")], "source string, status string")
    assert project.tally(outcomes) == {"success": 1, "skipped": 1, "failed": 1}
    assert {r["doc"]: r["force"] for r in project.documents_to_rebuild(outcomes, F.substring("source", 1, 1)).collect()} == {"d": True, "e": False}


def test_adoption_and_collisions(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    (tmp_path / "in" / "a.png").write_bytes(b"x")
    (tmp_path / "out" / "a_result.json").write_text('{"rec_texts": [], "dt_polys": []}')
    assert run(spark, tmp_path)["a.png"][0] == "skipped"
    row = project.state(spark, str(tmp_path / "events")).first()
    assert row["status"] == "success" and row["profile"] is None  # adopted: its profile is unknown
    (tmp_path / "in" / "a.jpg").write_bytes(b"x")
    with pytest.raises(ValueError, match="one result"):
        run(spark, tmp_path)


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.png").write_bytes(b"x")
    call = ["ocr", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--events", str(tmp_path / "ev"), "--engine", "quirework.stages:FakeRecogniser"]
    assert cli.main(call) == 0 and json.loads(capsys.readouterr().out) == {"success": 1, "skipped": 0, "failed": 0}
    assert cli.main(call) == 0 and json.loads(capsys.readouterr().out)["skipped"] == 1
    assert cli.main(["doctor", str(tmp_path)]) == 0 and json.loads(capsys.readouterr().out)["writable"]
