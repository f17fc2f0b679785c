import json
import os
import sqlite3
import struct
import zlib

import pandas as pd
import pytest

from quirework import cli, safety, sinks, stages
from quirework.operators import compaction
from quirework.schemas import JOBS
from quirework.sources import files, jobs


def png(w, h):
    head = b"IHDR" + struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + head + struct.pack(">I", zlib.crc32(head))


def test_listing_sees_everything(spark, tmp_path):
    for name in ("a.png", "_hidden.png", ".dot.png", "sub/b.PNG", "sub/deep/c.json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name == "a.png" else b"x")
    os.symlink(tmp_path / "a.png", tmp_path / "link.png")
    rows = {r["rel"]: r for r in files.list_files(spark, [str(tmp_path), "/nowhere/at/all"]).collect()}
    assert {"a.png", "_hidden.png", ".dot.png", "sub/b.PNG", "sub/deep/c.json", "link.png", "sub", "sub/deep"} == set(rows)
    assert rows["link.png"]["is_symlink"] and rows["sub"]["is_dir"] and rows["a.png"]["size"] == 0
    assert rows["sub/b.PNG"]["mtime_ns"] == os.stat(tmp_path / "sub/b.PNG").st_mtime_ns
    assert files.list_files(spark, ["/nowhere"]).count() == 0


def test_image_sizes(spark):
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 7, 9) + b"\x01\x01\x11\x00\xff\xd9"
    bmp = b"BM" + b"\0" * 16 + struct.pack("<ii", 5, -6)
    tiff = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 2) + struct.pack("<HHII", 256, 3, 1, 11) + struct.pack("<HHII", 257, 4, 1, 12)
    data = [png(640, 480), jpeg, bmp, tiff, b"nothing", b"", None]
    got = [r["s"] and tuple(r["s"]) for r in spark.createDataFrame([(i, d) for i, d in enumerate(data)], "i int, c binary").select("i", files.image_size("c").alias("s")).orderBy("i").collect()]
    assert got == [(640, 480), (9, 7), (5, 6), (11, 12), None, None, None]


def test_sqlite_jobs_are_only_read(spark, tmp_path):
    path = str(tmp_path / "m.sqlite3")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE jobs (source_path TEXT, stage TEXT, source_size INTEGER, source_mtime_ns INTEGER, status TEXT, retry_count INTEGER, duration_s REAL)")
    con.executemany("INSERT INTO jobs VALUES (?, 'ocr', ?, ?, 'failed', 1, NULL)", [(f"s{i}", i, 1_700_000_000_123_456_789 + i) for i in range(25)])
    con.commit()
    con.close()
    before = open(path, "rb").read()
    df = jobs.read_sqlite_jobs(spark, path, rows_per_task=10)
    assert df.columns == JOBS.fieldNames() and df.count() == 25
    r = jobs.job(df, "s7", "ocr").first()
    assert r["source_mtime_ns"] == 1_700_000_000_123_456_796 and r["execution_profile_json"] is None and r["duration_s"] is None
    assert open(path, "rb").read() == before
    os.symlink(path, tmp_path / "link.sqlite3")
    for bad in (str(tmp_path / "link.sqlite3"), str(tmp_path), str(tmp_path / "none")):
        with pytest.raises(ValueError):
            jobs.read_sqlite_jobs(spark, bad)
    assert not (tmp_path / "none").exists()


def test_atomic_writes(spark, tmp_path):
    p = str(tmp_path / "d" / "x.json")
    sinks.write_json(p, {"k": "新"})
    assert open(p, encoding="utf-8").read() == '{\n  "k": "新"\n}\n'
    with pytest.raises(FileExistsError):
        sinks.write_json(p, {})
    sinks.write_json(p, [1], overwrite=True)
    os.symlink(p, tmp_path / "l.json")
    with pytest.raises(ValueError):
        sinks.write_json(str(tmp_path / "l.json"), {}, overwrite=True)
    assert os.listdir(tmp_path / "d") == ["x.json"]
    rows = spark.createDataFrame([(str(tmp_path / f"{i}.txt"), f"t{i}") for i in range(3)] + [(str(tmp_path / "l.json"), "no")], "p string, t string")
    for _ in range(2):  # a task that runs again meets its own files
        assert sorted(r["status"] for r in sinks.publish_rows(rows, "p", "t").collect()) == ["failed", "success", "success", "success"]
    new, old = tmp_path / "new", tmp_path / "old"
    for d in (new, old):
        d.mkdir()
        (d / "f").write_text(d.name)
    with pytest.raises(FileExistsError):
        sinks.replace_folder(str(new), str(old))
    sinks.replace_folder(str(new), str(old), overwrite=True)
    assert (old / "f").read_text() == "new" and not new.exists()
    assert sinks.trailing_number("chunk_12.pdf") == 12


def test_cache_is_cleaned_only_when_told(tmp_path):
    (tmp_path / "temp" / "x").mkdir(parents=True)
    assert sinks.clean_cache(str(tmp_path))["executed"] is False and (tmp_path / "temp" / "x").exists()
    sinks.clean_cache(str(tmp_path), execute=True)
    assert (tmp_path / "temp").exists() and not (tmp_path / "temp" / "x").exists()
    for target, root in (("/", "/"), (str(tmp_path), "/"), ("/etc", str(tmp_path)), (str(tmp_path), str(tmp_path))):
        with pytest.raises(ValueError):
            safety.check_removable(target, root)


def test_configuration(tmp_path):
    base = {"input_sources": [{"path": str(tmp_path / "in"), "type": "image"}], "output_root": str(tmp_path / "out"), "log_dir": str(tmp_path / "log"), "cache_root": str(tmp_path / "cache"), "runtime": {"device": "GPU:1"}}
    p = safety.project(base)
    assert p.runtime.device == "gpu:1" and p.resume and p.manifest_path == str(tmp_path / "log" / "jobs.parquet")
    for change in ({"output_root": str(tmp_path / "in" / "x")}, {"cache_root": str(tmp_path / "out" / "c")}, {"overwrite": "yes"}, {"runtime": {"device": "tpu"}}, {"runtime": {"ocr_workers": True}}, {"input_sources": []}, {"input_sources": [{"path": "/x", "type": "doc"}]}):
        with pytest.raises(ValueError):
            safety.project(base | change)
    odd = safety.project(base | {"runtime": None, "overwrite": None, "manifest_path": None, "some_config": "pipe.json", "surplus": 1})
    assert (odd.runtime.batch_size, odd.runtime.device, odd.overwrite, odd.engine_config) == (1, "auto", False, "pipe.json")
    with pytest.raises(ValueError, match="manifest_path"):
        safety.project(base | {"manifest_path": str(tmp_path / "in" / "jobs.parquet")})
    with pytest.raises(ValueError) as all_at_once:
        safety.project({"input_sources": [7, {"path": None, "type": "x"}], "output_root": 5, "runtime": {"batch_size": 0}, "resume": "no"})
    for key in ("input_sources[0]", "input_sources[1].path", "input_sources[1].type", "output_root", "log_dir", "cache_root", "runtime.batch_size", "resume"):
        assert key in str(all_at_once.value)
    for wrong in ([], None, "x", {}):
        with pytest.raises(ValueError):
            safety.project(wrong)
    assert safety.canonical_profile({"b": 1, "a": "é"}) == '{"a":"é","b":1}'


def test_stages_with_stand_ins(spark):
    tasks = spark.createDataFrame([("/in/a.png", "/out/a.json"), ("/in/bad.png", "/out/b.json")], "source string, output_json string")
    got = {r["source"]: r for r in stages.recognise(tasks, stages.FakeRecogniser(fail="bad")).collect()}
    assert got["/in/a.png"]["status"] == "success" and json.loads(got["/in/a.png"]["result_json"])["_provenance"]["polygon_field"] == "rec_polys"
    assert got["/in/bad.png"]["error"].startswith("ValueError")
    assert {r["error"] for r in stages.recognise(tasks, stages.FakeRecogniser(results=2)).collect()} == {"2 results for one image"}
    assert {r["error"] for r in stages.recognise(tasks, stages.FakeRecogniser(setup_error="no model")).collect()} == {"RuntimeError: no model"}
    pages = stages.render(spark.createDataFrame([("d.pdf",)], "source string"), stages.FakeRenderer(3))
    assert sorted(bytes(r["content"]) for r in pages.collect()) == [b"d.pdf#1@144", b"d.pdf#2@144", b"d.pdf#3@144"]
    with pytest.raises(ValueError):
        stages.render(pages, stages.FakeRenderer(), dpi=20)
    placed = spark.createDataFrame([("d", n, 0, f"p{n}") for n in range(1, 121)], "document string, page_no int, line_no int, text string")
    built = {r["chunk_id"]: bytes(r["content"]).decode().split("\n") for r in stages.build(placed, stages.FakeBuilder()).collect()}
    assert [len(built[i]) for i in range(3)] == [50, 50, 20] and built[2][0] == "p101"


def test_command_line(spark, tmp_path, capsys):
    rows = [("/in/a.png", "ocr", 1, 1, "success", "r", 0, None, None, None, None, None, None, 1.5, "t", "{}"), ("/in/b.png", "ocr", 1, 1, "failed", None, 2, "E", "m, \"q\"", None, None, None, None, 2.5, None, None)]
    path = str(tmp_path / "jobs.parquet")
    spark.createDataFrame(rows, JOBS).write.parquet(path)
    assert cli.main(["report", path]) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["status"] == {"failed": 1, "success": 1} and out["retry_total"] == 2 and out["errors"] == {"E": 1}
    assert cli.main(["jobs", path, "--status", "failed", "--csv"]) == 0
    lines = capsys.readouterr().out.strip().split("\n")
    assert lines[0] == ",".join(JOBS.fieldNames()) and len(lines) == 2
    assert cli.main(["jobs", path, "--status", "odd"]) == 2
    sinks.export_csv(spark.createDataFrame(rows, JOBS), str(tmp_path / "csv"))
    assert sorted(pd.concat(pd.read_csv(f) for f in (tmp_path / "csv").glob("*.csv"))["source_path"]) == ["/in/a.png", "/in/b.png"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.PNG").write_bytes(png(1, 1))
    config = {"input_sources": [{"path": str(tmp_path / "in"), "type": "image"}, {"path": str(tmp_path / "none"), "type": "pdf"}], "output_root": str(tmp_path / "out"), "log_dir": str(tmp_path / "log"), "cache_root": str(tmp_path / "cache")}
    (tmp_path / "c.json").write_text(json.dumps(config))
    capsys.readouterr()
    assert cli.main(["scan", str(tmp_path / "c.json")]) == 0
    assert [x.split("\t")[-1] for x in capsys.readouterr().out.strip().split("\n")] == ["1", "0", "1"]
    assert cli.main(["retry-plan", str(tmp_path / "c.json"), "--jobs", path]) == 1
    assert json.loads(capsys.readouterr().out)["counts"] == {"ineligible": 1}


def test_compact_command(spark, tmp_path, capsys):
    tasks = [(1, "s", "/a.json", "success", None, 2, "{}", None), (2, "s", "/./a.json", "success", None, 2, "{}", None)]
    spark.createDataFrame(tasks, "task_id bigint, source string, output_json string, status string, error string, n_bytes bigint, payload string, written_at timestamp").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([], "render_id bigint, source string, output_dir string, page_paths array<string>, page_bytes array<bigint>, page_count int, dpi int, written_at timestamp").write.parquet(str(tmp_path / "r"))
    call = ["compact", str(tmp_path / "t"), str(tmp_path / "r"), str(tmp_path / "out"), "--target-mb", "1"]
    assert cli.main(call) == 0 and capsys.readouterr().out.strip() != "nothing new"
    assert cli.main(call) == 0 and capsys.readouterr().out.strip() == "nothing new"
    assert compaction.read_compacted(spark, str(tmp_path / "out")).count() == 1
