import random

import pytest
from pyspark.sql import functions as F

from quirework.functions import profiles
from quirework.operators import folders, placement, progress, validate
from quirework.safety import canonical_profile


def test_sequences_against_brute_force(spark):
    rng = random.Random(4)
    docs = {f"d{i}": [rng.randint(-1 if i % 9 == 0 else 1, rng.choice([5, 40, 9000])) for _ in range(rng.randint(1, 30))] for i in range(60)} | {"far": [10**12], "hot": list(range(1, 9001))}
    df = spark.createDataFrame([(d, p) for d, ps in docs.items() for p in ps], "d string, p bigint")
    got = {r["d"]: r for r in validate.page_sequences(df, "d", "p").collect()}
    for d, ps in docs.items():
        last, have = max(ps), set(ps)
        first_gaps, n = [], 0
        while len(first_gaps) < 11 and n < max(last, 1):
            n += 1
            if n not in have:
                first_gaps.append(n)
        want = "invalid" if min(ps) < 1 else "duplicate" if len(have) < len(ps) else "gap" if first_gaps else "ok"
        text = ", ".join(map(str, first_gaps[:10])) + ("..." if len(first_gaps) > 10 else "")
        assert (got[d]["status"], got[d]["missing"], got[d]["n_pages"], got[d]["last_page"]) == (want, text, len(have), last), d
    assert validate.page_sequences(df.where("false"), "d", "p").count() == 0


def test_folders(spark):
    files = spark.createDataFrame([("a", "page_1.png"), ("a", "page_003.JPG"), ("a", "notes.txt"), ("b", "page_00001.png"), ("b", "page_1.jpg"), ("c", "cover.png")], "dir string, name string")
    assert {r["dir"]: (r["status"], r["missing"]) for r in folders.image_sequences(files).collect()} == {"a": ("gap", "2"), "b": ("duplicate", "")}
    assert {r["dir"] for r in folders.folders_with_images(files).collect()} == {"a", "b", "c"}
    results = spark.createDataFrame([("a", "page_1_x_result.json"), ("a", "page_1_result.json"), ("b", "page_1.json")], "dir string, name string")
    got = {(r["dir"], r["name"]): r["result"] for r in folders.result_by_stem(files, results).collect()}
    assert got["a", "page_1.png"] == "page_1_result.json" and got["b", "page_1.jpg"] is None
    names = spark.createDataFrame([("K12_3_ab", 7), ("K12345_1234_x", 100), ("plain", 1)], "f string, p int")
    assert [r["n"] for r in names.select(folders.expected_name_by_folder("f", F.col("p")).alias("n")).collect()] == ["0012_003_ab_07.json", "12345_1234_x_100.json", None]
    books = folders.books_to_build(spark.createDataFrame([("/j/a",), ("/j/b",), ("/j/c",)], "dir string"), spark.createDataFrame([("/i/a",), ("/i/b",)], "dir string"), spark.createDataFrame([("/j/b",)], "dir string"), "/j", "/i")
    assert {r["dir"]: r["state"] for r in books.collect()} == {"/j/a": "build", "/j/b": "done", "/j/c": "no images"}
    logs = spark.createDataFrame([("x", i) for i in range(9)] + [("y", 1)], "k string, n int")
    assert sorted(tuple(r) for r in folders.last_lines(logs, "k", "n").collect()) == [("x", 6), ("x", 7), ("x", 8), ("y", 1)]


def test_placement(spark):
    box = lambda x0, y0, x1, y1: [(float(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    rows = [(1, 0, "right", 100, box(60, 10, 90, 20)), (1, 1, "left", 100, box(10, 30, 40, 40)), (1, 2, " ", 100, box(0, 0, 9, 9)), (1, 3, "flat", 100, box(10, 50, 40, 50))]
    df = spark.createDataFrame(rows, "page_id int, line_no int, text string, width int, polygon array<struct<x:double,y:double>>")
    got = {r["text"]: r for r in placement.placement(df, ["page_id"], y_offset=2).collect()}
    assert set(got) == {"right", "left", "flat"} and got["left"]["reading_no"] == 1 and got["right"]["reading_no"] == 3
    assert got["flat"]["error"] and got["flat"]["font_size"] is None
    assert got["left"]["font_size"] == pytest.approx(7.0) and got["left"]["baseline"] == pytest.approx(32 + 0.85 * 7.0)
    plain = {r["text"]: r["baseline"] for r in placement.placement(df, ["page_id"], ordered=False).collect()}
    assert plain["right"] == 10.0
    chars = spark.createDataFrame([(1, ["a", "b", "c"], [[0.0, 0.0, 9.0, 0.0, 9.0, 8.0, 0.0, 8.0], [1.0, 1.0, 5.0, 5.0], [1.0, 2.0, 3.0]], 10.0, 20.0), (2, ["a", "b"], [[1.0, 1.0, 5.0, 5.0]], 10.0, 20.0), (3, ["a"], None, 10.0, 20.0)], "doc int, chars array<string>, coors array<array<double>>, Width double, Height double")
    boxes = placement.char_placement(chars, ["doc"], "extent", F.lit(20.0), F.lit(20.0), x_offset=1.0).collect()
    assert sorted(tuple(r) for r in placement.uneven_pages(chars, ["doc"]).collect()) == [(2, 2, 1), (3, 1, None)]
    assert [(r["char"], r["x0"], r["x1"], r["y1"]) for r in boxes] == [("a", 1.0, 19.0, 8.0), ("b", 3.0, 11.0, 5.0)]


def test_profiles(spark):
    row = spark.range(1).select(profiles.render_profile(144).alias("r"), profiles.searchable_profile("/i", "/o", 3).alias("s"), profiles.ocr_profile("/p", 5, "ab", None, engine="é").alias("o")).first()
    assert row["r"] == canonical_profile({"schema": 1, "kind": "pdf_render", "dpi": 144, "format": "png", "alpha": False})
    assert row["s"] == canonical_profile({"schema": 2, "kind": "searchable_pdf", "fontname": "china-s", "y_offset": 0.0, "layout": "legacy-v7", "images_dir": "/i", "ocr_json_dir": "/o", "expected_page_count": 3})
    assert row["o"] == canonical_profile({"schema": 2, "kind": "paddlex_ocr", "pipeline": {"type": "file", "path": "/p", "size": 5, "sha256": "ab"}, "device": "auto", "engine": "é", "use_hpip": None, "predict": {"use_doc_orientation_classify": False, "use_doc_unwarping": False, "use_textline_orientation": False}})
    texts = ['{"b": 1.50, "a": [1, 2]}', "[1]", "{", None]
    got = [r["c"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(profiles.canonical("t").alias("c")).collect()]
    assert got == ['{"a":[1,2],"b":1.5}', None, None, None]
    devices = ["cpu", "GPU:3", "gpu:x", "auto", "", None]
    assert [r["v"] for r in spark.createDataFrame([(x,) for x in devices], "d string").select(profiles.valid_device("d").alias("v")).collect()] == [True, True, False, True, False, None]


def test_progress_and_chunks(spark):
    rows = [("r", i, f"2025-01-01 00:00:{i:02d}", i % 4 == 0, 7) for i in range(7)]
    df = spark.createDataFrame(rows, "run string, i int, at string, is_error boolean, total int").withColumn("ended_at", F.to_timestamp("at"))
    got = [tuple(r) for r in progress.progress(df, "run", ["ended_at"], "total", every=3).select("done", "errors", "elapsed_s", "remaining").orderBy("done").collect()]
    assert got == [(3, 1, 2.0, 4), (6, 2, 5.0, 1), (7, 2, 6.0, 0)]
    pages = spark.createDataFrame([("d", i) for i in range(120)], "doc string, page int")
    assert {r["chunk_id"]: r["count"] for r in progress.chunks(pages, "doc", "page").groupBy("chunk_id").count().collect()} == {0: 50, 1: 50, 2: 20}
    summary = spark.createDataFrame([("a", 1.0, True), ("a", 2.0, False), ("b", None, False)], "f string, duration_s double, is_error boolean")
    assert sorted((str(r["f"]), r["pages"], r["duration_s"], r["errors"]) for r in progress.folder_summary(summary, "f").collect()) == [("None", 3, 3.0, 1), ("a", 2, 3.0, 1)]
