import random

import pytest
from pyspark.sql import functions as F

from quirework.functions import geometry, names, paths


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "name,want",
    [
        ("page_0001.png", ["page_00001.json", "page_0001_result.json", "page_0001.json", "page_001.json"]),
        ("cover-front.jpg", ["cover-front_result.json", "cover-front.json", "cover-front_ocr.json"]),
        ("PAGE_123456.PNG", ["page_123456.json", "page_123456_result.json", "PAGE_123456_result.json", "PAGE_123456.json", "PAGE_123456_ocr.json"]),
    ],
)
def test_candidates(spark, name, want):
    got = one(spark, name, names.candidate_names)
    assert got[: len(want)] == want and len(got) == len(set(got))


@pytest.mark.parametrize(
    "path,want",
    [
        ("/a/./b//c", "/a/b/c"), ("/a/x/../b", "/a/b"), ("/a/x/y/../../b", "/a/b"), ("/../a", "/a"), ("../a", "../a"), ("a/../../b", "../b"),
        ("file:///a/%E6%96%B0/b", "/a/新/b"), ("file:/a/b%20c", "/a/b c"), ("/a/b%20c", "/a/b%20c"), ("file:/a/b+c", "/a/b+c"), ("file:/a/100%", "/a/100%"),
        ("FILE:///a", "/a"), ("", ""), (None, None), ("/", "/"), ("/a/Page", "/a/Page"),
    ],
)
def test_canonical_path(spark, path, want):
    assert one(spark, path, paths.canonical_path) == want


def test_containment_is_by_component(spark):
    rows = [("/a/b", "/a/b", True), ("/a/bc", "/a/b", False), ("/a/b/c", "/a/b/", True), ("/a", "/a/b", False), ("/x", "/", True)]
    df = spark.createDataFrame(rows, "p string, r string, want boolean").select(paths.is_within("p", "r").alias("got"), "want")
    assert all(r["got"] == r["want"] for r in df.collect())


def test_orders(spark):
    rel = ["b.png", "a/z.png", "a/b/c.png", "a/a.png", "c/x.png"]
    df = spark.createDataFrame([(r,) for r in rel], "r string")
    assert [r["r"] for r in df.orderBy(names.walk_key("r")).collect()] == ["b.png", "a/a.png", "a/z.png", "a/b/c.png", "c/x.png"]
    leaf = ["0010.png", "0002.png", "cov002.png", "!1.png", "Bok1.png", "cov001.png", "leg1.png", "fow2.png", "fow10.png", "zz.png"]
    df = spark.createDataFrame([(r,) for r in leaf], "r string")
    assert [r["r"] for r in df.orderBy(names.book_key("r")).collect()] == ["cov001.png", "Bok1.png", "leg1.png", "fow2.png", "fow10.png", "!1.png", "0002.png", "0010.png", "cov002.png", "zz.png"]


def test_two_columns(spark):
    rows = [("right-top", 60, 10, 90, 20), ("left-bottom", 10, 30, 40, 40), ("left-top", 10, 5, 40, 15), ("right-bottom", 60, 40, 90, 50), ("　 ", 0, 0, 1, 1)]
    box = lambda x0, y0, x1, y1: [(float(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    df = spark.createDataFrame([(1, i, t, 100, box(*b)) for i, (t, *b) in enumerate(rows)], "page_id int, line_no int, text string, width int, polygon array<struct<x:double,y:double>>")
    got = geometry.reading_order(df, ["page_id"]).orderBy("reading_no")
    assert [r["text"] for r in got.collect()] == ["left-top", "left-bottom", "right-top", "right-bottom"]
    p = spark.createDataFrame([([(10.9, 20.9), (80.0, 18.0), (70.2, 50.8), (5.0, 55.0)],)], "polygon array<struct<x:double,y:double>>")
    assert tuple(p.select(geometry.text_rect("polygon", y_offset=3).alias("r")).first()["r"]) == (10, 23, 70, 53)


def test_font_size_equals_the_loop(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 30), rng.uniform(0, 400), rng.uniform(0, 120)) for _ in range(300)]
    df = spark.createDataFrame([("x" * n, w, h) for n, w, h in rows], "t string, w double, h double")
    got = [r["s"] for r in df.select(geometry.font_size(F.col("t"), F.col("w"), F.col("h")).alias("s")).collect()]
    slow = [r["s"] for r in df.select(geometry.font_size(F.col("t"), F.col("w"), F.col("h"), lambda t, s: F.length(t) * s).alias("s")).collect()]
    for (n, w, h), a, b in zip(rows, got, slow):
        size = h * 0.9
        while size > 1 and n * size > w:
            size -= 1
        want = max(1.0, min(100.0, size))
        assert a == pytest.approx(want) and b == pytest.approx(want)


def test_small_scalars(spark):
    row = spark.createDataFrame([(3725.9, 1536, None)], "s double, n bigint, z bigint").select(names.duration("s").alias("d"), names.human_bytes("n").alias("b"), names.human_bytes("z").alias("u")).first()
    assert tuple(row) == ("01:02:05", "1.5 KiB", "unknown")
