import json

import pytest
from pyspark.sql import functions as F

from quirework.operators import nested

BOX = [[0, 0], [10, 0], [10, 5], [0, 5]]
CASES = [
    ({"dt_polys": [BOX], "rec_texts": ["测试"]}, None, "rec_texts", "dt_polys"),
    ({"dt_polys": [BOX], "rec_text": ["legacy"]}, None, "rec_text", "dt_polys"),
    ({"dt_polys": [BOX], "rec_texts": ["new"], "rec_text": ["old"]}, None, "rec_texts", "dt_polys"),
    ({"dt_polys": [BOX, BOX], "rec_polys": [BOX], "rec_texts": ["kept"]}, None, "rec_texts", "rec_polys"),
    ({"res": {"dt_polys": [BOX, BOX], "rec_polys": [BOX], "rec_texts": ["保留"]}}, None, "rec_texts", "rec_polys"),
    ({"res": {"rec_texts": []}, "dt_polys": []}, "text field", None, "dt_polys"),
    ({"dt_polys": [BOX, BOX], "rec_texts": ["one"]}, "count", "rec_texts", "dt_polys"),
    ({"dt_polys": [BOX[:3]], "rec_texts": ["x"]}, "polygon", "rec_texts", "dt_polys"),
    ({"dt_polys": [[[True, 0], *BOX[1:]]], "rec_texts": ["x"]}, "polygon", "rec_texts", "dt_polys"),
    ({"dt_polys": [[["1", 0], *BOX[1:]]], "rec_texts": ["x"]}, "polygon", "rec_texts", "dt_polys"),
    ({"dt_polys": [[[1], *BOX[1:]]], "rec_texts": ["x"]}, "polygon", "rec_texts", "dt_polys"),
    ({"dt_polys": [[[None, 1], *BOX[1:]]], "rec_texts": ["x"]}, "polygon", "rec_texts", "dt_polys"),
    ({"dt_polys": [[[1, 2, "extra"], *BOX[1:]]], "rec_texts": ["x"]}, None, "rec_texts", "dt_polys"),
    ({"dt_polys": [BOX], "rec_texts": [None]}, "no string", "rec_texts", "dt_polys"),
    ({"dt_polys": [BOX], "rec_texts": [5]}, "no string", "rec_texts", "dt_polys"),
    ({"rec_polys": None, "dt_polys": [BOX], "rec_texts": ["x"]}, "not an array", "rec_texts", "rec_polys"),
    ({"dt_polys": [], "rec_texts": []}, None, "rec_texts", "dt_polys"),
    ([1, 2], "root", None, None),
]


def test_page_rules(spark):
    df = spark.createDataFrame([(i, json.dumps(c[0], ensure_ascii=False), "clash") for i, c in enumerate(CASES)], "id bigint, j string, lines string")
    got = {r["page_id"]: r for r in nested.normalise_pages(df, "id", "j").collect()}
    for i, (page, error, text, polygon) in enumerate(CASES):
        r = got[i]
        assert (r["error"] is None) if error is None else error in r["error"], (page, r["error"])
        assert (r["text_field"], r["polygon_field"]) == (text, polygon), page
        assert (r["lines"] is None) == (error is not None)


@pytest.mark.parametrize("text", [None, "", "{bad", '{"rec_texts": []', '{"dt_polys":[],"rec_texts":[]} trailing', "{}{}", "null", "3"])
def test_damaged_pages_give_nothing(spark, text):
    pages = nested.normalise_pages(spark.createDataFrame([(1, text)], "id bigint, j string"), "id", "j")
    assert pages.first()["error"] is not None
    assert nested.page_points(pages).count() == nested.page_lines(pages).count() == 0


def leaves(v, path=""):
    if isinstance(v, dict):
        for k, x in v.items():
            yield from leaves(x, f"{path}/{k}")
    elif isinstance(v, list):
        for i, x in enumerate(v):
            yield from leaves(x, f"{path}/{i}")
    else:
        yield path[1:]


def test_profiles_of_any_depth(spark):
    deep = {"end": None}
    for i in range(19):
        deep = {"k": deep} if i % 2 else {"l": [1, deep]}
    texts = [
        json.dumps({"a": 1, "b": {"c": [True, None, {"d": "x"}], "e": {}}, "f": []}), json.dumps(json.dumps({"in": {"side": "}}{{"}, "q": 'a"b'})), json.dumps(deep),
        '{"x": "}}}}}}}}}}}}", "y": {"z": {"w": [[[[[[[[[[1]]]]]]]]]]}}}', "[1]", '"text"', "", None, '{"a": 1', '{"a":1} x', '{"a":1,"a":{"b":2}}', json.dumps(json.dumps(json.dumps({"twice": 1}))),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, j string")
    got = sorted((r["parent_id"], r["path"]) for r in nested.profile_leaves(df, "id", "j").collect())
    want = []
    for i, t in enumerate(texts):
        try:
            v = json.loads(t)
            v = json.loads(v) if isinstance(v, str) else v
        except (TypeError, ValueError):
            continue
        want += [(i, p) for p in leaves(v)] if isinstance(v, dict) else []
    assert got == sorted(want)
    kinds = {r["path"]: (r["kind"], r["value"], r["number"]) for r in nested.profile_leaves(df.where("id = 0"), "id", "j").collect()}
    assert kinds["a"] == ("number", None, 1.0) and kinds["b/c/0"] == ("boolean", "true", None) and kinds["b/c/1"] == ("null", None, None) and kinds["b/c/2/d"] == ("string", "x", None)


def test_empty_tables(spark):
    assert nested.child_records(spark.createDataFrame([], "page_id bigint, page_json string"), spark.createDataFrame([], "job_row_id bigint, execution_profile_json string")).count() == 0


def test_plan_stays_in_the_jvm_without_shuffle(spark):
    df = spark.createDataFrame([(1, "{}")], "id bigint, j string")
    plan = nested.page_points(nested.normalise_pages(df, "id", "j"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert nested.page_points(nested.normalise_pages(df, "id", "j")).select(F.lit(1)).count() == 0
