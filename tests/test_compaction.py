import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quirework.operators import compaction

T0 = dt.datetime(2025, 1, 1)
TASKS = "task_id bigint, source string, output_json string, status string, error string, n_bytes bigint, payload string, written_at timestamp, file string, run int"
RENDERS = "render_id bigint, source string, output_dir string, page_paths array<string>, page_bytes array<bigint>, page_count int, dpi int, written_at timestamp"


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def task(i, path, minutes, payload="{}"):
    return i, "s", path, "success", None, 10 + i, payload, at(minutes), "clash", 1


def found_of(spark, tasks, renders=()):
    return compaction.listings(spark.createDataFrame(tasks, TASKS), spark.createDataFrame(list(renders), RENDERS))


def test_rules_of_the_last_state(spark):
    tasks = [
        task(1, "/a/x.json", 1), task(2, "/a/./x.json", 5), task(3, "file:///a/x.json", 5), task(4, "/a/X.json", 9), task(5, "/a/x.json", None),
        task(6, "/a/gone.json", 9, None), task(7, None, 1), task(8, None, 2), task(9, "/b/y.json", 1), task(10, "/b/t/../y.json", 1),
    ]
    renders = [(1, "s", "d", ["/p/1.png", None, "/p//1.png", "/p/2.png"], [5, 6], 9, 144, at(1)), (2, "s", "d", None, None, None, None, at(2)), (3, "s", "d", ["/p/2.png"], None, 1, 144, None), (4, "s", "d", [], [], 0, 144, at(3))]
    got = {tuple(r) for r in compaction.superseded(found_of(spark, tasks, renders)).collect()}
    assert got == {("ocr_tasks", 1, 0), ("ocr_tasks", 2, 0), ("ocr_tasks", 5, 0), ("ocr_tasks", 9, 0), ("render_results", 1, 0), ("render_results", 3, 0)}


def test_tiers_do_not_change_the_outcome(spark):
    rng = random.Random(1)
    tasks = [(*task(i, f"/d/{rng.choice(['hot', str(rng.randint(0, 30))])}.json", rng.randint(0, 9))[:5], rng.choice([0, 40, 9000, 10**7]), "{}", at(rng.randint(0, 9)), "f", 1) for i in range(400)]
    want = {}
    for t in tasks:
        key = (t[7], t[0])
        want[t[2]] = max(want.get(t[2], key), key)
    for fan_in, base in ((2, 1), (3, 100), (16, 4096)):
        rows = compaction.resolve(found_of(spark, tasks), fan_in, base).collect()
        assert {r["row_id"] for r in rows if r["superseded_at"] is None} == {k[1] for k in want.values()}
        assert len(rows) == 400 and {r["superseded_at"] for r in rows} == {None, 1, 2}


def test_packing_places_every_file_once(spark):
    rng = random.Random(2)
    tasks = [(*task(i, f"/d/{i}.json", 1)[:5], rng.choice([0, 1, 50, 900, 5000, 60_000]), "{}", at(1), "f", 1) for i in range(600)]
    kept = compaction.resolve(found_of(spark, tasks)).where("superseded_at IS NULL")
    target = 64 << 10
    assignment = compaction.assigned(kept, target, fan_in=4, base_bytes=256)
    _, log = compaction.pack(compaction.as_files(kept), target, fan_in=4, base_bytes=256)
    rows = assignment.collect()
    assert sorted(r["row_id"] for r in rows) == list(range(600))
    sizes = {}
    for r in rows:
        sizes[r["container"]] = sizes.get(r["container"], 0) + r["n_bytes"]
    total = sum(sizes.values())
    assert len(sizes) <= total / target * 2 + 4  # few
    assert max(sizes.values()) <= target + 60_000
    assert log.groupBy("input").count().where("count > 1").count() == 0  # a file is merged once


def stored(folder):
    return sorted(p for p in (folder / "data").rglob("part-*.parquet"))


def test_transactions_can_be_replayed(spark, tmp_path):
    out = str(tmp_path / "store")
    first = [task(1, "/a.json", 1, "old"), task(2, "/b.json", 1, "b")]
    txn = compaction.compact_into(found_of(spark, first), out, 1 << 20)
    assert txn and compaction.compact_into(found_of(spark, first), out, 1 << 20) is None
    more = [*first, task(3, "/./a.json", 5, "new")]
    read = lambda: {r["path"]: r["payload"] for r in compaction.read_compacted(spark, out).collect()}
    # a run that died before its commit counts for nothing and is repeated
    with pytest.MonkeyPatch.context() as m:
        m.setattr(compaction.store, "write_text", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compaction.compact_into(found_of(spark, more), out, 1 << 20)
    assert read() == {"/a.json": "old", "/b.json": "b"}
    second = compaction.compact_into(found_of(spark, more), out, 1 << 20)
    assert second and read() == {"/a.json": "new", "/b.json": "b"} and len(stored(tmp_path / "store")) == 1
    dropped = compaction.journal(spark, out).where("superseded_at IS NOT NULL").collect()
    assert [(r["row_id"], r["path"]) for r in dropped] == [(1, "/a.json")]


def test_many_small_runs_leave_few_files(spark, tmp_path):
    """Earlier containers are inputs of later merges; replaced and dead rows leave the disk."""
    rng = random.Random(5)
    out, tasks, want = str(tmp_path / "store"), [], {}
    for run in range(5):
        for _ in range(12):
            i = len(tasks)
            path = f"/d/{rng.randint(0, 40)}.json"
            tasks.append((*task(i, path, run)[:5], rng.choice([100, 900, 3000]), f"p{i}", at(run), "f", 1))
            want[path] = f"p{i}"
        assert compaction.compact_into(found_of(spark, tasks), out, 20_000, fan_in=4, base_bytes=256)
        assert {r["path"]: r["payload"] for r in compaction.read_compacted(spark, out).collect()} == want
        files = stored(tmp_path / "store")
        rows = spark.read.parquet(*map(str, files))
        total = rows.agg(F.sum("n_bytes")).first()[0]
        assert len(files) <= total / 10_000 + 1 and rows.select("container").distinct().count() == len(files)  # one file each, all but one at least half full
        assert all(spark.read.parquet(str(f)).agg(F.sum("n_bytes")).first()[0] <= 23_000 for f in files)
        assert rows.count() <= len(want) * 1.5
    assert compaction.compact_into(found_of(spark, tasks), out, 20_000) is None
    newest = {(r["src"], r["row_id"]) for r in compaction.resolve(found_of(spark, tasks)).where("superseded_at IS NULL").collect()}
    assert {(r["src"], r["row_id"]) for r in compaction.journal(spark, out).where("superseded_at IS NULL").collect()} == newest
    assert compaction.superseded(found_of(spark, tasks), out).count() == len(tasks) - len(newest)


def test_empty(spark, tmp_path):
    empty = found_of(spark, [])
    assert compaction.superseded(empty).count() == 0
    assert compaction.assigned(compaction.resolve(empty).where("superseded_at IS NULL")).count() == 0
    assert compaction.compact_into(empty, str(tmp_path / "s")) is None
    assert compaction.read_compacted(spark, str(tmp_path / "s")).count() == 0


def test_merges_combine_before_the_shuffle(spark):
    plan = compaction.resolve(found_of(spark, [task(1, "/a", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert compaction.resolve(found_of(spark, [task(1, "/a", 1)])).where(F.col("superseded_at").isNotNull()).count() == 0
