import random
import re

import pytest

from quirework import store
from quirework.operators import incremental

JOBS = "job_row_id bigint, run_no int, source_path string, stage string, source_size bigint, source_mtime_ns bigint, status string, current string, part int"
RUNS = [(1, "success"), (2, "failed"), (3, "success"), (4, "open")]


def tables(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], JOBS), spark.createDataFrame(RUNS, "run_no int, state string")


def brute(rows):
    state = dict(RUNS)
    current, committed = {}, {}
    for r in rows:
        key = r[2], r[3]
        if state.get(r[1]) == "open":
            current[key] = max(current.get(key, r), r, key=lambda x: x[0])
        elif state.get(r[1]) == "success":
            committed[key] = max(committed.get(key, r), r, key=lambda x: (x[1], x[0]))
    return {k for k, c in current.items() if k not in committed or committed[k][6] != "success" or committed[k][4:6] != c[4:6]}


def test_cases(spark):
    rows = [
        (1, 1, "same", "ocr", 5, 5, "success"), (2, 4, "same", "ocr", 5, 5, "pending"),
        (3, 1, "grown", "ocr", 5, 5, "success"), (4, 4, "grown", "ocr", 6, 5, "pending"),
        (5, 3, "failed", "ocr", 5, 5, "failed"), (6, 4, "failed", "ocr", 5, 5, "success"),
        (7, 2, "only-failed-run", "ocr", 5, 5, "success"), (8, 4, "only-failed-run", "ocr", 5, 5, "pending"),
        (9, 1, "not-listed", "ocr", 5, 5, "failed"), (10, 4, "new", "ocr", None, None, None),
        (11, 1, "nulls", None, None, 5, "success"), (12, 4, "nulls", None, None, 5, "x"), (13, 1, None, "ocr", 1, 1, "success"), (14, 4, None, "ocr", 1, None, "x"),
        (16, 3, "late", "ocr", 9, 9, "success"), (15, 3, "late", "ocr", 8, 8, "success"), (17, 4, "late", "ocr", 8, 8, "p"), (18, 4, "late", "ocr", 9, 9, "p"),
    ]
    for parts in (1, 3, None):
        got = {(r["source_path"], r["stage"]) for r in incremental.to_process(*tables(spark, rows), partitions=parts).collect()}
        assert got == brute(rows) == {("grown", "ocr"), ("failed", "ocr"), ("only-failed-run", "ocr"), ("new", "ocr"), (None, "ocr")}


def test_random_histories(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(1, 4), f"k{rng.randint(0, 40)}", rng.choice(["ocr", "render"]), rng.choice([1, 2, None]), rng.choice([1, 2]), rng.choice(["success", "success", "failed", None])) for i in range(600)]
    got = [(r["source_path"], r["stage"]) for r in incremental.to_process(*tables(spark, rows), partitions=5).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_only_changed_partitions_are_read(spark, tmp_path):
    rows = [(i, 1, f"k{i}", "ocr", 1, 1, "success") for i in range(50)] + [(100 + i, 4, f"k{i}", "ocr", 1 + (i == 7), 1, "pending") for i in range(50)]
    jobs, runs = tables(spark, rows)
    incremental.commit(jobs, runs, str(tmp_path), 25)
    work = incremental.plan(jobs, runs, str(tmp_path))
    assert [r["source_path"] for r in work.collect()] == ["k7"]
    text = work._jdf.queryExecution().executedPlan().toString()
    k7 = jobs.where("source_path = 'k7'").select(incremental._part(incremental.KEY, 25).alias("p")).first()["p"]
    assert re.search(rf"PartitionFilters: \[[^\]]*part#\d+ = {k7}\)", text)
    same = tables(spark, rows[:57] + rows[58:] + [(200, 4, "k7", "ocr", 1, 1, "x")])
    assert incremental.plan(*same, str(tmp_path)).count() == 0


def test_partitions_grow_with_the_table():
    assert [incremental.partition_count(n) for n in (0, 1, 64, 65, 10**5, 3 * 10**8)] == [1, 1, 1, 2, 128, 300]


def test_no_open_run_and_empty(spark):
    jobs, runs = tables(spark, [(1, 1, "a", "ocr", 1, 1, "success")])
    assert incremental.to_process(jobs, runs.where("state <> 'open'")).count() == 0
    assert incremental.to_process(*tables(spark, [])).count() == 0
    assert incremental.to_process(jobs, runs.where("false")).count() == 0


SCHEMA = "k string, v bigint"


def content(spark, folder):
    return sorted(tuple(r) for r in incremental.read_parts(spark, folder).select("k", "v").collect())


def test_refresh_writes_what_changed(spark, tmp_path):
    folder = str(tmp_path)
    one = [(f"k{i}", i) for i in range(40)]
    two = [(f"k{i}", i + (i == 5)) for i in range(40) if i != 9] + [("new", 1), ("new", 1)]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert len(incremental.refresh(frame(one), ["k"], folder, 16)) > 3
    assert incremental.refresh(frame(one), ["k"], folder, 16) == []
    assert 1 <= len(incremental.refresh(frame(two), ["k"], folder, 16)) <= 3
    assert content(spark, folder) == sorted(two)
    incremental.refresh(frame([("new", 1), ("new", 1)]), ["k"], folder, 16)
    assert content(spark, folder) == [("new", 1), ("new", 1)]
    incremental.refresh(frame([]), ["k"], folder, 16)
    assert content(spark, folder) == []


@pytest.mark.parametrize("step", ["intent", "table", "deletion", "marks", "commit"])
def test_refresh_survives_a_failure_at_each_step(spark, tmp_path, monkeypatch, step):
    """Whatever the source does after the failure, the next run gives its state: also back to what was, or partitions gone."""
    one = [(f"k{i}", i) for i in range(40)]
    other = [(f"k{i}", i * 7) for i in range(0, 40, 2)] + [("new", 1)]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)

    def stop(name):
        if name == step:
            raise RuntimeError(name)

    for then in (one, one[:1]):
        folder = str(tmp_path / str(len(then)))
        incremental.refresh(frame(one), ["k"], folder, 16)
        with monkeypatch.context() as m:
            m.setattr(incremental, "_step", stop)
            with pytest.raises(RuntimeError):
                incremental.refresh(frame(other), ["k"], folder, 16)
        incremental.refresh(frame(then), ["k"], folder, 16)
        assert content(spark, folder) == sorted(then)
        assert incremental.refresh(frame(then), ["k"], folder, 16) == []


def test_first_run_that_fails_and_a_table_that_grows(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    frame = lambda n: spark.createDataFrame([(f"k{i}", i) for i in range(n)], SCHEMA)

    def stop(name):
        if name == "marks":
            raise RuntimeError(name)

    with monkeypatch.context() as m:
        m.setattr(incremental, "_step", stop)
        with pytest.raises(RuntimeError):
            incremental.refresh(frame(60), ["k"], folder)
    assert incremental.read_parts(spark, folder) is None
    incremental.refresh(frame(5), ["k"], folder)
    assert len(content(spark, folder)) == 5
    before = incremental.committed(spark, folder)["partitions"]
    incremental.refresh(frame(1000), ["k"], folder)
    assert len(content(spark, folder)) == 1000 and incremental.committed(spark, folder)["partitions"] > 4 * before
    assert len(store.names(spark, f"{folder}/commits")) == 1


def test_work_list(spark, tmp_path):
    folder = str(tmp_path)
    rows = [(i, 4, f"k{i}", "ocr", 1, 1, "pending") for i in range(30)]
    assert incremental.publish_work(*tables(spark, rows), folder, 8)
    assert incremental.publish_work(*tables(spark, rows), folder, 8) == []
    more = [*rows, (99, 3, "k3", "ocr", 1, 1, "success")]
    assert len(incremental.publish_work(*tables(spark, more), folder, 8)) == 1
    assert {r["source_path"] for r in incremental.read_parts(spark, f"{folder}/work").collect()} == {f"k{i}" for i in range(30) if i != 3}
