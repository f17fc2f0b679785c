import random
from collections import defaultdict

from pyspark.sql import functions as F

from quirework.functions.ranks import distributed_rank, last_in_sequence, next_in_sequence, running


def test_rank_numbers_each_key_without_gaps(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", 1000 + i) for i in range(7)] + [(None, 5000), (None, 5001)]
    df = spark.createDataFrame(rows, "k string, i bigint")
    for buckets in (1, 8):
        seen = defaultdict(set)
        for r in distributed_rank(df, "k", "i", "rank", buckets).collect():
            seen[r["k"]].add(r["rank"])
        assert seen["hot"] == set(range(500)) and seen["cold"] == set(range(7)) and seen[None] == {0, 1}


def test_sequences_across_chunks(spark):
    rows = [("s", i, f"v{i}" if i % 5 else None) for i in range(1, 60) if i not in (17, 18, 19, 20, 21)] + [("t", 3, "x")]
    df = spark.createDataFrame(rows, "k string, n bigint, v string").repartition(3)
    nxt = {(r["k"], r["n"]): r["o"] for r in next_in_sequence(df, "k", "n", F.col("n"), "o", span=4).collect()}
    have = [n for k, n, _ in rows if k == "s"]
    assert nxt == {("s", a): b for a, b in zip(have, have[1:] + [None])} | {("t", 3): None}
    last = {(r["k"], r["n"]): r["o"] for r in last_in_sequence(df, "k", "n", "v", "o", span=4).collect()}
    want, seen = {("t", 3): None}, None
    for k, n, v in rows[:-1]:
        want[k, n] = seen
        seen = v or seen
    assert last == want


def test_running_sums_over_a_hot_key(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.randint(0, 50), i, rng.choice([1, 2, None])) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, o int, i int, v int")
    got = {r["i"]: (r["n"], r["s"]) for r in running(df, "k", ["o", "i"], n=F.lit(1), s=F.coalesce("v", F.lit(0))).collect()}
    for key in {r[0] for r in rows}:
        n = total = 0
        for _, _, i, v in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:3]):
            n, total = n + 1, total + (v or 0)
            assert got[i] == (n, total)
    assert len(got) == 800 and running(df.where("false"), "k", ["o"], n=F.lit(1)).count() == 0
