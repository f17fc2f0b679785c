"""Only new or changed records since the last successful runs.

Method: fingerprints per partition from counts and additive row hashes. What the
successful runs have finished is kept as a table partitioned by a hash of the key,
beside the fingerprint of each partition (``commit``). A run sums up its own
listing in the same way; only partitions whose fingerprints differ are read and
compared (``plan``), and ``refresh`` replaces changed partitions as a whole by
dynamic partition overwrite.

``refresh`` takes three steps: an intent that names the partitions it is going to
touch, the partitions, a commit that names the new fingerprints. The commit is one
small file that appears at once. A run that dies anywhere before it leaves an
intent without commit, and the next run takes the partitions of that intent for
changed whatever the fingerprints say. Rows are evaluated once.

The hashes are summed in two halves of 32 bits, so no sum can overflow below two
thousand million rows a partition. Equal sums of unequal partitions are possible
in theory (about 1 in 2^64); the rows of changed partitions are compared exactly.

Defined results: rows of failed runs never count; null sizes and times are equal
to each other and differ from values; a null status is unfinished; null keys are
keys; without an open run nothing is to do.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework import store
from quirework.session import cut, row_count_at_most, shared_dir

KEY = ["source_path", "stage"]
STATE = [*KEY, "source_size", "source_mtime_ns"]
#: A partition holds at most about so many keys. Below that, tables are cut into more partitions,
#: down to LEAST_KEYS keys each, as long as there are no more than FEW_PARTITIONS.
MOST_KEYS, LEAST_KEYS, FEW_PARTITIONS = 1_000_000, 64, 128
#: Runs named in a filter of the scan; more of them are joined.
NAMED_RUNS = 1_000


def partition_count(keys: int) -> int:
    """Partitions for so many keys: it grows with the table, so a partition does not."""
    return max(1, math.ceil(keys / MOST_KEYS), min(FEW_PARTITIONS, math.ceil(keys / LEAST_KEYS)))


def _rows_of(jobs: DataFrame, runs: DataFrame, state: str) -> DataFrame:
    """The rows of the runs in ``state``; few runs become a filter of the scan."""
    numbers = runs.where((F.col("state") == state) & F.col("run_no").isNotNull()).select("run_no").distinct()
    few = row_count_at_most(numbers, NAMED_RUNS)
    rows = jobs.select("job_row_id", "run_no", *STATE, "status")
    return rows.join(numbers, "run_no") if few is None else rows.where(F.col("run_no").isin([r["run_no"] for r in few]))


def finished(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """The keys that successful runs have left finished, with the file state they saw.

    The committed row of a key is that of the highest successful run, then of the
    largest id; the key is there if that row is a success. One aggregation,
    combined before the shuffle, so a key with a third of the rows is no problem.
    """
    row = F.struct("run_no", "job_row_id", "source_size", "source_mtime_ns", (F.col("status") == "success").alias("done"))
    last = _rows_of(jobs, runs, "success").groupBy(*KEY).agg(F.max(row).alias("r"))
    return last.where("r.done").select(*KEY, "r.source_size", "r.source_mtime_ns")


def listed(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """The keys of the open run with the file state of the row with the largest id."""
    row = F.struct("job_row_id", "source_size", "source_mtime_ns")
    return _rows_of(jobs, runs, "open").groupBy(*KEY).agg(F.max(row).alias("r")).select(*KEY, "r.source_size", "r.source_mtime_ns")


def fingerprints(keyed: DataFrame, columns: list[str]) -> DataFrame:
    """(part, n, lo, hi): row count and additive hash of ``columns`` of each partition."""
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in columns])  # a hash skips nulls, so they are told apart here
    h = F.xxhash64(*columns, nulls)
    return keyed.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo"), F.sum(F.shiftrightunsigned(h, 32)).alias("hi")
    )


def differing(marks: DataFrame, old: DataFrame) -> DataFrame:
    """(part) whose fingerprints are not the same on both sides, or there on one only."""
    paired = marks.alias("a").join(old.alias("b"), "part", "full_outer")
    same = F.lit(True)
    for c in ("n", "lo", "hi"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return paired.where(~same).select("part")


def _part(keys: list[str], partitions: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(partitions)).cast("int")


def _step(name: str) -> None:
    """Called after each step of ``refresh``; tests stop there."""


def _last(spark: SparkSession, folder: str, kind: str) -> tuple[int, dict]:
    found = [int(n) for n in store.names(spark, f"{folder}/{kind}") if n.isdigit()]
    return (max(found), json.loads(store.read_text(spark, f"{folder}/{kind}/{max(found)}"))) if found else (0, {})


def committed(spark: SparkSession, folder: str) -> dict | None:
    """{partitions, table, marks} of the last commit, null before the first."""
    return _last(spark, folder, "commits")[1] or None


def _marks(spark: SparkSession, folder: str, commit: dict | None) -> DataFrame:
    if commit:
        return spark.read.parquet(f"{folder}/{commit['marks']}")
    return spark.createDataFrame([], "part int, n bigint, lo bigint, hi bigint")


def read_parts(spark: SparkSession, folder: str, parts: list[int] | None = None) -> DataFrame | None:
    """The table of the last commit, or only these partitions of it; None before the first commit."""
    commit = committed(spark, folder)
    if not commit or not commit["schema"]:
        return None
    at = f"{folder}/{commit['table']}"
    if not any(n.startswith("part=") for n in store.names(spark, at)):
        return spark.createDataFrame([], f"{commit['schema']}, part int")
    rows = spark.read.schema(f"{commit['schema']}, part int").parquet(at)
    return rows if parts is None else rows.where(F.col("part").isin(parts))


def refresh(rows: DataFrame, keys: list[str], folder: str, partitions: int | None = None) -> list[int]:
    """Bring the table in ``folder`` to the state of ``rows``; the partitions replaced.

    A partition is rewritten only if its fingerprint is not the recorded one, or if
    a run that never committed may have touched it. The numbers of partitions come
    to the driver, not rows. If a table has grown to four times the keys a partition
    should hold, the next refresh writes it anew in more partitions.
    """
    spark = rows.sparkSession
    rows = cut(rows)  # evaluated once: fingerprints are those of the rows written
    wanted = partitions or partition_count(rows.count())
    at, commit = _last(spark, folder, "commits")
    tried, intent = _last(spark, folder, "intents")
    number = max(at, tried) + 1
    columns = list(rows.columns)
    if commit and (commit["partitions"] * 4 < wanted or commit["columns"] != columns):
        old, table, count = None, f"table-{number}", wanted
    else:
        old, table, count = commit, commit.get("table", f"table-{number}"), commit.get("partitions", wanted)
    keyed = rows.withColumn("part", _part(keys, count))
    marks = cut(fingerprints(keyed, columns))
    found = {r["part"] for r in differing(marks, _marks(spark, folder, old)).collect()}
    if tried > at and intent["table"] == table:
        found |= set(intent["parts"])
    if old and not found:
        return []
    there = {int(n.removeprefix("part=")) for n in store.names(spark, f"{folder}/{table}") if n.startswith("part=")}
    live = {r["part"] for r in marks.select("part").collect()}
    found |= there - live  # whatever the marks say, what has no rows must not be there
    changed, gone = sorted(found & live), sorted(found - live)
    store.write_text(spark, f"{folder}/intents/{number}", json.dumps({"table": table, "parts": sorted(found)}))
    _step("intent")
    if changed:
        new = keyed if len(changed) == len(live) else keyed.where(F.col("part").isin(changed))
        new = new.repartition(min(len(changed), max(8, spark.sparkContext.defaultParallelism * 4)), "part").sortWithinPartitions("part", *keys)
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{folder}/{table}")
    _step("table")
    for p in gone:
        store.delete(spark, f"{folder}/{table}/part={p}")
    _step("deletion")
    marks.coalesce(1).write.mode("overwrite").parquet(f"{folder}/marks/{number}")
    _step("marks")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    state = {"partitions": count, "table": table, "marks": f"marks/{number}", "columns": columns, "schema": schema}
    store.write_text(spark, f"{folder}/commits/{number}", json.dumps(state))
    _step("commit")
    for kind in ("marks", "intents", "commits"):  # what the commit has replaced
        for n in store.names(spark, f"{folder}/{kind}"):
            if n.isdigit() and int(n) < number:
                store.delete(spark, f"{folder}/{kind}/{n}")
    for n in store.names(spark, folder):
        if n.startswith("table-") and n != table:
            store.delete(spark, f"{folder}/{n}")
    return sorted(found)


def commit(jobs: DataFrame, runs: DataFrame, folder: str, partitions: int | None = None) -> list[int]:
    """Record what the successful runs have finished; the partitions replaced. Made after each successful run."""
    return refresh(finished(jobs, runs), KEY, folder, partitions)


def plan(jobs: DataFrame, runs: DataFrame, folder: str) -> DataFrame:
    """(source_path, stage) of the open run that are new, changed or unfinished against the commit in ``folder``.

    Reads the open run's rows, the recorded fingerprints and, of the finished keys,
    only the partitions whose fingerprint is not that of the listing.
    """
    spark = jobs.sparkSession
    now = listed(jobs, runs)
    last = committed(spark, folder)
    if last is None:
        return now.select(*KEY)
    now = cut(now.withColumn("part", _part(KEY, last["partitions"])))
    old = _marks(spark, folder, last)
    parts = sorted(r["part"] for r in differing(fingerprints(now, STATE), old).collect())
    done = read_parts(spark, folder, None if len(parts) >= old.count() else parts)
    now = now.where(F.col("part").isin(parts)) if len(parts) < last["partitions"] else now
    n, d = now.alias("n"), done.alias("d")
    same = F.col("n.part") == F.col("d.part")
    for c in STATE:
        same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"d.{c}"))
    return n.join(d, same, "left_anti").select(*KEY)


def to_process(jobs: DataFrame, runs: DataFrame, folder: str | None = None, partitions: int | None = None) -> DataFrame:
    """(source_path, stage) of the open run that must be processed.

    With ``folder`` the state of earlier calls is kept there; without it a new one
    is made in the shared folder.
    """
    folder = folder or f"{shared_dir(jobs.sparkSession)}/incremental-{uuid.uuid4().hex}"
    commit(jobs, runs, folder, partitions)
    return plan(jobs, runs, folder)


def publish_work(jobs: DataFrame, runs: DataFrame, folder: str, partitions: int | None = None) -> list[int]:
    """Keep the open run's work list as a partitioned table in ``folder/work``; the partitions that changed.

    May be repeated at any time: a list that has not changed rewrites nothing, and
    one that was half written is completed.
    """
    return refresh(to_process(jobs, runs, f"{folder}/finished", partitions), KEY, f"{folder}/work", partitions)
