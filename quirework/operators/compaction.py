"""Countless tiny files into few well-sized ones.

Method: size-tiered incremental compaction. A store holds containers and a journal
of transactions. A transaction takes the listings that the journal does not know,
merges the versions of each file tier by tier (in a merge the newest listing of a
path supersedes the others), and packs the survivors level by level into
containers: files of similar size, and with them the containers of earlier
transactions that are still below the target or hold too many dead rows. The
journal records the inputs and outputs of every merge and the fate of every
listing; replaying a transaction has no effect.

* ``resolve``: what survives. Versions meet within their size tier first, by a
  partially aggregated maximum, so a path with a third of all listings reaches no
  single task; then the tiers are merged.
* ``pack``: where it goes. Only names and sizes go through the levels, and listings
  are joined to the outcome once.
* ``compact_into``: one transaction. Containers are written first, one file each,
  then the journal, then one small file that commits both. Files of containers that
  later ones have replaced are removed after the commit.

Defined results: null lists, null elements and null payloads are no listings; a
listing without a path is a file of its own; a null ``written_at`` is older than
any other; equal times fall to the larger row id, then the larger position; sizes
that are null or negative count as zero; empty tables give empty results.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework import store
from quirework.functions.paths import canonical_path
from quirework.session import cut, shared_dir

IDENTITY = ["src", "row_id", "item_no"]
LISTING = "src string, row_id bigint, item_no int, path string, n_bytes bigint, written_at timestamp, payload string"
INDEX = [*IDENTITY, "path", "n_bytes", "written_at"]
JOURNAL = "src string, row_id bigint, item_no int, path string, n_bytes bigint, written_at timestamp, superseded_at int, container string, seq int"
#: A tier's files are so many times larger than those of the tier before; the first begins at BASE_BYTES.
FAN_IN, BASE_BYTES = 16, 4096
#: A container with a larger share of dead bytes is written anew.
DEAD_SHARE = 0.2


def listings(ocr_tasks: DataFrame, render_results: DataFrame) -> DataFrame:
    """One row per file named: (src, row_id, item_no, path, n_bytes, written_at, payload).

    ``path`` is the canonical spelling; page images carry no payload here.
    """
    tasks = ocr_tasks.where(F.col("payload").isNotNull()).select(
        F.lit("ocr_tasks").alias("src"),
        F.col("task_id").cast("bigint").alias("row_id"),
        F.lit(0).alias("item_no"),
        canonical_path("output_json").alias("path"),
        F.greatest(F.coalesce(F.col("n_bytes"), F.octet_length("payload")).cast("bigint"), F.lit(0)).alias("n_bytes"),
        "written_at",
        "payload",
    )
    renders = render_results.select("render_id", "written_at", "page_bytes", F.posexplode("page_paths").alias("item_no", "raw"))
    renders = renders.where(F.col("raw").isNotNull()).select(
        F.lit("render_results").alias("src"),
        F.col("render_id").cast("bigint").alias("row_id"),
        "item_no",
        canonical_path("raw").alias("path"),
        F.greatest(F.coalesce(F.get("page_bytes", F.col("item_no")), F.lit(0)).cast("bigint"), F.lit(0)).alias("n_bytes"),
        "written_at",
        F.lit(None).cast("string").alias("payload"),
    )
    return tasks.unionByName(renders)


def tier(size: Column, fan_in: int = FAN_IN, base_bytes: int = BASE_BYTES) -> Column:
    """The size tier of a file: 0 up to ``base_bytes`` times ``fan_in``, one more for each further factor."""
    return F.floor(F.log(float(fan_in), F.greatest(size / base_bytes, F.lit(1.0)))).cast("int")


def _file() -> Column:
    """What makes listings versions of one file: the path, or for lack of one the listing itself."""
    return F.coalesce(F.col("path"), F.concat_ws("|", F.lit("\u0000"), "row_id", "item_no"))


def resolve(found: DataFrame, fan_in: int = FAN_IN, base_bytes: int = BASE_BYTES) -> DataFrame:
    """Every listing with ``superseded_at``: the level of the merge that dropped it, null if it is kept.

    Level 1 merges the versions of a file within each size tier, level 2 what the
    tiers have left. There are at most 64 bits of size, so fewer tiers than
    ``fan_in`` meet in level 2.
    """
    key = F.struct("written_at", "row_id", "item_no")
    keyed = found.select("src", _file().alias("file"), key.alias("k"), tier(F.col("n_bytes"), fan_in, base_bytes).alias("tier"))
    minor = keyed.groupBy("src", "file", "tier").agg(F.max("k").alias("k"))
    w = Window.partitionBy("src", "file")  # at most one row per tier
    minor = minor.withColumn("newest", F.max("k").over(w))
    fate = F.when(F.col("k") < F.col("newest"), F.lit(2))
    won = minor.select("src", "k.row_id", "k.item_no", F.lit(True).alias("_won"), fate.alias("_fate"))
    out = found.join(won, IDENTITY, "left")
    return out.withColumn("superseded_at", F.when(F.col("_won").isNull(), F.lit(1)).otherwise(F.col("_fate"))).drop("_won", "_fate")


def superseded(found: DataFrame, folder: str | None = None, target_bytes: int = 128 << 20) -> DataFrame:
    """(src, row_id, item_no) of every listing that a merge dropped, from the journal of the store in ``folder``.

    What the journal does not know yet is compacted first. Without ``folder`` a
    new store is made in the shared folder.
    """
    folder = folder or f"{shared_dir(found.sparkSession)}/compaction-{uuid.uuid4().hex}"
    compact_into(found, folder, target_bytes)
    return journal(found.sparkSession, folder).where("superseded_at IS NOT NULL").select(*IDENTITY)


def pack(files: DataFrame, target_bytes: int = 128 << 20, fan_in: int = FAN_IN, base_bytes: int = BASE_BYTES, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """(outcome, merges) of size-tiered merging of (src, container, bucket_key, b).

    outcome: (src, container, output), the last container of each input, itself
    where nothing was merged; merges: (level, src, bucket, input, output, n_bytes),
    one row per merged input. Inputs below the target are put in tiers by size; a
    level merges the files of each tier up to ``fan_in`` tier sizes or the target,
    and a last level joins what is left undersized. No output exceeds the target
    by more than one input.
    """
    total = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    # a bucket holds at most about 64 targets or a million files: the bound of one window
    buckets = max(1, math.ceil(total["b"] / (64 * target_bytes)), math.ceil(total["n"] / 1_000_000))
    now = files.select("src", "container", "b", F.pmod(F.xxhash64("src", "bucket_key"), F.lit(buckets)).alias("bucket"))
    levels = max(1, math.ceil(math.log(max(2.0, target_bytes / base_bytes), fan_in)))
    steps: list[DataFrame] = []
    schema = "level int, src string, bucket bigint, input string, output string, n_bytes bigint"
    for level in range(1, levels + 2):
        last = level == levels + 1
        is_small = F.col("b") < (target_bytes // 2 if last else target_bytes)
        small = now.where(is_small).withColumn("tier", F.lit(-1) if last else tier(F.col("b"), fan_in, base_bytes))
        limit = F.lit(float(target_bytes)) if last else F.least(F.lit(float(target_bytes)), F.pow(F.lit(float(fan_in)), F.col("tier") + 1) * base_bytes)
        order = Window.partitionBy("src", "bucket", "tier").orderBy("b", "container").rowsBetween(Window.unboundedPreceding, -1)
        small = small.withColumn("chunk", F.floor(F.coalesce(F.sum("b").over(order), F.lit(0)) / limit))
        group = Window.partitionBy("src", "bucket", "tier", "chunk")
        output = F.when(F.count(F.lit(1)).over(group) > 1, F.concat_ws("-", F.lit(f"{prefix}L{level}"), "src", "bucket", "tier", "chunk"))
        columns = [F.lit(level).alias("level"), "src", "bucket", F.col("container").alias("input"), output.alias("output"), F.col("b").alias("n_bytes")]
        large = now.where(~is_small).select(*columns[:4], F.lit(None).cast("string").alias("output"), columns[-1])
        after = cut(small.select(*columns).unionByName(large))
        step = after.where("output IS NOT NULL")
        if not step.isEmpty():  # else no two files share a tier, and the next level begins as this one did
            steps.append(step)
            now = after.groupBy("src", "bucket", F.coalesce("output", "input").alias("container")).agg(F.sum("n_bytes").alias("b"))
    if not steps:
        return files.select("src", "container", F.col("container").alias("output")), files.sparkSession.createDataFrame([], schema)
    # from the last level back: where an output of a level ends
    ends = None
    for step in reversed(steps):
        here = step.select("src", F.col("input").alias("container"), "output")
        if ends is not None:
            later = ends.select("src", F.col("container").alias("output"), F.col("output").alias("_end"))
            here = here.join(later, ["src", "output"], "left").select("src", "container", F.coalesce("_end", "output").alias("output"))
            here = here.unionByName(ends)
        ends = here
    outcome = files.select("src", "container").join(ends, ["src", "container"], "left")
    log = steps[0]
    for step in steps[1:]:
        log = log.unionByName(step)
    return outcome.select("src", "container", F.coalesce("output", "container").alias("output")), log


def as_files(kept: DataFrame) -> DataFrame:
    """Listings as inputs of ``pack``: each a file of its own."""
    name = F.concat_ws("/", "src", _file())
    return kept.select("src", F.concat_ws(":", *IDENTITY).alias("container"), name.alias("bucket_key"), F.col("n_bytes").alias("b"))


def assigned(kept: DataFrame, target_bytes: int = 128 << 20, fan_in: int = FAN_IN, base_bytes: int = BASE_BYTES) -> DataFrame:
    """(src, row_id, item_no, path, n_bytes, container): the container of each surviving listing."""
    kept = cut(kept.select(*IDENTITY, "path", "n_bytes"))
    outcome, _ = pack(as_files(kept), target_bytes, fan_in, base_bytes)
    ids = outcome.select("src", F.split("container", ":").alias("p"), "output")
    ids = ids.select("src", F.get("p", F.lit(1)).cast("bigint").alias("row_id"), F.get("p", F.lit(2)).cast("int").alias("item_no"), F.col("output").alias("container"))
    return kept.join(ids, IDENTITY)


# ---------------------------------------------------------------- the store


def _commits(spark: SparkSession, folder: str) -> list[dict]:
    """The committed transactions in order."""
    found = [n for n in store.names(spark, f"{folder}/commits") if n.isdigit()]
    return [json.loads(store.read_text(spark, f"{folder}/commits/{n}")) for n in found]


def journal(spark: SparkSession, folder: str) -> DataFrame:
    """(src, row_id, item_no, path, n_bytes, written_at, superseded_at, container, seq): the last entry of every listing.

    ``container`` is null for a listing that was dropped before it was written, and
    the last container that held it for one that was dropped later.
    """
    done = _commits(spark, folder)
    if not done:
        return spark.createDataFrame([], JOURNAL)
    entries = spark.read.schema(JOURNAL).parquet(*[f"{folder}/journal/{c['txn']}" for c in done])
    if len(done) == 1:
        return entries
    last = F.max_by(F.struct("path", "n_bytes", "written_at", "superseded_at", "container"), "seq").alias("e")
    return entries.groupBy(*IDENTITY).agg(last, F.max("seq").alias("seq")).select(*IDENTITY, "e.*", "seq")


def transaction_id(found: DataFrame, seq: int) -> str:
    """A name for the ``seq``-th transaction over a set of listings: count and additive hash, whatever their order."""
    h = F.xxhash64(*INDEX)
    row = found.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0)).alias("lo"),
        F.coalesce(F.sum(F.shiftrightunsigned(h, 32)), F.lit(0)).alias("hi"),
    ).first()
    return f"{seq:06d}-{row['n']:x}-{row['lo']:x}-{row['hi']:x}"


def compact_into(found: DataFrame, folder: str, target_bytes: int = 128 << 20, fan_in: int = FAN_IN, base_bytes: int = BASE_BYTES) -> str | None:
    """One transaction over the listings that the journal does not know yet; None if there are none.

    Inputs besides those are the live containers below half the target and those
    with more than ``DEAD_SHARE`` of dead bytes, so the number of files is bounded
    by the tiers, however many transactions there have been, and dead rows leave
    the disk. The name follows from the inputs: a run repeated after a failure
    overwrites what the failed one left, and one repeated after success finds
    nothing to do.
    """
    spark = found.sparkSession
    done = _commits(spark, folder)
    seq = len(done) + 1
    known = cut(journal(spark, folder)) if done else None
    fresh = found if known is None else found.join(known.select(*IDENTITY), IDENTITY, "left_anti")
    fresh = cut(fresh)
    txn = transaction_id(fresh, seq)
    if txn.split("-")[1] == "0":
        return None
    if known is None:
        settled = cut(resolve(fresh.select(*INDEX), fan_in, base_bytes).withColumn("held", F.lit(None).cast("string")))
        again = None
    else:
        alive = known.where("superseded_at IS NULL").select(*INDEX, F.col("container").alias("held"))
        touched = fresh.select("src", _file().alias("file")).distinct()
        both = fresh.select(*INDEX, F.lit(None).cast("string").alias("held")).unionByName(alive)
        settled = cut(resolve(both.withColumn("file", _file()).join(touched, ["src", "file"], "left_semi").drop("file"), fan_in, base_bytes))
        dead_now = settled.where("held IS NOT NULL AND superseded_at IS NOT NULL").select(*IDENTITY, F.lit(True).alias("gone"))
        held = known.where("container IS NOT NULL").join(dead_now, IDENTITY, "left")
        live_bytes = F.sum(F.when(F.col("superseded_at").isNull() & F.col("gone").isNull(), F.col("n_bytes")).otherwise(0))
        sizes = held.groupBy("src", "container").agg(live_bytes.alias("b"), F.sum("n_bytes").alias("all"))
        live = [n for c in done for n in c["written"]]
        gone = {n for c in done for n in c["replaced"]}
        here = spark.createDataFrame([(n,) for n in live if n not in gone], "container string")
        sizes = sizes.join(here, "container")
        again = cut(sizes.where((F.col("b") < target_bytes // 2) | (F.col("b") < F.col("all") * (1 - DEAD_SHARE))))
    kept = settled.where("superseded_at IS NULL AND held IS NULL")
    files = as_files(kept)
    if again is not None:
        files = files.unionByName(again.where("b > 0").select("src", "container", F.col("container").alias("bucket_key"), "b"))
    files = cut(files)
    outcome, log = pack(files, target_bytes, fan_in, base_bytes, f"{seq:06d}")
    alone = F.col("output") == F.col("container")
    if again is not None:  # what met nothing and has few dead rows stays as it is
        fine = again.where(F.col("b") >= F.col("all") * (1 - DEAD_SHARE)).select("src", "container", F.lit(True).alias("fine"))
        outcome = outcome.join(fine, ["src", "container"], "left").where(~(alone & F.col("fine").isNotNull())).drop("fine")
    name = F.concat(F.lit(f"{seq:06d}="), F.translate(F.regexp_replace("container", "^[0-9]{6}=", ""), ":", "."))
    outcome = cut(outcome.withColumn("output", F.when(alone, name).otherwise(F.col("output"))))
    ids = outcome.withColumn("p", F.split("container", ":")).where("size(p) = 3")
    new = ids.select("src", F.get("p", F.lit(1)).cast("bigint").alias("row_id"), F.get("p", F.lit(2)).cast("int").alias("item_no"), F.col("output").alias("container"))
    places = cut(new) if again is None else new
    data = fresh
    replaced: list[str] = []
    if again is not None:
        taken = again.where("b = 0").select("src", "container").unionByName(again.join(outcome, ["src", "container"], "left_semi").select("src", "container"))
        replaced = sorted(r["container"] for r in taken.collect())
        moved = known.where("superseded_at IS NULL").join(dead_now, IDENTITY, "left_anti")
        moved = moved.join(outcome.select("src", F.col("container"), "output"), ["src", "container"]).select(*IDENTITY, F.col("output").alias("container"))
        places = cut(new.unionByName(moved))
        old = _containers(spark, folder, done, set(replaced))
        data = data if old is None else data.unionByName(old.select(*fresh.columns))
    # names of containers, one for each file of the target size, come to the driver: every reader needs that list of files
    written = {r["container"]: no for no, r in enumerate(sorted(places.select("container").distinct().collect()))}
    numbers = spark.createDataFrame(list(written.items()), "container string, no int")
    data = data.join(places, IDENTITY).join(numbers, "container").select(*fresh.columns, "container", "no")
    # one partition, so one file, for each container
    data.repartitionById(max(1, len(written)), F.col("no")).drop("no").sortWithinPartitions("path").write.mode("overwrite").parquet(f"{folder}/data/{txn}")
    log.write.mode("overwrite").parquet(f"{folder}/merges/{txn}")
    entry = settled.join(places, IDENTITY, "left").select(*INDEX, "superseded_at", F.coalesce("container", "held").alias("container"))
    if again is not None:
        carried = known.where("superseded_at IS NULL").join(settled.select(*IDENTITY), IDENTITY, "left_anti").drop("container").join(places, IDENTITY)
        entry = entry.unionByName(carried.select(*INDEX, "superseded_at", "container"))
    entry.withColumn("seq", F.lit(seq)).write.mode("overwrite").parquet(f"{folder}/journal/{txn}")
    store.write_text(spark, f"{folder}/commits/{seq:06d}", json.dumps({"txn": txn, "seq": seq, "written": written, "replaced": replaced}))
    _sweep(spark, folder)
    return txn


def _live(done: list[dict]) -> dict[str, tuple[str, int]]:
    """container -> (transaction, number of its file) of what no later transaction has replaced."""
    out = {name: (c["txn"], no) for c in done for name, no in c["written"].items()}
    for c in done:
        for name in c["replaced"]:
            out.pop(name, None)
    return out


def _paths(spark: SparkSession, folder: str, live: dict[str, tuple[str, int]]) -> list[str]:
    wanted: dict[str, set[int]] = {}
    for txn, no in live.values():
        wanted.setdefault(txn, set()).add(no)
    return [f"{folder}/data/{t}/{n}" for t in sorted(wanted) for n in store.names(spark, f"{folder}/data/{t}") if n.startswith("part-") and int(n[5:10]) in wanted[t]]


def _containers(spark: SparkSession, folder: str, done: list[dict], only: set[str] | None = None) -> DataFrame | None:
    live = {k: v for k, v in _live(done).items() if only is None or k in only}
    paths = _paths(spark, folder, live)
    return spark.read.parquet(*paths) if paths else None


def _sweep(spark: SparkSession, folder: str) -> None:
    """Remove the files of replaced containers and of transactions that never committed. May be repeated."""
    done = _commits(spark, folder)
    keep = set(_paths(spark, folder, _live(done)))
    for t in store.names(spark, f"{folder}/data"):
        for n in store.names(spark, f"{folder}/data/{t}"):
            if n.startswith("part-") and f"{folder}/data/{t}/{n}" not in keep:
                store.delete(spark, f"{folder}/data/{t}/{n}")


def read_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """(…listing, container): the last written state of every file over all committed transactions."""
    done = _commits(spark, folder)
    data = _containers(spark, folder, done) if done else None
    if data is None:
        return spark.createDataFrame([], LISTING + ", container string")
    alive = journal(spark, folder).where("superseded_at IS NULL").select(*IDENTITY)
    return data.join(alive, IDENTITY, "left_semi")
