"""Whole runs: recognition of a folder of images, documents from there on, retries.

State is an append-only table of events; a run reads it, plans, acts on what is to be
run and appends what happened, taken from the rows of results. Outcomes are computed
once and kept in the shared folder before anything is appended.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework import sinks, stages
from quirework.functions.names import result_name
from quirework.functions.paths import decode_file_uri, suffix
from quirework.functions.ranks import running
from quirework.operators import fold, matching, nested, planning, reporting
from quirework.schemas import EVENTS
from quirework.session import cut
from quirework.sources.files import list_files, read_page_json


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(folder) if _exists(spark, folder) else spark.createDataFrame([], EVENTS)


def state(spark: SparkSession, folder: str) -> DataFrame:
    """The job table that the events amount to."""
    return fold.fold(read_events(spark, folder))


def existing_results(spark: SparkSession, out_dir: str) -> DataFrame:
    """(path, valid) of the result files below a folder."""
    files = list_files(spark, [out_dir]).where("NOT is_dir AND NOT is_symlink AND endswith(name, '.json')")
    if not files.head(1):
        return spark.createDataFrame([], "path string, valid boolean")
    texts = read_page_json(spark, out_dir)
    pages = nested.normalise_pages(texts.select(decode_file_uri("path").alias("page"), "json"), "page", "json")
    ok = pages.select(F.col("page_id").alias("path"), F.col("error").isNull().alias("valid"))
    return files.select("path").join(ok, "path", "left").select("path", F.coalesce("valid", F.lit(False)).alias("valid"))


def _events(rows: DataFrame, op: str, first: int, at: str, **columns: Column) -> DataFrame:
    """Event rows of (source, size, mtime_ns, ...): numbered after ``first`` in the order of their sources."""
    values = {f.name: columns.get(f.name, F.lit(None)).cast(f.dataType) for f in EVENTS}
    values |= {"op": F.lit(op), "at": F.lit(at), "seq": F.lit(first).cast("bigint"), "stage": F.lit("ocr")}
    values |= {"source_path": F.col("source"), "size": F.col("size"), "mtime_ns": F.col("mtime_ns")}
    return rows.select(*[values[f].alias(f) for f in EVENTS.fieldNames()])


def recognise_folder(
    spark: SparkSession, images: str, out_dir: str, events_dir: str, engine: stages.Recogniser, profile: str, device: str = "cpu", resume: bool = True, overwrite: bool = False, workers: int | None = None
) -> DataFrame:
    """(source, output_json, status, error): success, skipped or failed for every image, in walk order.

    Two images with one result are an error before anything runs. Results are
    published one file each, never in part. That a job has started is recorded
    before it runs, so a run that dies leaves it running.
    """
    files = list_files(spark, [images]).where("NOT is_dir")
    if files.where("is_symlink").head(1):
        raise ValueError("a link among the images")
    tasks = matching.image_tasks(files, out_dir).select(F.col("path").alias("source"), "output_json", "task_index", "size", "mtime_ns")
    return recognise_tasks(spark, tasks, out_dir, events_dir, engine, profile, device, resume, overwrite, workers)


def recognise_pages(
    spark: SparkSession, out: str, docs: DataFrame, events_dir: str, engine: stages.Recogniser, profile: str, resume: bool = True, overwrite: bool = False, device: str = "cpu"
) -> DataFrame:
    """As ``recognise_folder``, for the rendered pages of documents (pages_dir, ocr_dir)."""
    files = list_files(spark, [out]).where("NOT is_dir AND NOT is_symlink").where(suffix("name") == ".png")
    mine = files.join(docs.select(F.col("pages_dir").alias("dir"), "ocr_dir").distinct(), "dir")
    target = F.concat("ocr_dir", F.lit("/"), result_name("name"))
    tasks = running(mine.select("root", F.col("path").alias("source"), target.alias("output_json"), "size", "mtime_ns"), "root", ["source"], task_index=F.lit(1))
    return recognise_tasks(spark, tasks.drop("root"), out, events_dir, engine, profile, device, resume, overwrite)


def recognise_tasks(
    spark: SparkSession, tasks: DataFrame, out_dir: str, events_dir: str, engine: stages.Recogniser, profile: str, device: str = "cpu", resume: bool = True, overwrite: bool = False, workers: int | None = None
) -> DataFrame:
    """(source, output_json, status, error) of tasks (source, output_json, task_index, size, mtime_ns)."""
    clash = matching.output_collisions(tasks).head(1)
    if clash:
        raise ValueError(f"{clash[0]['source']} and an earlier image have one result")
    asked = F.lit(profile)
    before = state(spark, events_dir)
    # what asking does to a row is part of the decision: a changed source or profile makes it pending
    row = before.select(F.col("source_path").alias("source"), *[F.col(c).alias(f"_{c}") for c in ("size", "mtime_ns", "status", "result_path", "intended", "profile")], F.lit(True).alias("_known"))
    there = existing_results(spark, out_dir)
    joined = tasks.join(row, "source", "left").join(there.withColumnRenamed("path", "output_json"), "output_json", "left")
    joined = joined.join(there.select(F.col("path").alias("_result_path"), F.lit(True).alias("_there")), "_result_path", "left")
    differs = lambda a, b: a.isNotNull() & b.isNotNull() & (a != b)
    changed = (F.col("size") != F.col("_size")) | (F.col("mtime_ns") != F.col("_mtime_ns")) | differs(F.col("_intended"), F.col("output_json")) | differs(F.col("_profile"), asked)
    status = F.when(F.coalesce(changed, F.lit(False)), "pending").otherwise(F.col("_status"))
    needs = planning.needs_run(status, F.col("_result_path"), F.coalesce("_there", F.lit(False)))
    exists = F.col("valid").isNotNull()
    decided = cut(joined.withColumn("d", planning.ocr_decision(exists, F.coalesce("valid", F.lit(False)), F.coalesce("_known", F.lit(False)), needs, resume, overwrite)))

    run = decided.where("d.outcome = 'run'")
    last = read_events(spark, events_dir).agg(F.coalesce(F.max("seq"), F.lit(0)).alias("n")).first()["n"]
    want = {"req_result": F.col("output_json"), "req_profile": asked}
    began = datetime.datetime.now(datetime.timezone.utc).isoformat()
    if run.head(1):
        _events(run, "started", last + 1, began, worker=F.lit("spark"), device=F.lit(device), **want).coalesce(1).write.mode("append").parquet(events_dir)
    found = cut(stages.recognise(run, engine, workers).join(run.select("source", "size", "mtime_ns"), "source"))
    written = sinks.publish_rows(found.where("status = 'success'"), "output_json", "result_json", overwrite).withColumnsRenamed({"path": "output_json", "status": "_w", "error": "_e"})
    done = found.join(written, "output_json", "left").select(
        "source", "output_json", "size", "mtime_ns", "duration_s",
        F.when((F.col("status") == "success") & (F.col("_w") == "success"), "success").otherwise("failed").alias("status"), F.coalesce("error", "_e").alias("error"),
    )
    done = cut(done)

    at = datetime.datetime.now(datetime.timezone.utc).isoformat()
    skipped, refused = decided.where("d.outcome = 'skipped'"), decided.where("d.outcome = 'failed'")
    text = F.regexp_extract("error", r"^(\w+): ", 1)
    failure = {"err_class": F.coalesce(F.nullif(text, F.lit("")), F.lit("StageError")), "err_msg": F.col("error"), **want}
    news = [
        _events(done.where("status = 'success'"), "success", last + 2, at, result=F.col("output_json"), duration_s=F.col("duration_s")),
        _events(done.where("status = 'failed'"), "failure", last + 2, at, duration_s=F.col("duration_s"), **failure),
        _events(skipped.where("d.rule <> 1"), "needs_run", last + 1, at, **want),
        _events(skipped, "success", last + 2, at, result=F.col("output_json")),
        _events(refused.withColumn("error", F.col("d.detail")), "failure", last + 2, at, **failure),
    ]
    every = news[0]
    for n in news[1:]:
        every = every.unionByName(n)
    every.coalesce(max(1, spark.sparkContext.defaultParallelism // 4)).write.mode("append").parquet(events_dir)
    out = done.select("source", "output_json", "status", "error").unionByName(
        decided.where("d.outcome <> 'run'").select("source", "output_json", F.col("d.outcome").alias("status"), F.when(F.col("d.outcome") == "failed", F.col("d.detail")).alias("error"))
    )
    return tasks.select("source", "task_index").join(out, "source").orderBy("task_index").select("source", "output_json", "status", "error")


def documents_to_rebuild(outcomes: DataFrame, doc: Column) -> DataFrame:
    """(doc, force): documents of which any page was recognised anew in this run."""
    return planning.must_rebuild(outcomes.withColumn("doc", doc), "doc")


def tally(outcomes: DataFrame) -> dict[str, int]:
    """How many succeeded, were skipped and failed: three numbers."""
    return reporting.tally(outcomes).first().asDict()
