"""Documents from end to end, and retries of what failed.

A run goes stage by stage over all documents at once: pages are rendered, read and
built into documents, each stage planned from the job table and a listing before
anything runs. A document or page that fails fails alone; what depends on it is not
tried and says so. The folder of a document's artifacts is
``<out>/source-NNN/pdf/<path>/`` with ``pages``, ``ocr`` and ``document.pdf``.

Not part of this: the engines themselves. A builder returns the bytes of a chunk of
pages and joins chunks in their order (``Builder.join``); what it makes of them is
its own affair.
"""

from __future__ import annotations

import datetime
import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework import sinks, stages
from quirework.functions.names import artifact_root, page_number
from quirework.functions.paths import decode_file_uri, parent_dir, suffix
from quirework.operators import matching, nested, placement, planning, retry
from quirework.plans import project
from quirework.schemas import EVENTS, JOBS
from quirework.session import cut
from quirework.sources.files import list_files, read_page_json

CHUNK = 50


def sources(spark: SparkSession, roots: list[str], out: str) -> DataFrame:
    """(source, size, mtime_ns, root, pages_dir, ocr_dir, target) of every PDF; a link among them is an error."""
    found = None
    for i, root in enumerate(roots, 1):
        one = list_files(spark, [root]).where("NOT is_dir").where(suffix("name") == ".pdf").withColumn("_i", F.lit(i))
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "source string, size bigint, mtime_ns bigint, root string, pages_dir string, ocr_dir string, target string")
    if found.where("is_symlink").head(1):
        raise ValueError("a link among the documents")
    base = artifact_root(os.path.abspath(out), "_i", "rel")
    return found.select(
        F.col("path").alias("source"), "size", "mtime_ns", "root",
        F.concat(base, F.lit("/pages")).alias("pages_dir"), F.concat(base, F.lit("/ocr")).alias("ocr_dir"), F.concat(base, F.lit("/document.pdf")).alias("target"),
    )


def page_folders(files: DataFrame) -> DataFrame:
    """(path, valid, pages) of every folder of page images: valid if its pages are numbered from 1 without a gap and none is empty."""
    images = files.where("NOT is_dir AND NOT is_symlink").where(suffix("name") == ".png").withColumn("page_no", page_number("name"))
    whole = (F.min("page_no") == 1) & (F.max("page_no") == F.count(F.lit(1))) & (F.count_distinct("page_no") == F.count(F.lit(1))) & (F.min("size") > 0)
    return images.groupBy(F.col("dir").alias("path")).agg(F.coalesce(whole, F.lit(False)).alias("valid"), F.count(F.lit(1)).cast("int").alias("pages"))


def asked(rows: DataFrame, jobs: DataFrame, stage: str, profile: Column, there: DataFrame) -> DataFrame:
    """Rows (source, size, mtime_ns, target) with what planning needs: known, needs, exists, valid.

    A job counts as pending if its source, target or profile is not what is asked
    now; facts come from the listing ``there`` (path, valid), not from the job.
    """
    row = jobs.where(F.col("stage") == stage).select(
        F.col("source_path").alias("source"), *[F.col(c).alias(f"_{c}") for c in ("size", "mtime_ns", "status", "result_path", "intended", "profile")], F.lit(True).alias("_known")
    )
    j = rows.join(row, "source", "left").join(there.select(F.col("path").alias("target"), F.col("valid").alias("_valid")), "target", "left")
    j = j.join(there.select(F.col("path").alias("_result_path"), F.lit(True).alias("_there")), "_result_path", "left")
    differs = lambda a, b: F.coalesce(a != b, F.lit(False))
    changed = differs(F.col("size"), F.col("_size")) | differs(F.col("mtime_ns"), F.col("_mtime_ns")) | differs(F.col("_intended"), F.col("target")) | differs(F.col("_profile"), profile)
    status = F.when(changed, "pending").otherwise(F.col("_status"))
    return j.select(
        *rows.columns, F.col("_valid").isNotNull().alias("exists"), F.coalesce("_valid", F.lit(False)).alias("valid"), F.coalesce("_known", F.lit(False)).alias("known"),
        planning.needs_run(status, F.col("_result_path"), F.coalesce("_there", F.lit(False))).alias("needs"),
    )


def plan_render(docs: DataFrame, jobs: DataFrame, there: DataFrame, profile: Column, resume: bool = True, overwrite: bool = False) -> DataFrame:
    """Documents with ``d``, the decision whether to render them."""
    rows = asked(docs.withColumn("_t", F.col("target")).withColumn("target", F.col("pages_dir")), jobs, "render", profile, there)
    rows = rows.withColumn("d", planning.render_decision("exists", "valid", "known", "needs", resume, overwrite))
    return rows.withColumn("target", F.col("_t")).drop("_t", "exists", "valid", "known", "needs")


def plan_documents(docs: DataFrame, jobs: DataFrame, there: DataFrame, profile: Column, force: DataFrame, resume: bool = True, overwrite: bool = False) -> DataFrame:
    """Documents with ``d``, the decision whether to build them; ``force`` (source, force) after new recognition results."""
    rows = asked(docs, jobs, "searchable_pdf", profile, there).join(force, "source", "left")
    rows = rows.withColumn("d", planning.searchable_decision("exists", "valid", "known", "needs", F.coalesce("force", F.lit(False)), resume, overwrite))
    return rows.drop("exists", "valid", "known", "needs", "force")


def _written(rows: DataFrame, path: str, content: str, overwrite: bool) -> DataFrame:
    """(source, error) per row of (source, path, content) after writing it; null where it went well."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            errors = []
            for target, data in zip(pdf["path"], pdf["content"]):
                try:
                    same = os.path.isfile(target) and not os.path.islink(target) and open(target, "rb").read() == bytes(data)
                    if not same:  # a task that runs again meets its own file
                        sinks.write_bytes(target, bytes(data), overwrite)
                    errors.append(None)
                except (OSError, ValueError) as e:
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"source": pdf["source"], "error": pd.Series(errors, dtype=object)})

    return rows.select("source", F.col(path).alias("path"), F.col(content).alias("content")).mapInPandas(run, "source string, error string")


def render(docs: DataFrame, engine: stages.Renderer, dpi: int, overwrite: bool) -> DataFrame:
    """(source, pages, error): pages are written one by one beside, and a document's folder appears when all are there."""
    pages = stages.render_safely(docs.select("source"), engine, dpi)
    staged = F.concat("pages_dir", F.lit(".part"))
    named = pages.join(docs.select("source", staged.alias("_dir")), "source")
    good = named.where("error IS NULL").withColumn("path", F.format_string("%s/page_%05d.png", "_dir", "page_no"))
    done = cut(_written(good, "path", "content", True).unionByName(named.where("error IS NOT NULL").select("source", "error")))
    per_doc = done.groupBy("source").agg(F.count(F.lit(1)).cast("int").alias("pages"), F.min("error").alias("error")).join(docs.select("source", "pages_dir"), "source")

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            errors = []
            for folder, error in zip(pdf["pages_dir"], pdf["error"]):
                try:
                    if error is None and (os.path.isdir(f"{folder}.part") or not os.path.isdir(folder)):
                        sinks.replace_folder(f"{folder}.part", folder, overwrite)
                except (OSError, ValueError) as e:
                    error = f"{type(e).__name__}: {e}"
                errors.append(error)
            yield pd.DataFrame({"source": pdf["source"], "pages": pdf["pages"], "error": pd.Series(errors, dtype=object)})

    return cut(per_doc.select("source", "pages", "pages_dir", "error").mapInPandas(publish, "source string, pages int, error string"))


def pages_with_results(docs: DataFrame, files: DataFrame) -> DataFrame:
    """(source, page_no, image, result): every page image of the documents with its result, null without one.

    This is what a builder's pages come from; candidates are met by name in the folder of results.
    """
    images = files.where("NOT is_dir").where(suffix("name") == ".png").select("dir", "name", F.col("path").alias("image"))
    mine = docs.select("source", F.col("pages_dir").alias("dir"), "ocr_dir").join(images, "dir")
    matched = matching.match_results(mine.select(F.col("ocr_dir").alias("dir"), "name").distinct(), files.where("NOT is_dir").select("dir", "name"))
    out = mine.join(matched.select(F.col("dir").alias("ocr_dir"), "name", "result_name"), ["ocr_dir", "name"], "left")
    return out.select("source", page_number("name").alias("page_no"), "image", F.when(F.col("result_name").isNotNull(), F.concat_ws("/", "ocr_dir", "result_name")).alias("result"))


def placed_lines(spark: SparkSession, pages: DataFrame, out: str, y_offset: float = 0) -> DataFrame:
    """(document, page_no, line_no, text, x0 ... baseline) of pages (source, page_no, image, result).

    A page without lines has one row with a null line, so no page is lost. Columns
    of text are told apart by the widest line of the page.
    """
    texts = read_page_json(spark, os.path.abspath(out))
    texts = texts.where(F.col("name").endswith(".json")).select(decode_file_uri("path").alias("result"), "json")
    wanted = pages.join(texts, "result").select(F.concat_ws("|", "source", "page_no").alias("page"), "json", "source", "page_no")
    lines = nested.normalise_pages(wanted, "page", "json")
    flat = lines.select("page_id", F.explode("lines").alias("l")).select(
        "page_id", "l.line_no", "l.text", F.col("l.points").alias("polygon")
    )
    width = F.greatest(F.array_max(F.transform("polygon", lambda p: p["x"])), F.lit(1)).cast("int")
    flat = flat.withColumn("width", F.max(width).over(Window.partitionBy("page_id")))
    plan = placement.placement(flat, ["page_id"], y_offset=int(y_offset)).where("error IS NULL")
    keyed = pages.select("source", "page_no", F.concat_ws("|", "source", "page_no").alias("page_id"))
    return keyed.join(plan, "page_id", "left").drop("page_id").withColumnRenamed("source", "document")


def build(placed: DataFrame, docs: DataFrame, engine: stages.Builder, overwrite: bool, chunk: int = CHUNK) -> DataFrame:
    """(source, error): chunks of pages are built apart, joined in their order, checked and published."""
    chunks = stages.build(placed, engine, chunk)
    whole = chunks.groupBy("document").agg(F.sort_array(F.collect_list(F.struct("chunk_id", "content"))).alias("parts"))

    @F.pandas_udf("binary")
    def joined(parts: pd.Series) -> pd.Series:
        return parts.map(lambda ps: engine.join([bytes(p) for p in ps]))

    ready = whole.select(F.col("document").alias("source"), joined("parts.content").alias("content")).join(docs.select("source", "target"), "source")
    return cut(_written(ready.where(F.octet_length("content") > 0), "target", "content", overwrite).unionByName(ready.where(F.coalesce(F.octet_length("content"), F.lit(0)) == 0).select("source", F.lit("ValueError: an empty document").alias("error"))))


def _record(spark: SparkSession, events: str, stage: str, rows: DataFrame, profile: Column, started: bool = False) -> None:
    """Append that a stage has ``started`` on rows (source, size, mtime_ns, target), or what came of rows that also have
    status, error and ran. What has started is written before anything runs, so a run that dies leaves it running."""
    if started and not rows.head(1):
        return
    last = project.read_events(spark, events).agg(F.coalesce(F.max("seq"), F.lit(0)).alias("n")).first()["n"]
    now = datetime.datetime.now(datetime.timezone.utc).isoformat()

    def event(some: DataFrame, op: str, seq: int, at: str, **columns: Column) -> DataFrame:
        given = {"source_path": F.col("source"), "stage": F.lit(stage), "seq": F.lit(seq), "op": F.lit(op), "size": F.col("size"), "mtime_ns": F.col("mtime_ns"), "at": F.lit(at)} | columns
        return some.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENTS])

    want = {"req_result": F.col("target"), "req_profile": profile}
    failure = {"err_class": F.coalesce(F.nullif(F.regexp_extract("error", r"^(\w+): ", 1), F.lit("")), F.lit("StageError")), "err_msg": F.col("error")}
    if started:
        out = event(rows, "started", last + 1, now, worker=F.lit("spark"), **want)
    else:
        out = event(rows.where("status IN ('success', 'skipped')"), "success", last + 1, now, result=F.col("target"))
        out = out.unionByName(event(rows.where("status = 'failed'"), "failure", last + 1, now, **failure, **want))
    out.coalesce(max(1, spark.sparkContext.defaultParallelism // 4)).write.mode("append").parquet(events)


def _outcomes(decided: DataFrame, did: DataFrame) -> DataFrame:
    """(decided columns, status, error, ran): the decision, or what running gave; did is (source, error)."""
    j = decided.join(did.select("source", F.col("error").alias("_e"), F.lit(True).alias("_ran")), "source", "left")
    ran = F.col("d.outcome") == "run"
    lost = F.coalesce("_e", F.when(F.col("_ran").isNull(), F.lit("RuntimeError: nothing came of it")))
    error = F.when(ran, lost).when(F.col("d.outcome") == "failed", F.concat(F.lit("ValueError: "), "d.detail"))
    status = F.when(error.isNotNull(), "failed").when(ran, "success").otherwise(F.col("d.outcome"))
    return cut(j.withColumn("error", error).withColumn("status", status).withColumn("ran", ran).drop("_e", "_ran"))


def run_documents(
    spark: SparkSession, roots: list[str], out: str, events: str, renderer: stages.Renderer, recogniser: stages.Recogniser, builder: stages.Builder, ocr_profile: str, dpi: int = 144, resume: bool = True, overwrite: bool = False
) -> DataFrame:
    """(source, stage, status, error) of every document and stage; a stage that cannot be tried has status ``blocked``."""
    docs = cut(sources(spark, roots, out))
    render_profile = F.lit(json.dumps({"alpha": False, "dpi": dpi, "format": "png", "kind": "pdf_render", "schema": 1}, sort_keys=True, separators=(",", ":")))
    decided = cut(plan_render(docs, project.state(spark, events), page_folders(list_files(spark, [out])), render_profile, resume, overwrite))
    _record(spark, events, "render", decided.where("d.outcome = 'run'").withColumn("target", F.col("pages_dir")), render_profile, started=True)
    did = render(decided.where("d.outcome = 'run'"), renderer, dpi, overwrite or resume)
    rendered = _outcomes(decided, did)
    _record(spark, events, "render", rendered.withColumn("target", F.col("pages_dir")), render_profile)

    read = project.recognise_pages(spark, out, rendered.where("status <> 'failed'"), events, recogniser, ocr_profile, resume, overwrite)
    of_page = read.join(rendered.select(F.col("source").alias("doc"), F.col("pages_dir").alias("_dir")), parent_dir("source") == F.col("_dir"))
    bad = of_page.where("status = 'failed'").groupBy(F.col("doc").alias("source")).agg(F.count(F.lit(1)).alias("n_bad"), F.min("error").alias("first_error"))
    force = of_page.groupBy(F.col("doc").alias("source")).agg(F.max(F.col("status") == "success").alias("force"))
    ready = rendered.where("status <> 'failed'").join(bad, "source", "left_anti").drop("d", "status", "error", "ran")

    build_profile = F.lit(json.dumps({"kind": "searchable_pdf", "schema": 2, "chunk": CHUNK}, sort_keys=True, separators=(",", ":")))
    files = cut(list_files(spark, [out]))
    built = files.where("NOT is_dir AND NOT is_symlink AND name = 'document.pdf'").select("path", (F.col("size") > 0).alias("valid"))
    planned = cut(plan_documents(ready, project.state(spark, events), built, build_profile, force, resume, overwrite))
    todo = planned.where("d.outcome = 'run'")
    _record(spark, events, "searchable_pdf", todo, build_profile, started=True)
    placed = placed_lines(spark, pages_with_results(todo, files), out) if todo.head(1) else None
    did = build(placed, todo, builder, overwrite) if placed is not None else spark.createDataFrame([], "source string, error string")
    finished = _outcomes(planned, did)
    _record(spark, events, "searchable_pdf", finished, build_profile)
    pages = of_page.groupBy("doc").agg(F.max(F.when(F.col("status") == "failed", 2).when(F.col("status") == "success", 1).otherwise(0)).alias("s"), F.min(F.when(F.col("status") == "failed", F.col("error"))).alias("error"))
    ocr = pages.select(F.col("doc").alias("source"), F.lit("ocr").alias("stage"), F.element_at(F.array(F.lit("skipped"), F.lit("success"), F.lit("failed")), F.col("s") + 1).alias("status"), "error")
    blocked = rendered.where("status = 'failed'").select("source").unionByName(bad.select("source"))
    return (
        rendered.select("source", F.lit("render").alias("stage"), "status", "error").unionByName(ocr)
        .unionByName(finished.select("source", F.lit("searchable_pdf").alias("stage"), "status", "error"))
        .unionByName(blocked.select("source", F.lit("searchable_pdf").alias("stage"), F.lit("blocked").alias("status"), F.lit("an earlier stage failed").alias("error")))
    )


# ---------------------------------------------------------------- retries


def pipeline_facts(planned: DataFrame) -> DataFrame:
    """Adds ``file_reason``: what is wrong with the pipeline file that a recognition job names, null if nothing.

    Each file is read once, wherever it is named.
    """
    rows = retry.with_profile(planned)
    at = lambda k: F.expr(f"try_variant_get(_p, '$.pipeline.{k}', 'string')")
    named = rows.where("stage = 'ocr'").select(at("path").alias("path"), at("size").alias("size"), at("sha256").alias("sha256")).where("path IS NOT NULL").distinct()

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from quirework.adapters import sha256_of

        for pdf in batches:
            found = []
            for path, size, sha in zip(pdf["path"], pdf["size"], pdf["sha256"]):
                if os.path.islink(path) or not os.path.isfile(path):
                    found.append("the pipeline file is gone")
                elif str(os.path.getsize(path)) != size:
                    found.append("the pipeline file changed in size")
                else:
                    found.append(None if sha256_of(path) == sha else "the pipeline file changed")
            yield pd.DataFrame({"path": pdf["path"], "size": pdf["size"], "sha256": pdf["sha256"], "file_reason": pd.Series(found, dtype=object)})

    facts = named.mapInPandas(look, "path string, size string, sha256 string, file_reason string")
    j = rows.join(facts, (at("path") == facts["path"]) & (at("size").eqNullSafe(facts["size"])) & (at("sha256").eqNullSafe(facts["sha256"])) & (F.col("stage") == "ocr"), "left")
    return j.drop("path", "size", "sha256", "_p")


def plan_retries(spark: SparkSession, failed: DataFrame, out: str, inputs: list[str], overwrite: bool = False) -> DataFrame:
    """Failed jobs with ``reason`` and ``state``, from the files as they are now, pipeline files included."""
    planned = retry.plan(failed, list_files(spark, [out, *inputs]), os.path.abspath(out), [os.path.abspath(i) for i in inputs], overwrite)
    checked = pipeline_facts(planned).withColumn("reason", F.coalesce("reason", "file_reason")).drop("file_reason")
    return checked.withColumn("state", retry.retry_state("reason"))


def as_jobs(state: DataFrame) -> DataFrame:
    """The folded state with the column names of the job table."""
    return state.withColumnsRenamed({"size": "source_size", "mtime_ns": "source_mtime_ns", "intended": "intended_result_path", "profile": "execution_profile_json"})


def execute_retries(spark: SparkSession, planned: DataFrame, out: str, inputs: list[str], events: str, recogniser: stages.Recogniser, overwrite: bool = False, workers: int | None = None) -> DataFrame:
    """(source_path, stage, status, error): eligible recognition jobs are run again, after a second look at table and files.

    ``planned`` was made earlier. What has changed since, in the job table or on
    disk, is ``refused`` and left as it is; other stages than recognition are
    ``refused`` too, for they need their engines: a whole run does them.
    """
    eligible = cut(planned.where("state = 'eligible'"))
    current = as_jobs(project.state(spark, events))
    changed = retry.revalidate(eligible, current).select("source_path", "stage", "change")
    again = plan_retries(spark, eligible.select([c for c in JOBS.fieldNames() if c in eligible.columns]), out, inputs, overwrite).select("source_path", "stage", F.col("reason").alias("now"))
    looked = eligible.join(changed, ["source_path", "stage"], "left").join(again, ["source_path", "stage"], "left")
    no = F.coalesce("change", "now", F.when(F.col("stage") != "ocr", F.lit("the stage is run as a whole")))
    looked = cut(looked.withColumn("refusal", no))
    run = looked.where("refusal IS NULL")
    tasks = run.select(F.col("source_path").alias("source"), F.col("intended_result_path").alias("output_json"), F.col("source_size").alias("size"), F.col("source_mtime_ns").alias("mtime_ns"), F.col("execution_profile_json").alias("profile"))
    _record(spark, events, "ocr", tasks.withColumn("target", F.col("output_json")), F.col("profile"), started=True)
    found = cut(stages.recognise(tasks, recogniser, workers))
    written = sinks.publish_rows(found.where("status = 'success'"), "output_json", "result_json", overwrite).withColumnsRenamed({"path": "output_json", "status": "_w", "error": "_e"})
    done = found.join(written, "output_json", "left").withColumn("error", F.coalesce("error", "_e", F.when((F.col("status") == "success") & F.col("_w").isNull(), F.lit("RuntimeError: not written"))))
    done = cut(done.join(tasks.drop("output_json"), "source").withColumn("status", F.when(F.col("error").isNull(), "success").otherwise("failed")).withColumn("target", F.col("output_json")).withColumn("ran", F.lit(True)))
    if done.head(1):
        _record(spark, events, "ocr", done, F.col("profile"))
    refused = looked.where("refusal IS NOT NULL").select("source_path", "stage", F.lit("refused").alias("status"), F.col("refusal").alias("error"))
    return done.select(F.col("source").alias("source_path"), F.lit("ocr").alias("stage"), "status", "error").unionByName(refused)
