"""``python -m quirework.cli``: scan, status, report, jobs, retry-plan, retry, ocr, run, doctor, compact, clean.

Exit codes: 0 well, 1 some item failed, 2 the call was wrong.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from quirework.session import local_session


def _jobs(spark, path):
    from quirework.sources.jobs import read_jobs, read_sqlite_jobs

    return read_sqlite_jobs(spark, path) if path.endswith((".sqlite3", ".sqlite", ".db")) else read_jobs(spark, path)


def scan(spark, args) -> int:
    from quirework.functions.names import IMAGE_SUFFIXES
    from quirework.functions.paths import suffix
    from quirework.operators.matching import counts_per_source
    from quirework.safety import load_project
    from quirework.sources.files import list_files

    p = load_project(args.config)
    sources = spark.createDataFrame([(i, s.path, s.kind) for i, s in enumerate(p.sources, 1)], "source_index int, root string, kind string")
    files = None
    for i, s in enumerate(p.sources, 1):
        wanted = (".pdf",) if s.kind == "pdf" else IMAGE_SUFFIXES
        one = list_files(spark, [s.path]).where("NOT is_dir").where(suffix("name").isin(*wanted)).select(F.lit(i).alias("source_index"))
        files = one if files is None else files.unionByName(one)
    rows = counts_per_source(sources, files).orderBy("source_index").collect()  # one row per configured source
    for r in rows:
        print(f"{r['source_index']}\t{r['kind']}\t{r['root']}\t{r['n']}")
    print(f"total\t{sum(r['n'] for r in rows)}")
    return 0


def report(spark, args) -> int:
    from quirework.operators import reporting

    jobs = _jobs(spark, args.jobs).cache()
    out = {r["status"]: r["n"] for r in reporting.status_counts(jobs).orderBy("status").collect()}
    stages: dict[str, dict[str, int]] = {}
    for r in reporting.stage_status(jobs).orderBy("stage", "status").collect():
        stages.setdefault(r["stage"], {})[r["status"]] = r["n"]
    errors = {r["error_class"]: r["n"] for r in reporting.error_classes(jobs).orderBy("rank").limit(args.errors).collect()}
    print(json.dumps({"status": out, "stages": stages, "errors": errors, **reporting.totals(jobs).first().asDict()}, ensure_ascii=False, indent=2))
    return 0


def jobs(spark, args) -> int:
    from quirework.operators import reporting

    table = _jobs(spark, args.jobs)
    where = {k: getattr(args, k) for k in ("status", "stage", "error_class") if getattr(args, k) is not None}
    page = reporting.jobs_page(table, args.limit, args.offset, **where).toPandas()  # at most MAX_PAGE rows
    if args.csv:
        page.to_csv(sys.stdout, index=False)
    else:
        rows = json.loads(page.to_json(orient="records", force_ascii=False))
        print(json.dumps({"total_matching": reporting.matching(table, **where), "jobs": rows}, ensure_ascii=False, indent=2))
    return 0


def retry_plan(spark, args) -> int:
    from quirework.operators.retry import plan
    from quirework.safety import load_project
    from quirework.sources.files import list_files

    p = load_project(args.config)
    roots = [p.output_root, *(s.path for s in p.sources)]
    planned = plan(_jobs(spark, args.jobs or p.manifest_path).where("status = 'failed'"), list_files(spark, roots), p.output_root, [s.path for s in p.sources], args.overwrite)
    counts = {r["state"]: r["n"] for r in planned.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
    shown = planned.select("source_path", "stage", "state", "reason").orderBy("source_path", "stage").limit(args.limit).collect()
    print(json.dumps({"counts": counts, "rows": [r.asDict() for r in shown]}, ensure_ascii=False, indent=2))
    return 0 if set(counts) <= {"eligible"} else 1


def status(spark, args) -> int:
    """Counts per status; the job table is only read."""
    from quirework.operators.reporting import status_counts

    print(json.dumps({r["status"]: r["n"] for r in status_counts(_jobs(spark, args.jobs)).orderBy("status").collect()}, ensure_ascii=False))
    return 0


def ocr(spark, args) -> int:
    """Recognise a folder of images with the engine ``module:Class``."""
    import importlib

    from quirework.adapters import pipeline_identity, predict_flags
    from quirework.functions.profiles import OCR_KIND
    from quirework.plans.project import recognise_folder, tally
    from quirework.safety import canonical_profile

    module, _, name = args.engine.partition(":")
    engine = getattr(importlib.import_module(module), name)()
    profile = canonical_profile({"schema": 2, "kind": OCR_KIND, "pipeline": pipeline_identity(args.pipeline or args.engine), "device": args.device, "engine": None, "use_hpip": None, "predict": predict_flags()})
    outcomes = recognise_folder(spark, args.images, args.out, args.events, engine, profile, args.device, not args.no_resume, args.overwrite, args.workers).cache()
    counts = tally(outcomes)
    print(json.dumps(counts))
    return 1 if counts["failed"] else 0


def _engine(name: str):
    import importlib

    module, _, cls = name.partition(":")
    return getattr(importlib.import_module(module), cls)()


def run(spark, args) -> int:
    """Documents from end to end with the engines ``module:Class``."""
    from quirework.plans.documents import run_documents
    from quirework.safety import load_project

    p = load_project(args.config)
    roots = [s.path for s in p.sources if s.kind == "pdf"]
    rows = run_documents(spark, roots, p.output_root, args.events, _engine(args.renderer), _engine(args.engine), _engine(args.builder), args.engine, args.dpi, p.resume and not args.no_resume, p.overwrite or args.overwrite).cache()
    counts: dict[str, dict[str, int]] = {}
    for r in rows.groupBy("stage", "status").count().orderBy("stage", "status").collect():
        counts.setdefault(r["stage"], {})[r["status"]] = r["count"]
    print(json.dumps(counts))
    return 1 if any(set(c) & {"failed", "blocked"} for c in counts.values()) else 0


def retry(spark, args) -> int:
    """Plan the retries of failed jobs and, with ``--execute``, run what is eligible."""
    from quirework.plans import documents, project
    from quirework.safety import load_project

    p = load_project(args.config)
    inputs = [s.path for s in p.sources]
    failed = documents.as_jobs(project.state(spark, args.events)).where("status = 'failed'")
    planned = documents.plan_retries(spark, failed, p.output_root, inputs, args.overwrite)
    if not args.execute:
        print(json.dumps({r["state"]: r["count"] for r in planned.groupBy("state").count().collect()}))
        return 0
    rows = documents.execute_retries(spark, planned, p.output_root, inputs, args.events, _engine(args.engine), args.overwrite)
    counts = {r["status"]: r["count"] for r in rows.groupBy("status").count().collect()}
    print(json.dumps(counts))
    return 1 if set(counts) - {"success"} else 0


def doctor(spark, args) -> int:
    """What a run would find here: versions, processors, free room, optional libraries."""
    import importlib.util
    import os
    import platform
    import shutil

    import pyspark

    room = shutil.disk_usage(args.path)
    print(json.dumps({
        "python": platform.python_version(), "spark": pyspark.__version__, "cpus": os.cpu_count(), "path": os.path.abspath(args.path), "free_bytes": room.free, "writable": os.access(args.path, os.W_OK),
        "libraries": {m: importlib.util.find_spec(m) is not None for m in ("pyarrow", "pandas", "yaml", "fitz", "PIL")},
    }, indent=2))
    return 0


def compact(spark, args) -> int:
    from quirework.operators.compaction import compact_into, listings

    found = listings(spark.read.parquet(args.tasks), spark.read.parquet(args.renders))
    txn = compact_into(found, args.out, args.target_mb << 20)
    print(txn or "nothing new")
    return 0


def clean(spark, args) -> int:
    from quirework.sinks import clean_cache

    print(json.dumps(clean_cache(args.cache, args.execute)))
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quirework")
    sub = ap.add_subparsers(dest="command", required=True)
    a = sub.add_parser("scan")
    a.add_argument("config")
    a = sub.add_parser("report")
    a.add_argument("jobs")
    a.add_argument("--errors", type=int, default=100)
    a = sub.add_parser("jobs")
    a.add_argument("jobs")
    a.add_argument("--status")
    a.add_argument("--stage")
    a.add_argument("--error-class", dest="error_class")
    a.add_argument("--limit", type=int, default=100)
    a.add_argument("--offset", type=int, default=0)
    a.add_argument("--csv", action="store_true")
    a = sub.add_parser("retry-plan")
    a.add_argument("config")
    a.add_argument("--jobs")
    a.add_argument("--overwrite", action="store_true")
    a.add_argument("--limit", type=int, default=100)
    a = sub.add_parser("status")
    a.add_argument("jobs")
    a = sub.add_parser("ocr")
    a.add_argument("images")
    a.add_argument("--out", required=True)
    a.add_argument("--events", required=True)
    a.add_argument("--engine", required=True, help="module:Class of a recogniser")
    a.add_argument("--pipeline")
    a.add_argument("--device", default="cpu")
    a.add_argument("--workers", type=int)
    a.add_argument("--no-resume", action="store_true")
    a.add_argument("--overwrite", action="store_true")
    a = sub.add_parser("run")
    a.add_argument("config")
    a.add_argument("--events", required=True)
    for kind in ("renderer", "engine", "builder"):
        a.add_argument(f"--{kind}", required=True, help="module:Class")
    a.add_argument("--dpi", type=int, default=144)
    a.add_argument("--no-resume", action="store_true")
    a.add_argument("--overwrite", action="store_true")
    a = sub.add_parser("retry")
    a.add_argument("config")
    a.add_argument("--events", required=True)
    a.add_argument("--engine", help="module:Class, needed with --execute")
    a.add_argument("--overwrite", action="store_true")
    a.add_argument("--execute", action="store_true")
    a = sub.add_parser("doctor")
    a.add_argument("path", nargs="?", default=".")
    a = sub.add_parser("compact")
    a.add_argument("tasks")
    a.add_argument("renders")
    a.add_argument("out")
    a.add_argument("--target-mb", type=int, default=128)
    a = sub.add_parser("clean")
    a.add_argument("cache")
    a.add_argument("--execute", action="store_true")
    args = ap.parse_args(argv)
    command = {"scan": scan, "report": report, "jobs": jobs, "retry-plan": retry_plan, "status": status, "ocr": ocr, "run": run, "retry": retry, "doctor": doctor, "compact": compact, "clean": clean}[args.command]
    try:
        return command(None if args.command in ("clean", "doctor") else local_session(), args)
    except (ValueError, TypeError, OSError) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
