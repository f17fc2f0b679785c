"""Progress of a run, chunks of pages, summaries per folder, expired files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.ranks import running


def progress(done: DataFrame, run: str, order: list[str], total: str, every: int = 100) -> DataFrame:
    """Checkpoints of a run: (run, done, errors, elapsed_s, rate, mean_s, remaining, eta_s, percent) every ``every`` items and at the end.

    ``done`` has ended_at, is_error and ``total``, the run's planned number.
    """
    first = done.groupBy(F.col(run).alias("_run")).agg(F.min_by("ended_at", F.struct(*order)).alias("_began"))
    rows = running(done, run, order, done=F.lit(1), errors=F.coalesce(F.col("is_error").cast("bigint"), F.lit(0)))
    rows = rows.join(first, F.col(run).eqNullSafe(F.col("_run"))).drop("_run")
    rows = rows.withColumn("elapsed_s", F.col("ended_at").cast("timestamp").cast("double") - F.col("_began").cast("timestamp").cast("double"))
    rows = rows.where((F.col("done") % every == 0) | (F.col("done") == F.col(total)))
    rate = F.when(F.col("elapsed_s") > 0, F.col("done") / F.col("elapsed_s"))
    left = F.col(total) - F.col("done")
    return rows.select(run, "done", "errors", "elapsed_s", rate.alias("rate"), (F.col("elapsed_s") / F.col("done")).alias("mean_s"), left.alias("remaining"), F.when(rate.isNotNull(), left / rate).alias("eta_s"), (F.col("done") * 100.0 / F.col(total)).alias("percent"))


def chunks(pages: DataFrame, doc: str, order: str, size: int = 50) -> DataFrame:
    """Adds ``chunk_id``: pages of a document in runs of ``size`` in their order."""
    ranked = running(pages, doc, [order], _n=F.lit(1))
    return ranked.withColumn("chunk_id", F.floor((F.col("_n") - 1) / size).cast("int")).drop("_n")


def delete_batches(files: DataFrame, index: Column, n: Column, batches: int = 5) -> DataFrame:
    """Adds ``batch``: equal runs of ``ceil(n / batches)`` files."""
    return files.withColumn("batch", F.floor(index / F.ceil(n / batches)).cast("int"))


def folder_summary(results: DataFrame, folder: str, only_errors: bool = True) -> DataFrame:
    """(folder, pages, duration_s, errors) per folder and, with a null folder, in total."""
    total = results.rollup(folder).agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("duration_s"), F.lit(0.0)).alias("duration_s"), F.count_if("is_error").alias("errors"))
    return total.where("errors > 0") if only_errors else total


def expired(files: DataFrame, modified: str, now: Column, keep: str) -> DataFrame:
    """Files strictly older than ``keep`` (an interval) at ``now``."""
    return files.where(F.col(modified) < now - F.expr(f"INTERVAL {keep}"))


def page_total(pages: DataFrame) -> DataFrame:
    """One row: how many documents (doc) and pages there are, and the highest page number."""
    per_doc = pages.groupBy("doc").agg(F.count(F.lit(1)).alias("n"), F.max("page_no").alias("last"))
    return per_doc.agg(F.count("doc").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("pages"), F.max("last").alias("longest"))


def durations(jobs: DataFrame, key: str) -> DataFrame:
    """(key, jobs, total_s, mean_s, longest_s): how long things took."""
    total = F.coalesce(F.sum("duration_s"), F.lit(0.0)).alias("total_s")
    return jobs.groupBy(key).agg(F.count(F.lit(1)).alias("jobs"), total, F.avg("duration_s").alias("mean_s"), F.max("duration_s").alias("longest_s"))


def pages_left(needed: DataFrame, have: DataFrame, doc: str) -> DataFrame:
    """(doc, needed, have, missing) from the pages a document (doc, needed) should have and the distinct pages that are there."""
    n = have.groupBy(F.col(doc).alias("_d")).agg(F.count(F.lit(1)).alias("have"))
    rows = needed.join(n, F.col(doc).eqNullSafe(F.col("_d")), "left").select(doc, F.coalesce("needed", F.lit(0)).alias("needed"), F.coalesce("have", F.lit(0)).alias("have"))
    return rows.withColumn("missing", F.greatest(F.col("needed") - F.col("have"), F.lit(0)))
