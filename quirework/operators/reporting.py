"""Reports over the job table: counts, rankings, totals and pages of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.schemas import JOBS, STATUSES
from quirework.session import empty

MAX_PAGE = 10_000


def with_all_columns(jobs: DataFrame, backfill: bool = False) -> DataFrame:
    """The 16 columns, absent ones null (0 for retries); ``backfill`` takes a missing intended path from the result."""
    out = empty(jobs.sparkSession, JOBS).unionByName(jobs.select([c for c in jobs.columns if c in JOBS.fieldNames()]), allowMissingColumns=True)
    out = out.withColumn("retry_count", F.coalesce("retry_count", F.lit(0)))
    return out.withColumn("intended_result_path", F.coalesce("intended_result_path", "result_path")) if backfill else out


def job_filter(status: str | None = None, stage: str | None = None, error_class: str | None = None) -> Column:
    """All given conditions; an unknown status or a blank text is an error."""
    if status is not None and status not in STATUSES:
        raise ValueError(f"status is none of {', '.join(STATUSES)}: {status}")
    for name, value in (("stage", stage), ("error_class", error_class)):
        if value is not None and (not isinstance(value, str) or not value.strip()):
            raise ValueError(f"{name} is blank")
    given = [F.col(c) == v for c, v in (("status", status), ("stage", stage), ("error_class", error_class)) if v is not None]
    return reduce(Column.__and__, given, F.lit(True))


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def stage_status(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n"))


def stage_status_map(jobs: DataFrame) -> DataFrame:
    """One row: map of stage to map of status to count. The maps hold counts, never rows."""
    inner = stage_status(jobs).groupBy("stage").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n")))).alias("m"))
    return inner.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("stage", F.map_entries("m").alias("e"))))).alias("x")).select(F.transform_values("x", lambda _, e: F.map_from_entries(e)).alias("by_stage"))


def error_classes(jobs: DataFrame) -> DataFrame:
    """Error classes with their counts, most frequent first, then by name; null and empty ones do not count."""
    counts = jobs.where(F.coalesce(F.col("error_class"), F.lit("")) != "").groupBy("error_class").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "error_class")))


def totals(jobs: DataFrame) -> DataFrame:
    """One row of totals; zeros, not nulls, for an empty table."""
    has = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    return jobs.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum("retry_count"), F.lit(0)).cast("bigint").alias("retry_total"),
        F.coalesce(F.sum("duration_s"), F.lit(0.0)).alias("duration_total_s"),
        has("intended_result_path").alias("with_target"),
        has("execution_profile_json").alias("with_profile"),
    )


def jobs_page(jobs: DataFrame, limit: int = 100, offset: int = 0, **conditions: str) -> DataFrame:
    """One page in the order of path and stage; the bounds are checked, so the driver never sorts more than limit + offset."""
    for name, value, low, high in (("limit", limit, 1, MAX_PAGE), ("offset", offset, 0, 1 << 31)):
        if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
            raise ValueError(f"{name} must be a whole number from {low} to {high}")
    return jobs.where(job_filter(**conditions)).orderBy("source_path", "stage").offset(offset).limit(limit)


def matching(jobs: DataFrame, **conditions: str) -> int:
    return jobs.where(job_filter(**conditions)).count()


def tally(outcomes: DataFrame) -> DataFrame:
    """One row: how many succeeded, were skipped and failed."""
    return outcomes.agg(*[F.count_if(F.coalesce(F.col("status") == s, F.lit(False))).alias(s) for s in ("success", "skipped", "failed")])
