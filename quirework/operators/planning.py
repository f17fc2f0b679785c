"""What must run, may be skipped or must be refused, decided for all tasks at once.

Every decision is one CASE over joined columns, read from the top; planning reads
state and never writes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: Column | str | bool) -> Column:
    return F.lit(x) if isinstance(x, bool) else F.col(x) if isinstance(x, str) else x


def needs_run(status: Column | str, result_path: Column | str, result_exists: Column | str) -> Column:
    """Unless it succeeded and its recorded result, if one is recorded, is still there."""
    s, r = _c(status), F.coalesce(_c(result_path), F.lit(""))
    return ~F.coalesce(s == "success", F.lit(False)) | ((r != "") & ~F.coalesce(_c(result_exists), F.lit(False)))


def ocr_decision(exists, valid, known, needs, resume=True, overwrite=False, tracked=True) -> Column:
    """struct<rule, outcome, detail> of a recognition task.

    exists: the result is there; valid: and can be read; known: a row of an earlier
    run exists; needs: ``needs_run`` of that row; tracked: job state is kept.
    """
    e, v, k, n, r, o, t = (_c(x) for x in (exists, valid, known, needs, resume, overwrite, tracked))
    rule = (
        F.when(e & r & t & ~k & v, 1).when(e & r & t & ~k & ~v, 2)
        .when(e & r & (~t | ~n) & v, 3).when(e & r & (~t | ~n) & ~v, 4)
        .when(e & ~o & t & k & n, 5).when(e & ~o, 6).otherwise(7)
    )
    outcome = F.when(rule.isin(1, 3), "skipped").when(rule == 7, "run").otherwise("failed")
    detail = F.when(rule == 1, "adopted").when(rule == 3, "up to date").when(rule.isin(2, 4), "existing result is invalid").when(rule == 5, "existing result is stale").when(rule == 6, "result exists already").otherwise("to be run")
    return F.struct(rule.alias("rule"), outcome.alias("outcome"), detail.alias("detail"))


def render_decision(exists, valid, known, needs, resume=True, overwrite=False) -> Column:
    """struct<rule, outcome, detail> of rendering a document; an invalid result is rendered anew if overwriting is allowed."""
    e, v, k, n, r, o = (_c(x) for x in (exists, valid, known, needs, resume, overwrite))
    rule = (
        F.when(e & r & ~k & v, 1).when(e & r & ~k & ~v & ~o, 2)
        .when(e & r & ~n & v, 3).when(e & r & ~n & ~v & ~o, 4)
        .when(e & ~o, 5).otherwise(6)
    )
    outcome = F.when(rule.isin(1, 3), "skipped").when(rule == 6, "run").otherwise("failed")
    detail = F.when(rule == 1, "adopted").when(rule == 3, "up to date").when(rule.isin(2, 4), "existing pages are invalid").when(rule == 5, "pages exist already or are stale").otherwise("to be run")
    return F.struct(rule.alias("rule"), outcome.alias("outcome"), detail.alias("detail"))


def searchable_decision(exists, valid, known, needs, force, resume=True, overwrite=False) -> Column:
    """struct<rule, outcome, detail> of building a document; ``force`` after new recognition results."""
    e, v, k, n, f, r, o = (_c(x) for x in (exists, valid, known, needs, force, resume, overwrite))
    rule = (
        F.when(e & r & ~k & ~f & v, 1).when(e & r & ~k & ~f & ~v & ~o, 2)
        .when(e & f & ~o, 3).when(e & f, 7)
        .when(e & r & ~n & v, 4).when(e & r & ~n & ~v & ~o, 5)
        .when(e & ~o, 6).otherwise(7)
    )
    outcome = F.when(rule.isin(1, 4), "skipped").when(rule == 7, "run").otherwise("failed")
    detail = (
        F.when(rule == 1, "adopted").when(rule == 4, "up to date").when(rule.isin(2, 5), "existing document is invalid")
        .when(rule == 3, "stale after new recognition results").when(rule == 6, "document exists already or is stale").otherwise("to be run")
    )
    return F.struct(rule.alias("rule"), outcome.alias("outcome"), detail.alias("detail"))


def must_rebuild(results: DataFrame, doc: str, status: str = "status") -> DataFrame:
    """(doc, force): whether any page of the document was newly recognised in this run."""
    return results.groupBy(doc).agg(F.coalesce(F.max(F.col(status) == "success"), F.lit(False)).alias("force"))


def plan_ocr(tasks: DataFrame, jobs: DataFrame, existing: DataFrame, resume=True, overwrite=False) -> DataFrame:
    """Tasks (source, output_json) with their decision, from the job rows and the existing results (path, valid)."""
    rows = jobs.where("stage = 'ocr'").select(F.col("source_path").alias("source"), "status", "result_path")
    have = existing.select(F.col("path").alias("output_json"), "valid")
    at_result = existing.select(F.col("path").alias("result_path"), F.lit(True).alias("_there"))
    joined = tasks.join(rows, "source", "left").join(have, "output_json", "left").join(at_result, "result_path", "left")
    needs = needs_run("status", "result_path", F.coalesce("_there", F.lit(False)))
    decision = ocr_decision(F.col("valid").isNotNull(), F.coalesce("valid", F.lit(False)), F.col("status").isNotNull(), needs, resume, overwrite)
    return joined.withColumn("decision", decision).drop("_there")
