"""Planning retries of failed jobs: the first reason against each, and a second look before acting.

Facts about files come as columns or as a listing joined once; the rules are one
ordered ``coalesce``, so the first that applies gives the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.names import result_name
from quirework.functions.paths import ancestors, base_name, is_within, parent_dir
from quirework.functions.profiles import LAYOUT, OCR_KIND, RENDER_KIND, SEARCHABLE_KIND

EXISTS = "the retry target is there already"
PREDICT = ("use_doc_orientation_classify", "use_doc_unwarping", "use_textline_orientation")


def _kind(path: str) -> str:
    return f"schema_of_variant(variant_get(_p, '{path}'))"


def profile_reason() -> Column:
    """What is wrong with the profile for its stage, by its content alone; null if nothing. Needs ``_p`` and ``stage``."""
    text = lambda k: F.expr(f"try_variant_get(_p, '$.{k}', 'string')")
    kind = lambda k: F.coalesce(F.expr(_kind(f"$.{k}")), F.lit("-"))
    whole = lambda k: F.when(kind(k) == "BIGINT", F.expr(f"try_variant_get(_p, '$.{k}', 'bigint')"))
    keys = lambda path: F.expr(f"array_sort(map_keys(try_variant_get(_p, '{path}', 'map<string,variant>')))")
    exact = lambda found, wanted: F.coalesce(found == F.array(*[F.lit(k) for k in sorted(wanted)]), F.lit(False))
    first = lambda *rules: F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for ok, reason in rules])

    device = text("device")
    ocr = first(
        ((whole("schema") == 2) & (text("kind") == OCR_KIND), "unsupported recognition profile"),
        (kind("pipeline").startswith("OBJECT"), "no pipeline identity"),
        (text("pipeline.type") == "file", "the pipeline is no local file"),
        ((kind("pipeline.path") == "STRING") & (text("pipeline.path") != ""), "no pipeline path"),
        ((kind("pipeline.sha256") == "STRING") & (F.length(text("pipeline.sha256")) == 64), "no pipeline checksum"),
        (whole("pipeline.size") >= 0, "no pipeline size"),
        ((kind("device") == "STRING") & (device != ""), "no device"),
        (~device.isin("auto", "gpu"), "the device is not explicit"),
        ((device == "cpu") | device.rlike("^gpu:[0-9]+$"), "unsupported device"),
        (kind("engine").isin("STRING", "VOID", "-"), "the engine is neither text nor null"),
        (kind("use_hpip").isin("BOOLEAN", "VOID", "-"), "use_hpip is neither true, false nor null"),
        (kind("predict").startswith("OBJECT"), "no predict options"),
        (exact(keys("$.predict"), PREDICT), "wrong set of predict options"),
        (F.expr(" AND ".join(f"{_kind(f'$.predict.{k}')} = 'BOOLEAN'" for k in PREDICT)), "a predict option is no boolean"),
    )
    render = first(
        (exact(keys("$"), ("schema", "kind", "dpi", "format", "alpha")), "wrong set of render fields"),
        ((whole("schema") == 1) & (text("kind") == RENDER_KIND), "unsupported render profile"),
        (whole("dpi").between(36, 1200), "the resolution is out of range"),
        ((text("format") == "png") & (kind("alpha") == "BOOLEAN") & (text("alpha") == "false"), "unsupported image format"),
    )
    number = kind("y_offset").isin("BIGINT", "DOUBLE", "FLOAT") | kind("y_offset").startswith("DECIMAL")
    searchable = first(
        (exact(keys("$"), ("schema", "kind", "fontname", "y_offset", "layout", "images_dir", "ocr_json_dir", "expected_page_count")), "wrong set of document fields"),
        ((whole("schema") == 2) & (text("kind") == SEARCHABLE_KIND), "unsupported document profile"),
        (text("layout") == LAYOUT, "unsupported layout"),
        ((kind("fontname") == "STRING") & (text("fontname") != ""), "no font name"),
        (number, "the vertical offset is no number"),
        (whole("expected_page_count") >= 1, "no page count"),
        ((kind("images_dir") == "STRING") & (text("images_dir") != ""), "no folder of images"),
        ((kind("ocr_json_dir") == "STRING") & (text("ocr_json_dir") != ""), "no folder of results"),
    )
    return F.when(F.col("stage") == "ocr", ocr).when(F.col("stage") == "render", render).otherwise(searchable)


def with_profile(jobs: DataFrame) -> DataFrame:
    """Adds ``_p``: the profile as an object, null if it is none."""
    out = jobs.withColumn("_w", F.expr("try_parse_json(concat('[', execution_profile_json, ']'))"))
    out = out.withColumn("_q", F.expr("CASE WHEN variant_get(_w, '$[1]') IS NULL THEN variant_get(_w, '$[0]') END"))
    return out.withColumn("_p", F.expr("CASE WHEN schema_of_variant(_q) LIKE 'OBJECT%' THEN _q END")).drop("_w", "_q")


def plan(failed: DataFrame, files: DataFrame, output_root: str, inputs: list[str], overwrite: bool = False) -> DataFrame:
    """Failed jobs with ``reason`` (null: eligible) and ``state``: eligible, blocked or ineligible.

    ``files`` (path, is_dir, is_symlink, size, mtime_ns) lists what exists under the
    inputs and the output root. What needs the content of a pipeline file is
    looked at in ``plans.documents.plan_retries``.
    """
    facts = files.select("path", "is_dir", "is_symlink", "size", "mtime_ns").dropDuplicates(["path"])
    links = facts.where("is_symlink").select(F.col("path").alias("_link"))
    source = facts.select(F.col("path").alias("source_path"), F.col("is_dir").alias("s_dir"), F.col("is_symlink").alias("s_link"), F.col("size").alias("s_size"), F.col("mtime_ns").alias("s_mtime"))
    target = facts.select(F.col("path").alias("intended_result_path"), F.col("is_dir").alias("t_dir"), F.col("is_symlink").alias("t_link"))
    linked = lambda c: failed.where(F.col(c).isNotNull()).select(c).distinct().withColumn("_link", F.explode(ancestors(c))).join(links, "_link", "left_semi").select(c).distinct()
    rows = with_profile(failed).join(source, "source_path", "left").join(target, "intended_result_path", "left")
    rows = rows.join(linked("source_path").withColumn("s_linked", F.lit(True)), "source_path", "left").join(linked("intended_result_path").withColumn("t_linked", F.lit(True)), "intended_result_path", "left")
    return decide(rows, output_root, inputs, overwrite)


def decide(rows: DataFrame, output_root: str, inputs: list[str], overwrite: bool = False) -> DataFrame:
    """The rules over rows with facts: s_dir, s_size, s_mtime, s_linked of the source, t_dir, t_linked of the target, and ``_p``."""
    t, s = F.col("intended_result_path"), F.col("source_path")
    inside = is_within(s, F.lit(output_root))
    for root in inputs:
        inside = inside | is_within(s, F.lit(root))
    found, is_target = F.col("s_dir").isNotNull(), F.col("t_dir").isNotNull()
    no = lambda c: ~F.coalesce(c, F.lit(False))
    mapped = F.concat(parent_dir(t), F.lit("/"), result_name(base_name(s)))
    profile = profile_reason()
    reason = F.coalesce(
        F.when(no(F.col("stage").isin("ocr", "render", "searchable_pdf")), "unsupported stage"),
        F.when(F.coalesce(s, F.lit("")) == "", "no source path"),
        F.when(F.coalesce(F.col("s_linked"), F.lit(False)), "a part of the source path is a link"),
        F.when(~found, "the source is gone"),
        F.when(F.col("s_dir"), "the source is no file"),
        F.when(no(F.col("s_size") == F.col("source_size")), "the source changed in size"),
        F.when(no(F.col("s_mtime") == F.col("source_mtime_ns")), "the source changed in time"),
        F.when(no(inside), "the source is outside inputs and output"),
        F.when(F.coalesce(t, F.lit("")) == "", "no target path"),
        F.when(F.coalesce(F.col("t_linked"), F.lit(False)), "a part of the target path is a link"),
        F.when(no(is_within(t, F.lit(output_root))), "the target is outside the output"),
        F.when(t == output_root, "the target is the output itself"),
        F.when(is_target & F.lit(not overwrite), EXISTS),
        F.when(F.col("_p").isNull(), "the profile is no object"),
        profile,
        F.when((F.col("stage") == "ocr") & no(mapped == t), "the target is not where the result of the source goes"),
        F.when((F.col("stage") == "render") & is_target & no(F.col("t_dir")), "the target is no folder"),
    )
    out = rows.withColumn("reason", reason)
    return out.withColumn("state", retry_state("reason")).drop("_p")


def retry_state(reason: Column | str) -> Column:
    r = F.col(reason) if isinstance(reason, str) else reason
    return F.when(r.isNull(), "eligible").when(r.startswith(EXISTS), "blocked").otherwise("ineligible")


def revalidate(planned: DataFrame, current: DataFrame) -> DataFrame:
    """Planned rows that changed since, with ``change``: gone, no longer failed, or what differs (nulls are equal)."""
    cols = ["source_size", "source_mtime_ns", "intended_result_path", "execution_profile_json"]
    now = current.select("source_path", "stage", F.col("status").alias("_status"), *[F.col(c).alias(f"_{c}") for c in cols])
    j = planned.join(now, ["source_path", "stage"], "left")
    differs = lambda c: ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    change = F.coalesce(
        F.when(F.col("_status").isNull(), "gone"),
        F.when(F.col("_status") != "failed", "no longer failed"),
        F.when(differs("source_size") | differs("source_mtime_ns"), "source changed"),
        F.when(differs("intended_result_path"), "target changed"),
        F.when(differs("execution_profile_json"), "profile changed"),
    )
    return j.withColumn("change", change).where("change IS NOT NULL").drop("_status", *[f"_{c}" for c in cols])
