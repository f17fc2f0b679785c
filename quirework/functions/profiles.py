"""Execution profiles in their stored form: keys in order, no blanks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of stored profiles.
OCR_KIND, RENDER_KIND, SEARCHABLE_KIND = "paddlex_ocr", "pdf_render", "searchable_pdf"
LAYOUT, FONT = "legacy-v7", "china-s"

KEEP_NULLS = {"ignoreNullFields": "false"}


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _json(**fields) -> Column:
    args = [a for k in sorted(fields) for a in (F.lit(k), _col(fields[k]))]
    return F.to_json(F.named_struct(*args), KEEP_NULLS)


def render_profile(dpi) -> Column:
    return _json(schema=1, kind=RENDER_KIND, dpi=dpi, format="png", alpha=False)


def ocr_profile(pipeline_path, pipeline_size, pipeline_sha256, device, engine=None, use_hpip=None, orientation=False, unwarping=False, textline=False) -> Column:
    """Of a pipeline kept in a file; an engine or flag that is not set is null."""
    pipeline = F.named_struct(F.lit("path"), _col(pipeline_path), F.lit("sha256"), _col(pipeline_sha256), F.lit("size"), _col(pipeline_size), F.lit("type"), F.lit("file"))
    predict = F.named_struct(F.lit("use_doc_orientation_classify"), _col(orientation), F.lit("use_doc_unwarping"), _col(unwarping), F.lit("use_textline_orientation"), _col(textline))
    null_text, null_flag = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    return _json(schema=2, kind=OCR_KIND, pipeline=pipeline, device=F.coalesce(_col(device).cast("string"), F.lit("auto")), engine=null_text if engine is None else engine, use_hpip=null_flag if use_hpip is None else use_hpip, predict=predict)


def searchable_profile(images_dir, ocr_json_dir, expected_page_count, y_offset: float = 0.0, fontname: str = FONT) -> Column:
    return _json(schema=2, kind=SEARCHABLE_KIND, fontname=fontname, y_offset=float(y_offset), layout=LAYOUT, images_dir=images_dir, ocr_json_dir=ocr_json_dir, expected_page_count=expected_page_count)


def canonical(profile: Column | str) -> Column:
    """Any JSON object in stored form; null for what is none. Python's JSON keeps numbers as they are written."""

    def one(text: str | None) -> str | None:
        try:
            value = json.loads(text) if text is not None else None
        except ValueError:
            return None
        return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) if isinstance(value, dict) else None

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(one, na_action=None)

    return F.pandas_udf(run, "string")(profile)


def valid_device(device: Column | str) -> Column:
    c = F.lower(F.col(device) if isinstance(device, str) else device)
    return c.isin("auto", "cpu", "gpu") | c.rlike("^gpu:[0-9]+$")
