"""Rendering, recognition and document building as pluggable stages.

Their engines are no part of this package. A stage is a small object that is sent to
the workers and set up there at most once per process; deterministic stand-ins take
the engines' place in tests. Outcomes are rows; state is written from those rows,
not from inside the tasks, so a task that runs again does no harm.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.session import cut

OUTCOME = "source string, output_json string, status string, error string, duration_s double, result_json string"


class Recogniser(Protocol):
    def setup(self) -> None: ...

    def predict(self, source: str) -> list[dict]: ...


class Renderer(Protocol):
    def page_count(self, source: str) -> int: ...

    def page(self, source: str, number: int, dpi: int) -> bytes: ...


class Builder(Protocol):
    def build(self, document: str, placed: pd.DataFrame) -> bytes: ...

    def join(self, parts: list[bytes]) -> bytes: ...


#: One attempt per process and engine: a failure to set up is remembered.
_READY: dict[str, str | None] = {}


def _ready(engine: Recogniser, key: str) -> str | None:
    if key not in _READY:
        try:
            engine.setup()
            _READY[key] = None
        except Exception as e:  # whatever an engine raises
            _READY[key] = f"{type(e).__name__}: {e}"
    return _READY[key]


def recognise(tasks: DataFrame, engine: Recogniser, workers: int | None = None) -> DataFrame:
    """One outcome per task (source, output_json); exactly one result per image is valid.

    Tasks to be skipped are filtered out before, so an engine is only set up in a
    process that has something to do.
    """
    key = hashlib.sha256(repr((type(engine).__qualname__, vars(engine))).encode()).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for pdf in batches:
            out = []
            for source, target in zip(pdf["source"], pdf["output_json"]):
                began = time.monotonic()
                error, found = _ready(engine, key), None
                if error is None:
                    try:
                        results = engine.predict(source)
                        if len(results) == 1:
                            found = json.dumps({**results[0], "_provenance": provenance(results[0])}, ensure_ascii=False)
                        else:
                            error = f"{len(results)} results for one image"
                    except Exception as e:  # a bad image fails alone
                        error = f"{type(e).__name__}: {e}"
                out.append((source, target, "failed" if error else "success", error, time.monotonic() - began, found))
            yield pd.DataFrame(out, columns=["source", "output_json", "status", "error", "duration_s", "result_json"])

    rows = tasks.select("source", "output_json")
    return (rows.repartition(workers) if workers else rows).mapInPandas(run, OUTCOME)


def provenance(page: dict) -> dict:
    """Which fields a page's lines come from, by presence."""
    text = "rec_texts" if "rec_texts" in page else "rec_text" if "rec_text" in page else None
    return {"schema": 1, "polygon_field": "rec_polys" if text == "rec_texts" and "rec_polys" in page else "dt_polys", "text_field": text}


def render(documents: DataFrame, engine: Renderer, dpi: int = 144) -> DataFrame:
    """(source, page_no, content): documents are spread by page, so a long one is no single task."""
    if isinstance(dpi, bool) or not isinstance(dpi, int) or not 36 <= dpi <= 1200:
        raise ValueError("the resolution lies between 36 and 1200")

    @F.pandas_udf("int")
    def count(source: pd.Series) -> pd.Series:
        return source.map(engine.page_count)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"source": pdf["source"], "page_no": pdf["page_no"], "content": [engine.page(s, int(n), dpi) for s, n in zip(pdf["source"], pdf["page_no"])]})

    counted = documents.select("source", count("source").alias("n")).where("n > 0")
    pages = counted.select("source", F.explode(F.sequence(F.lit(1), "n")).alias("page_no")).repartition("source", "page_no")
    return pages.mapInPandas(run, "source string, page_no int, content binary")


def render_safely(documents: DataFrame, engine: Renderer, dpi: int = 144) -> DataFrame:
    """(source, page_no, content, error): as ``render``, but a document or page that fails is a row with its error."""
    if isinstance(dpi, bool) or not isinstance(dpi, int) or not 36 <= dpi <= 1200:
        raise ValueError("the resolution lies between 36 and 1200")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for source in pdf["source"]:
                try:
                    n = engine.page_count(source)
                    rows.append((source, n, None if n > 0 else "ValueError: a document without pages"))
                except Exception as e:  # whatever an engine raises
                    rows.append((source, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["source", "n", "error"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for source, number in zip(pdf["source"], pdf["page_no"]):
                try:
                    row = (source, number, engine.page(source, int(number), dpi), None)
                except Exception as e:
                    row = (source, number, None, f"{type(e).__name__}: {e}")
                yield pd.DataFrame([row], columns=["source", "page_no", "content", "error"])

    found = cut(documents.select("source").mapInPandas(counted, "source string, n int, error string"))
    pages = found.where("error IS NULL").select("source", F.explode(F.sequence(F.lit(1), "n")).alias("page_no")).repartition("source", "page_no")
    bad = found.where("error IS NOT NULL").selectExpr("source", "CAST(NULL AS int) AS page_no", "CAST(NULL AS binary) AS content", "error")
    return pages.mapInPandas(run, "source string, page_no int, content binary, error string").unionByName(bad)


def build(placed: DataFrame, engine: Builder, chunk: int = 50) -> DataFrame:
    """(document, chunk_id, content): documents are built in chunks of pages, to be joined in order."""
    chunked = placed.withColumn("chunk_id", F.floor((F.col("page_no") - 1) / chunk).cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["page_no", "line_no"])
        return pd.DataFrame([(pdf["document"].iloc[0], pdf["chunk_id"].iloc[0], engine.build(pdf["document"].iloc[0], pdf))], columns=["document", "chunk_id", "content"])

    return chunked.groupBy("document", "chunk_id").applyInPandas(run, "document string, chunk_id int, content binary")


class FakeRecogniser:
    """Reads nothing: the text of a page is its name. ``fail`` marks sources that raise."""

    def __init__(self, fail: str = "", setup_error: str = "", results: int = 1):
        self.fail, self.setup_error, self.results = fail, setup_error, results

    def setup(self) -> None:
        if self.setup_error:
            raise RuntimeError(self.setup_error)

    def predict(self, source: str) -> list[dict]:
        if self.fail and self.fail in source:
            raise ValueError(f"cannot read {source}")
        box = [[0, 0], [10, 0], [10, 5], [0, 5]]
        return [{"rec_texts": [source.rsplit("/", 1)[-1]], "rec_polys": [box], "dt_polys": [box]}] * self.results


class FakeRenderer:
    """``fail`` marks documents that cannot be opened, ``fail_page`` a page that cannot be drawn."""

    def __init__(self, pages: int = 3, fail: str = "", fail_page: str = ""):
        self.pages, self.fail, self.fail_page = pages, fail, fail_page

    def page_count(self, source: str) -> int:
        if self.fail and self.fail in source:
            raise OSError(f"cannot open {source}")
        return self.pages

    def page(self, source: str, number: int, dpi: int) -> bytes:
        if self.fail_page and self.fail_page in f"{source}#{number}":
            raise ValueError(f"cannot draw page {number}")
        return f"{source}#{number}@{dpi}".encode()


class FakeBuilder:
    def build(self, document: str, placed: pd.DataFrame) -> bytes:
        return "\n".join(x for x in placed["text"] if x is not None).encode()

    def join(self, parts: list[bytes]) -> bytes:
        return b"\f".join(parts)
