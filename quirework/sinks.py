"""Publishing results: whole or not at all."""

from __future__ import annotations

import json
import os
import re
import shutil
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.schemas import JOBS


def _publish(temp: str, target: str, overwrite: bool) -> None:
    if os.path.islink(target):
        raise ValueError(f"target is a link: {target}")
    if overwrite:
        os.replace(temp, target)
    else:
        os.link(temp, target)  # fails if the target is there
        os.unlink(temp)


def write_bytes(path: str, data: bytes, overwrite: bool = False) -> None:
    """Write beside the target, sync, then appear under its name in one step."""
    if os.path.islink(path):
        raise ValueError(f"target is a link: {path}")
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, temp = tempfile.mkstemp(prefix=f".{os.path.basename(path)}.", dir=folder)
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        _publish(temp, path, overwrite)
    finally:
        if os.path.exists(temp):
            os.unlink(temp)


def write_json(path: str, value: object, overwrite: bool = False) -> None:
    write_bytes(path, (json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode(), overwrite)


def replace_folder(staged: str, target: str, overwrite: bool = False) -> None:
    """Put a finished folder in the place of another; on failure the old one comes back."""
    if os.path.islink(target):
        raise ValueError(f"target is a link: {target}")
    if not os.path.exists(target):
        os.rename(staged, target)
        return
    if not overwrite:
        raise FileExistsError(target)
    backup = f"{target}.before-{os.getpid()}"
    os.rename(target, backup)
    try:
        os.rename(staged, target)
    except BaseException:
        os.rename(backup, target)
        raise
    shutil.rmtree(backup)


def publish_rows(df: DataFrame, path: str, text: str, overwrite: bool = False) -> DataFrame:
    """Write the text of each row to its own file; (path, status, error) per row.

    Names follow from the rows, so a task that runs again meets its own files:
    equal content counts as written.
    """

    def one(target: str, content: str) -> tuple[str, str, str | None]:
        data = content.encode()
        try:
            if os.path.isfile(target) and not os.path.islink(target):
                with open(target, "rb") as f:
                    if f.read() == data:
                        return target, "success", None
            write_bytes(target, data, overwrite)
            return target, "success", None
        except (OSError, ValueError) as e:
            return target, "failed", f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([one(p, t) for p, t in zip(pdf["path"], pdf["text"])], columns=["path", "status", "error"])

    return df.select(F.col(path).alias("path"), F.col(text).alias("text")).mapInPandas(run, "path string, status string, error string")


def export_csv(jobs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The 16 job columns with a header, quoted where needed."""
    jobs.select(JOBS.fieldNames()).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def export_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def quarantine(results: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows without and with an error; the bad ones with ``quarantine_name``."""
    name = F.concat(F.lit("FAILED_"), F.regexp_extract("source", r"([^/]*)$", 1))
    return results.where(F.col(error).isNull()), results.where(F.col(error).isNotNull()).withColumn("quarantine_name", name)


def named_pages(messages: DataFrame, message: str) -> DataFrame:
    """Adds ``page``: the page a message names, null if none."""
    return messages.withColumn("page", F.nullif(F.regexp_extract(message, r"(page_[0-9]+)", 1), F.lit("")))


def part_name(stem: Column, index: Column, n: Column) -> Column:
    """Name of one of several results of an image; a single one has the plain name."""
    return F.when(n > 1, F.format_string("%s_result_part_%d.json", stem, index)).otherwise(F.concat(stem, F.lit("_result.json")))


def clean_cache(root: str, execute: bool = False, recreate: bool = True) -> dict[str, object]:
    """Empty ``<root>/temp`` only, and only if told to; otherwise say what would be done."""
    from quirework.safety import check_removable

    target = os.path.join(os.path.realpath(os.path.expanduser(root)), "temp")
    check_removable(target, os.path.dirname(target))
    out = {"target": target, "existed": os.path.isdir(target), "executed": execute, "recreated": False}
    if execute:
        if os.path.islink(target):
            raise ValueError(f"target is a link: {target}")
        if out["existed"]:
            shutil.rmtree(target)
        if recreate:
            os.makedirs(target, exist_ok=True)
            out["recreated"] = True
    return out


def trailing_number(name: str) -> int:
    """The number a chunk file's name ends with, for putting chunks together in order."""
    found = re.search(r"([0-9]+)(?=\.[^.]*$|$)", name)
    return int(found[1]) if found else -1
