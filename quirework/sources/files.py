"""Listings of files as they are on disk.

Spark's own file sources hide names with a leading dot or underscore, skip empty
files and know times in milliseconds only. These listings see everything and keep
nanoseconds; content is loaded by Spark where it is wanted.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.schemas import FILES

COLUMNS = FILES.fieldNames()


def _row(root: str, path: str) -> tuple | None:
    try:
        s = os.lstat(path)
    except OSError:
        return None
    link = os.path.islink(path)
    return root, path, os.path.relpath(path, root), os.path.dirname(path), os.path.basename(path), os.path.isdir(path) and not link, link, s.st_size, s.st_mtime_ns


def _walk(root: str, start: str) -> Iterator[tuple]:
    row = _row(root, start)
    if row is None:
        return
    yield row
    if not row[5]:
        return
    for folder, dirs, names in os.walk(start):
        dirs.sort()
        for name in sorted(dirs + names):
            row = _row(root, os.path.join(folder, name))
            if row:
                yield row


def list_files(spark: SparkSession, roots: list[str], batch: int = 10_000) -> DataFrame:
    """(root, path, rel, dir, name, is_dir, is_symlink, size, mtime_ns) of everything below the roots.

    The driver looks at the first level only; each entry there is walked by a task.
    The roots must be on storage that all executors see. A missing root gives no
    rows; a root that is a file gives that file with its own name as ``rel``.
    Links are listed, not followed.
    """
    starts = []
    for root in roots:
        root = os.path.abspath(os.path.expanduser(root))
        if os.path.isdir(root) and not os.path.islink(root):
            starts += [(root, e.path) for e in os.scandir(root)]
        elif os.path.lexists(root):
            starts.append((os.path.dirname(root), root))
    if not starts:
        return spark.createDataFrame([], FILES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for root, start in zip(pdf["root"], pdf["start"]):
                for row in _walk(root, start):
                    rows.append(row)
                    if len(rows) >= batch:
                        yield pd.DataFrame(rows, columns=COLUMNS)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=COLUMNS)

    tasks = spark.createDataFrame(starts, "root string, start string")
    return tasks.repartition(min(len(starts), 4 * spark.sparkContext.defaultParallelism)).mapInPandas(run, FILES)


def fingerprints(files: DataFrame) -> DataFrame:
    """(path, size, mtime_ns): what identifies a file's content between runs."""
    return files.where("NOT is_dir").select("path", "size", "mtime_ns")


def read_page_json(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, json): one row per file, the text as it is."""
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("json"))


def _size_of(data: bytes | None) -> tuple[int, int] | None:
    if not data:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:2] == b"BM" and len(data) >= 26:
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h)
    if data[:4] in (b"II*\0", b"MM\0*"):
        order = "<" if data[:2] == b"II" else ">"
        at = struct.unpack(order + "I", data[4:8])[0]
        found = {}
        for i in range(struct.unpack(order + "H", data[at : at + 2])[0] if at + 2 <= len(data) else 0):
            entry = data[at + 2 + 12 * i : at + 14 + 12 * i]
            if len(entry) == 12:
                tag, kind = struct.unpack(order + "HH", entry[:4])
                found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), entry[8:10] if kind == 3 else entry[8:12])[0]
        return (found[256], found[257]) if 256 in found and 257 in found else None
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data):
            if data[at] != 0xFF:
                at += 1
                continue
            mark = data[at + 1]
            if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            if mark in (0x01, 0xFF) or 0xD0 <= mark <= 0xD8:
                at += 2 if mark != 0xFF else 1
                continue
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def image_size(content: Column | str) -> Column:
    """struct<width,height> from the headers of PNG, JPEG, BMP and TIFF; null for anything else."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [_size_of(x) or (None, None) for x in batch]
            yield pd.DataFrame({"width": pd.array([s[0] for s in sizes], dtype="Int32"), "height": pd.array([s[1] for s in sizes], dtype="Int32")})

    out = F.pandas_udf(run, "width int, height int")(content)
    return F.when(out["width"].isNotNull(), out)
