"""Job tables from Parquet and, read-only, from SQLite."""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators.reporting import with_all_columns
from quirework.schemas import JOBS


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """The 16 columns; absent ones are null."""
    return with_all_columns(spark.read.parquet(path))


def _open(path: str) -> sqlite3.Connection:
    con = sqlite3.connect(f"file:{path}?mode=ro", uri=True, timeout=30)
    con.execute("PRAGMA query_only = ON")
    return con


def read_sqlite_jobs(spark: SparkSession, path: str, rows_per_task: int = 100_000) -> DataFrame:
    """The ``jobs`` table of a SQLite file, never written to or migrated.

    Links, missing files and folders are refused. Tasks read ranges of row ids, so
    the file must be visible to all executors; the driver sees two numbers.
    """
    if os.path.islink(path) or not os.path.isfile(path):
        raise ValueError(f"not a regular file: {path}")
    con = _open(path)
    try:
        present = {r[1] for r in con.execute("PRAGMA table_info(jobs)")}
        if not present:
            raise ValueError(f"no jobs table in {path}")
        low, high = con.execute("SELECT min(rowid), max(rowid) FROM jobs").fetchone()
    finally:
        con.close()
    if low is None:
        return spark.createDataFrame([], JOBS)
    parts = ", ".join(f if f in present else f"{'0' if f == 'retry_count' else 'NULL'} AS {f}" for f in JOBS.fieldNames())
    kinds = {f.name: {"bigint": "Int64", "double": "float64"}.get(f.dataType.simpleString(), "object") for f in JOBS}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in pdf["id"]:
                con = _open(path)
                try:
                    rows = con.execute(f"SELECT {parts} FROM jobs WHERE rowid BETWEEN ? AND ?", (int(start), int(start) + rows_per_task - 1)).fetchall()
                finally:
                    con.close()
                yield pd.DataFrame({f: pd.Series([r[i] for r in rows], dtype=kinds[f]) for i, f in enumerate(kinds)})

    n = (high - low) // rows_per_task + 1
    return spark.range(low, high + 1, rows_per_task, numPartitions=max(1, min(n, 512))).mapInPandas(run, JOBS)


def job(jobs: DataFrame, source_path: str, stage: str) -> DataFrame:
    """At most one row: the job of a source and stage."""
    return jobs.where((F.col("source_path") == source_path) & (F.col("stage") == stage))
