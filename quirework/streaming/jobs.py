"""Job events as a stream: the batch fold kept up to date, and counts by event time."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quirework.operators.fold import FIELDS
from quirework.schemas import EVENTS

STATE_COLUMNS = "source_path string, stage string, size bigint, mtime_ns bigint, status string, result_path string, retry_count bigint, error_class string, error_message string, worker string, device string, started_at string, finished_at string, duration_s double, intended string, profile string"


def event_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New event files of a folder, as they come."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def apply_event(state: dict | None, e: dict) -> dict:
    """The state of a job after one event; the same rules as the batch fold."""
    want = {"intended": None, "profile": None} if e["op"] == "success" else {"intended": e["req_result"], "profile": e["req_profile"]}
    s = state
    changed = s is not None and (
        (s["size"], s["mtime_ns"]) != (e["size"], e["mtime_ns"]) or any(s[k] is not None and want[k] is not None and s[k] != want[k] for k in want)
    )
    if s is None or changed:
        old = s or {}
        s = dict.fromkeys(FIELDS) | {"size": e["size"], "mtime_ns": e["mtime_ns"], "status": "pending", "retry_count": 0}
        for k in want:
            s[k] = want[k] if want[k] is not None else old.get(k)
    elif s["status"] != "success":
        s = s | {k: s[k] if s[k] is not None else want[k] for k in want}
    if e["op"] == "started":
        s = s | {"status": "running", "result_path": None, "finished_at": None, "duration_s": None, "error_class": None, "error_message": None, "started_at": e["at"], "worker": e["worker"], "device": e["device"]}
        s = s | {k: want[k] if want[k] is not None else s[k] for k in want}
    elif e["op"] == "success":
        s = s | {"status": "success", "result_path": e["result"], "finished_at": e["at"], "duration_s": e["duration_s"], "error_class": None, "error_message": None}
        s["intended"] = s["intended"] if s["intended"] is not None else e["result"]
    elif e["op"] == "failure":
        s = s | {"status": "failed", "result_path": None, "retry_count": s["retry_count"] + 1, "error_class": e["err_class"], "error_message": e["err_msg"], "finished_at": e["at"], "duration_s": e["duration_s"]}
    return s


def fold_stream(events: DataFrame) -> DataFrame:
    """The latest state of every key that had events, batch by batch (update mode).

    Events of one micro-batch are ordered by ``seq``; batches must come in that order.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        current = json.loads(state.get[0]) if state.exists else None
        frames = [b for b in batches if len(b)]
        if frames:
            rows = pd.concat(frames).sort_values("seq")
            for row in rows.astype(object).where(rows.notna(), None).to_dict("records"):
                current = apply_event(current, row)
            state.update((json.dumps(current, default=int),))
        yield pd.DataFrame([{"source_path": key[0], "stage": key[1], **{f: current[f] for f in FIELDS}}]).astype({"size": "Int64", "mtime_ns": "Int64", "retry_count": "Int64", "duration_s": "float64"})

    return events.groupBy("source_path", "stage").applyInPandasWithState(run, STATE_COLUMNS, "state string", "update", GroupStateTimeout.NoTimeout)


def counts_by_window(events: DataFrame, ts: str = "at", width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Events per window, stage and operation; later ones than ``late`` are dropped by the watermark."""
    timed = events.withColumn("_ts", F.to_timestamp(ts)).withWatermark("_ts", late)
    return timed.groupBy(F.window("_ts", width), "stage", "op").agg(F.count(F.lit(1)).alias("n"))
