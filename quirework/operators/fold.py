"""The state of every job as a fold over its append-only events.

Events of a key are put in order and folded with a native ``aggregate``; no Python
and no updates in place. The history of one job is what its key collects: the
attempts at one file and stage. Events carry ``seq``, a total order per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = (
    "struct<size:bigint,mtime_ns:bigint,status:string,result_path:string,retry_count:bigint,error_class:string,error_message:string,worker:string,"
    "device:string,started_at:string,finished_at:string,duration_s:double,intended:string,profile:string>"
)
FIELDS = ["size", "mtime_ns", "status", "result_path", "retry_count", "error_class", "error_message", "worker", "device", "started_at", "finished_at", "duration_s", "intended", "profile"]
TYPES = dict(x.split(":") for x in STATE[7:-1].split(","))


def _state(**values: Column) -> Column:
    return F.struct(*[values[f].cast(TYPES[f]).alias(f) for f in FIELDS])


def _ensured(s: Column, e: Column) -> dict[str, Column]:
    """What every operation does first: insert, reset on a change, learn what was unknown."""
    # success is recorded without asking for a target or profile
    asks = e["op"] != "success"
    want_result, want_profile = F.when(asks, e["req_result"]), F.when(asks, e["req_profile"])
    new = s["status"].isNull()
    changed = ~new & (
        (s["size"] != e["size"]) | (s["mtime_ns"] != e["mtime_ns"])
        | F.coalesce(s["intended"] != want_result, F.lit(False)) | F.coalesce(s["profile"] != want_profile, F.lit(False))
    )
    fresh = new | changed
    learns = ~fresh & (s["status"] != "success")
    null = F.lit(None)
    out = {f: F.when(~fresh, s[f]).otherwise(null) for f in FIELDS}
    out["size"], out["mtime_ns"] = F.when(fresh, e["size"]).otherwise(s["size"]), F.when(fresh, e["mtime_ns"]).otherwise(s["mtime_ns"])
    out["status"] = F.when(fresh, F.lit("pending")).otherwise(s["status"])
    out["retry_count"] = F.when(fresh, F.lit(0)).otherwise(s["retry_count"])
    out["intended"] = F.when(fresh, F.coalesce(want_result, s["intended"])).when(learns, F.coalesce(s["intended"], want_result)).otherwise(s["intended"])
    out["profile"] = F.when(fresh, F.coalesce(want_profile, s["profile"])).when(learns, F.coalesce(s["profile"], want_profile)).otherwise(s["profile"])
    return out


def step(s: Column, e: Column) -> Column:
    """The state after one event: needs_run, started, success or failure."""
    b = _ensured(s, e)
    started, success, failure = e["op"] == "started", e["op"] == "success", e["op"] == "failure"
    null = F.lit(None)
    pick = lambda f, a, c, d: F.when(started, a).when(success, c).when(failure, d).otherwise(b[f])
    return _state(
        size=b["size"], mtime_ns=b["mtime_ns"],
        status=pick("status", F.lit("running"), F.lit("success"), F.lit("failed")),
        result_path=pick("result_path", null, e["result"], null),
        retry_count=F.when(failure, b["retry_count"] + 1).otherwise(b["retry_count"]),
        error_class=pick("error_class", null, null, e["err_class"]),
        error_message=pick("error_message", null, null, e["err_msg"]),
        worker=F.when(started, e["worker"]).otherwise(b["worker"]),
        device=F.when(started, e["device"]).otherwise(b["device"]),
        started_at=F.when(started, e["at"]).otherwise(b["started_at"]),
        finished_at=pick("finished_at", null, e["at"], e["at"]),
        duration_s=pick("duration_s", null, e["duration_s"], e["duration_s"]),
        intended=F.when(started, F.coalesce(e["req_result"], b["intended"])).when(success, F.coalesce(b["intended"], e["result"])).otherwise(b["intended"]),
        profile=F.when(started, F.coalesce(e["req_profile"], b["profile"])).otherwise(b["profile"]),
    )


def fold(events: DataFrame) -> DataFrame:
    """(source_path, stage, state fields): the latest state of every key."""
    cols = ["seq", "op", "size", "mtime_ns", "req_result", "req_profile", "result", "worker", "device", "err_class", "err_msg", "duration_s", "at"]
    history = events.groupBy("source_path", "stage").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("h"))
    start = F.struct(*[F.lit(None).cast(TYPES[f]).alias(f) for f in FIELDS])
    folded = history.withColumn("s", F.aggregate("h", start, step))
    return folded.select("source_path", "stage", *[F.col("s")[f].alias(f) for f in FIELDS])
