"""Declared schemas; nothing is ever inferred from job or page data."""

from pyspark.sql import types as T

_TYPES = {"string": T.StringType, "bigint": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType}


def _struct(ddl: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]()) for name, kind in (x.split() for x in ddl.split(", "))])


JOBS = _struct(
    "source_path string, stage string, source_size bigint, source_mtime_ns bigint, status string, result_path string, "
    "retry_count bigint, error_class string, error_message string, worker string, device string, started_at string, "
    "finished_at string, duration_s double, intended_result_path string, execution_profile_json string"
)
#: Tables written before provenance was kept lack the last two columns.
JOBS_LEGACY = T.StructType(JOBS.fields[:14])
STATUSES = ("pending", "running", "success", "failed")
STAGES = ("ocr", "render", "searchable_pdf")

EVENTS = _struct(
    "source_path string, stage string, seq bigint, op string, size bigint, mtime_ns bigint, req_result string, req_profile string, "
    "result string, worker string, device string, err_class string, err_msg string, duration_s double, at string"
)

FILES = _struct(
    "root string, path string, rel string, dir string, name string, is_dir boolean, is_symlink boolean, size bigint, mtime_ns bigint"
)
