"""From a recognition library's objects to plain page JSON, and what identifies a pipeline."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Mapping
from numbers import Integral, Real

PAGE_FIELDS = ("rec_texts", "rec_text", "rec_polys", "dt_polys")
PREDICT_FLAGS = ("use_doc_orientation_classify", "use_doc_unwarping", "use_textline_orientation")


def json_safe(value: object, at: str = "$") -> object:
    """Plain JSON data: arrays and scalars of numeric libraries by their own conversion, anything else is an error that names its place."""
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, Integral):
        return int(value)
    if isinstance(value, Real):
        return float(value)
    if isinstance(value, Mapping):
        bad = [k for k in value if not isinstance(k, str)]
        if bad:
            raise TypeError(f"{at}: key {bad[0]!r} is no text")
        return {k: json_safe(v, f"{at}.{k}") for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [json_safe(v, f"{at}[{i}]") for i, v in enumerate(value)]
    if callable(plain := getattr(value, "tolist", None)):
        return json_safe(plain(), at)
    raise TypeError(f"{at}: {type(value).__name__} is no JSON")


def page_of(result: object) -> dict:
    """The page object of a result: its ``json`` export before its own keys, without an envelope."""
    data = getattr(result, "json", None)
    data = data() if callable(data) else data
    data = result if data is None else data
    if not isinstance(data, Mapping):
        raise TypeError(f"{type(result).__name__} gives no page object")
    inner = data.get("res")
    if isinstance(inner, Mapping) and not any(f in data for f in PAGE_FIELDS):
        data = inner
    return json_safe(data)


class PipelineRecogniser:
    """A recogniser around a library's pipeline; ``create`` must be importable by the workers."""

    def __init__(self, create: Callable[..., object], **options: object):
        self.create, self.options = create, pipeline_options(**options)
        self.pipeline: object | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"pipeline": None}  # every process makes its own

    def setup(self) -> None:
        self.pipeline = self.create(**self.options)

    def predict(self, source: str) -> list[dict]:
        if self.pipeline is None:
            self.setup()
        run = getattr(self.pipeline, "predict_iter", None) or self.pipeline.predict
        found: Iterable = run(input=source)
        return [page_of(r) for r in found]


def pipeline_options(device: str = "auto", **options: object) -> dict:
    """What a pipeline is made with: unset options and the automatic device are left out."""
    return {k: v for k, v in {"device": None if device == "auto" else device, **options}.items() if v is not None}


def predict_flags(given: Mapping[str, object] | None = None) -> dict[str, bool]:
    """The three switches of recognition, off unless given; only booleans count."""
    out = dict.fromkeys(PREDICT_FLAGS, False) | dict(given or {})
    for k, v in out.items():
        if k not in PREDICT_FLAGS or not isinstance(v, bool):
            raise ValueError(f"not a recognition switch: {k}={v!r}")
    return out


def sha256_of(path: str, block: int = 1 << 20) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while data := f.read(block):
            h.update(data)
    return h.hexdigest()


def pipeline_identity(ref: str | os.PathLike) -> dict:
    """A file by its path, size and checksum, anything else by its name; a path object must exist."""
    path = os.path.realpath(os.path.expanduser(os.fspath(ref)))
    if os.path.isfile(path):
        return {"type": "file", "path": path, "size": os.path.getsize(path), "sha256": sha256_of(path)}
    if isinstance(ref, os.PathLike):
        raise FileNotFoundError(path)
    return {"type": "name", "value": ref}


def cpu_config(config: Mapping) -> dict:
    """A copy of a pipeline configuration that runs without a GPU."""
    out = {k: dict(v) if isinstance(v, Mapping) else v for k, v in config.items()}
    section = out.setdefault("Global", {})
    section["device"] = "cpu"
    for k in ("use_gpu", "gpu_id"):
        section.pop(k, None)
    return out
