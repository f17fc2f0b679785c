"""Names of page images and recognition results, and the orders of files and pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions.paths import stem

IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".bmp", ".tif", ".tiff")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def page_number(name: Column | str) -> Column:
    """The number of the first ``page_<digits>`` anywhere in the name, in any case; null without one."""
    return F.try_to_number(F.nullif(F.regexp_extract(_col(name), r"(?i)page_([0-9]+)", 1), F.lit("")), F.lit("9" * 18)).cast("bigint")


def candidate_names(name: Column | str) -> Column:
    """Names under which the result of an image may be stored, best first, without repeats."""
    n, s = page_number(name), stem(name)
    numbered = F.array(*[F.format_string(p, n) for p in ("page_%05d.json", "page_%04d_result.json", "page_%04d.json", "page_%03d.json")])
    plain = F.array(*[F.concat(s, F.lit(x)) for x in ("_result.json", ".json", "_ocr.json")])
    return F.array_distinct(F.concat(F.when(n.isNotNull(), numbered).otherwise(F.array().cast("array<string>")), plain))


def result_name(rel: Column | str) -> Column:
    """Where the result of the image ``rel`` goes: the same folder, ``<stem>_result.json``."""
    return F.concat(F.regexp_replace(_col(rel), r"(?<=[^/])\.[^./]*$", ""), F.lit("_result.json"))


def artifact_root(out: str, source_index: Column | str, rel: Column | str) -> Column:
    """Folder of a PDF's artifacts: one branch per configured source, then its path without suffix."""
    return F.format_string("%s/source-%03d/pdf/%s", F.lit(out), _col(source_index), F.regexp_replace(_col(rel), r"(?<=[^/])\.[^./]*$", ""))


def walk_key(rel: Column | str) -> Column:
    """Sort key of a top-down walk: in each folder its files, then its subfolders, both by name."""
    parts = F.split(_col(rel), "/")
    return F.transform(parts, lambda x, i: F.struct(F.when(i == F.size(parts) - 1, 0).otherwise(1).alias("deeper"), x.alias("name")))


def natural_key(text: Column | str) -> Column:
    """Sort key in which runs of digits count as numbers; digits come before other text."""
    runs = F.regexp_extract_all(_col(text), F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    return F.transform(
        runs,
        lambda r: F.struct(
            F.when(r.rlike("^[0-9]"), 0).otherwise(1).alias("kind"),
            F.when(r.rlike("^[0-9]"), r.try_cast("decimal(38,0)")).alias("number"),
            F.when(~r.rlike("^[0-9]"), r).alias("text"),
        ),
    )


def book_rank(name: Column | str, covers: bool = True) -> Column:
    """Place of a scanned leaf's kind in a book: front cover, title, preface, contents, plates, pages, back cover, rest.

    Without ``covers`` every cover has the place before the rest, as older books were ordered.
    """
    n = F.lower(_col(name))
    first, last = (-1, 5) if covers else (5, 5)
    rank = F.when(n.startswith("cov001"), first).when(n.startswith("bok"), 0).when(n.startswith("leg"), 1).when(n.startswith("fow"), 2).when(n.startswith("!"), 3).when(n.rlike("^[0-9]"), 4)
    return rank.when(n.startswith("cov002") if covers else n.startswith("cov"), last).otherwise(6)


def book_key(name: Column | str, covers: bool = True) -> Column:
    n = F.lower(_col(name))
    leading = F.nullif(F.regexp_extract(n, r"^([0-9]{1,18})", 1), F.lit("")).cast("bigint")
    return F.struct(book_rank(name, covers).alias("rank"), F.coalesce(leading, F.lit(0)).alias("number"), natural_key(n).alias("natural"))


def duration(seconds: Column | str) -> Column:
    """HH:MM:SS with any number of hours."""
    s = F.floor(_col(seconds)).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.expr("1") * F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def human_bytes(n: Column | str) -> Column:
    """A size in the largest binary unit that keeps it at 1 or more, one decimal; unknown for null."""
    size, out = _col(n).cast("double"), None
    for i, unit in enumerate(("B", "KiB", "MiB", "GiB", "TiB")):
        value = F.format_string(f"%.1f {unit}", size / float(1024**i))
        last = unit == "TiB"
        fits = F.lit(True) if last else size < float(1024 ** (i + 1))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.when(size.isNull(), "unknown").otherwise(out)


def local_time(ts: Column | str, hours: int = 8) -> Column:
    """A UTC timestamp as text in the zone ``hours`` ahead."""
    return F.date_format(_col(ts) + F.expr(f"INTERVAL {hours} HOURS"), "yyyy-MM-dd HH:mm:ss")
