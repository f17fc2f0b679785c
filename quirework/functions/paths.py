"""Path expressions: one spelling for every way of writing the same path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_file_uri(path: Column | str) -> Column:
    """``file:`` URIs become plain paths; percent escapes are undone only there.

    ``+`` stands for itself in a path, so it is protected from form decoding, and
    an escape that is malformed leaves the text as it is.
    """
    p = _col(path)
    is_uri = F.lower(F.substring(p, 1, 5)) == "file:"
    bare = F.regexp_replace(p, r"^(?i:file):(//(?i:localhost)?(?=/))?", "")
    decoded = F.try_url_decode(F.regexp_replace(bare, r"\+", "%2B"))
    return F.when(is_uri, F.coalesce(decoded, bare)).otherwise(p)


def canonical_path(path: Column | str) -> Column:
    """The path without scheme, empty and ``.`` segments, ``..`` resolved.

    ``..`` above the root of an absolute path is dropped; above the start of a
    relative path it stays. Letter case matters. Null stays null.
    """
    p = decode_file_uri(path)
    parts = F.filter(F.split(p, "/"), lambda s: (s != "") & (s != "."))
    absolute = p.startswith("/")

    def step(acc: Column, seg: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        up = (seg == "..") & last.isNotNull() & (last != "..")
        return (
            F.when(up, F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
            .when((seg == "..") & absolute, acc)
            .otherwise(F.concat(acc, F.array(seg)))
        )

    resolved = F.when(
        F.exists(parts, lambda s: s == ".."),
        F.aggregate(parts, F.array().cast("array<string>"), step),
    ).otherwise(parts)
    return F.when(p.isNotNull(), F.concat(F.when(absolute, F.lit("/")).otherwise(F.lit("")), F.array_join(resolved, "/")))


def parent_dir(path: Column | str) -> Column:
    """Everything before the last slash; empty where there is none."""
    return F.regexp_replace(_col(path), r"/?[^/]*$", "")


def base_name(path: Column | str) -> Column:
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)


def stem(name: Column | str) -> Column:
    """The name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(_col(name), r"(?<=.)\.[^./]*$", "")


def suffix(name: Column | str) -> Column:
    """The last suffix in lower case, with its dot; empty where there is none."""
    return F.lower(F.regexp_extract(_col(name), r".(\.[^./]*)$", 1))


def is_within(path: Column | str, root: Column | str) -> Column:
    """Component-wise containment: ``/a/bc`` is not within ``/a/b``."""
    p, r = F.split(_col(path), "/"), F.split(F.regexp_replace(_col(root), r"/+$", ""), "/")
    return (F.size(p) >= F.size(r)) & (F.slice(p, F.lit(1), F.greatest(F.size(r), F.lit(1))) == r)


def ancestors(path: Column | str) -> Column:
    """Every prefix of the path at a slash, itself included: containment as an equi-join key."""
    parts = F.split(_col(path), "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
