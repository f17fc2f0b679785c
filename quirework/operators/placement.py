"""Where recognised text goes on a page: the plan that a document builder follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import geometry


def placement(lines: DataFrame, page: list[str], y_offset: int = 0, ordered: bool = True, metric=None) -> DataFrame:
    """(page keys, line_no, reading_no, text, x0, y0, x1, y1, font_size, baseline, error) of each visible line.

    ``lines`` has ``polygon`` (array of x, y), ``text``, ``line_no`` and the page's
    ``width``. With ``ordered`` the left column is read before the right one and text
    hangs on a baseline; otherwise lines keep their order and hang from their top, as
    older layouts did. A rectangle without area has an error and no font size.
    """
    if ordered:
        rows = geometry.reading_order(lines, page)
    else:
        rows = lines.where(~geometry.is_blank("text")).withColumn("reading_no", F.col("line_no") + 1)
    rows = rows.withColumn("_r", geometry.text_rect("polygon", y_offset=y_offset))
    error = geometry.rect_error(F.col("_r"))
    width, height = (F.col("_r.x1") - F.col("_r.x0")).cast("double"), (F.col("_r.y1") - F.col("_r.y0")).cast("double")
    size = F.when(error.isNull(), geometry.font_size(F.col("text"), width, height, metric))
    rows = rows.withColumn("error", error).withColumn("font_size", size)
    top = F.col("_r.y0").cast("double")
    hang = geometry.baseline(top, F.col("font_size")) if ordered else top
    return rows.select(*page, "line_no", "reading_no", "text", "_r.*", "font_size", F.when(F.col("error").isNull(), hang).alias("baseline"), "error")


def char_placement(chars: DataFrame, doc: list[str], mode: str, image_width: Column, image_height: Column, x_offset: float = 0.0, y_offset: float = 0.0) -> DataFrame:
    """(doc keys, char_no, char, x0, y0, x1, y1, font_size) of character-level results.

    ``chars`` has chars array<string>, coors array<array<double>>, Width and Height.
    Characters without 4 or 8 numbers, or without area, are left out. A page whose
    two arrays are not of one length is left out as a whole: ``uneven_pages`` has it.
    """
    chars = chars.where(F.size("chars") == F.size("coors"))
    zipped = chars.select(*doc, (image_width / F.col("Width")).alias("_sx"), (image_height / F.col("Height")).alias("_sy"), F.posexplode(F.arrays_zip("chars", "coors")).alias("char_no", "_z"))
    boxed = zipped.where("_z.chars IS NOT NULL AND _z.coors IS NOT NULL").withColumn("_b", geometry.char_box(F.col("_z.coors"), mode, F.col("_sx"), F.col("_sy")))
    boxed = boxed.where("_b IS NOT NULL")
    width, height = F.col("_b.x1") - F.col("_b.x0"), F.col("_b.y1") - F.col("_b.y0")
    size = geometry.font_size(F.col("_z.chars"), width, height)
    move = lambda c, by: (F.col(f"_b.{c}") + by).alias(c)
    return boxed.select(*doc, "char_no", F.col("_z.chars").alias("char"), move("x0", x_offset), move("y0", y_offset), move("x1", x_offset), move("y1", y_offset), size.alias("font_size"))


def uneven_pages(chars: DataFrame, doc: list[str]) -> DataFrame:
    """(doc keys, n_chars, n_coors) of the pages that ``char_placement`` leaves out; a null array has length null."""
    sizes = [F.when(F.col(c).isNotNull(), F.size(c)).alias(n) for c, n in (("chars", "n_chars"), ("coors", "n_coors"))]
    return chars.select(*doc, *sizes).where(~(F.coalesce(F.col("n_chars"), F.lit(-1)) == F.coalesce(F.col("n_coors"), F.lit(-2))))


def checked_documents(built: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, error): documents that are missing, empty or of another page count than expected."""
    j = expected.select(key, F.col("pages").alias("_want")).join(built.select(key, "pages", "n_bytes", "is_symlink"), key, "left")
    error = F.coalesce(
        F.when(F.col("n_bytes").isNull(), "missing"), F.when(F.col("is_symlink"), "a link"), F.when(F.col("n_bytes") == 0, "empty"),
        F.when(~F.col("pages").eqNullSafe(F.col("_want")), F.concat(F.lit("has "), F.coalesce(F.col("pages").cast("string"), F.lit("no")), F.lit(" pages, not "), F.col("_want").cast("string"))),
    )
    return j.select(key, error.alias("error")).where("error IS NOT NULL")
