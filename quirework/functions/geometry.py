"""Geometry of recognised lines: reading order, rectangles, character boxes, font size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Everything Python's and the page writers' blank test strips.
BLANKS = r"[\s\x1c-\x1f\x85\xa0  -     　]"


def is_blank(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return c.rlike(f"^{BLANKS}*$")


def min_xy(polygon: Column | str) -> tuple[Column, Column]:
    """Smallest x and smallest y over the points, each by itself."""
    return F.array_min(F.transform(polygon, lambda p: p["x"])), F.array_min(F.transform(polygon, lambda p: p["y"]))


def reading_order(lines: DataFrame, page: list[str], width: str = "width") -> DataFrame:
    """Adds ``reading_no``: left column from top to bottom, then the right one; blank lines are left out.

    A line belongs to the left column if its smallest x is less than half the width;
    lines at one height keep their order.
    """
    x, y = min_xy("polygon")
    kept = lines.where(~is_blank("text")).withColumn("_right", x >= F.col(width) / 2).withColumn("_y", y)
    order = Window.partitionBy(*page).orderBy("_right", "_y", "line_no")
    return kept.withColumn("reading_no", F.row_number().over(order)).drop("_right", "_y")


def text_rect(polygon: Column | str, x_scale: float | Column = 1.0, y_scale: float | Column = 1.0, y_offset: int = 0) -> Column:
    """struct<x0,y0,x1,y1> of the first and third point, truncated towards zero, then moved down."""
    p = F.col(polygon) if isinstance(polygon, str) else polygon
    xs = x_scale if isinstance(x_scale, Column) else F.lit(float(x_scale))
    ys = y_scale if isinstance(y_scale, Column) else F.lit(float(y_scale))
    at = lambda i, f, s: (F.get(p, F.lit(i))[f] * s).try_cast("bigint")
    return F.struct(at(0, "x", xs).alias("x0"), (at(0, "y", ys) + y_offset).alias("y0"), at(2, "x", xs).alias("x1"), (at(2, "y", ys) + y_offset).alias("y1"))


def rect_error(rect: Column) -> Column:
    """Text for a rectangle without area, else null."""
    return F.when((rect["x1"] <= rect["x0"]) | (rect["y1"] <= rect["y0"]), "text rectangle has no area")


def char_box(coords: Column, mode: str, x_scale: Column, y_scale: Column) -> Column:
    """struct<x0,y0,x1,y1> of a character's 4 or 8 numbers, null for any other count or no area.

    ``extent``: smallest and largest of all x and all y of eight numbers, four as
    they are. ``corners``: integers; each side from the two corners that bound it.
    """
    c = coords
    every = lambda start: F.filter(c, lambda _, i: i % 2 == start)
    if mode == "extent":
        eight = F.struct(
            F.array_min(every(0)).cast("double").alias("x0"), F.array_min(every(1)).cast("double").alias("y0"),
            F.array_max(every(0)).cast("double").alias("x1"), F.array_max(every(1)).cast("double").alias("y1"),
        )
        four = F.struct(*[F.get(c, F.lit(i)).cast("double").alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])
    else:
        g = lambda i: F.get(c, F.lit(i)).try_cast("bigint").cast("double")
        eight = F.struct(F.least(g(0), g(6)).alias("x0"), F.least(g(1), g(3)).alias("y0"), F.greatest(g(2), g(4)).alias("x1"), F.greatest(g(5), g(7)).alias("y1"))
        four = F.struct(*[g(i).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])
    box = F.when(F.size(c) == 8, eight).when(F.size(c) == 4, four)
    scaled = F.struct((box["x0"] * x_scale).alias("x0"), (box["y0"] * y_scale).alias("y0"), (box["x1"] * x_scale).alias("x1"), (box["y1"] * y_scale).alias("y1"))
    sound = box.isNotNull() & (scaled["x1"] > scaled["x0"]) & (scaled["y1"] > scaled["y0"])
    return F.when(sound, scaled)


def font_size(text: Column, width: Column, height: Column, metric: Callable[[Column, Column], Column] | None = None, steps: int = 200) -> Column:
    """Font size that fits: 0.9 of the height, lowered by 1 while the text is too wide, kept within 1 and 100.

    ``metric(text, size)`` gives the width. Without one a character is as wide as the
    size, and the number of steps follows by division; the steps around it are tried,
    so that rounding decides nothing.
    """
    measure = metric or (lambda t, s: F.length(t) * s)
    start = height * F.lit(0.9)
    if metric:
        tries = F.sequence(F.lit(0), F.lit(steps))
    else:
        widest = F.when(F.length(text) == 0, start).otherwise(width / F.greatest(F.length(text), F.lit(1)))
        near = F.ceil(start - F.greatest(F.lit(1.0), widest)).cast("int")
        tries = F.sequence(F.greatest(near - 1, F.lit(0)), F.greatest(near + 1, F.lit(0)))
    fits = F.filter(F.transform(tries, lambda i: start - i), lambda s: (s <= 1) | (measure(text, s) <= width))
    return F.greatest(F.lit(1.0), F.least(F.lit(100.0), F.coalesce(F.get(fits, F.lit(0)), F.lit(1.0))))


def baseline(y0: Column, size: Column) -> Column:
    return y0 + F.lit(0.85) * size


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, not once per element of an array inside."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def threshold(pixels: Column) -> Column:
    """Mean less half the population deviation, within 0 and 255."""

    def limit(s: Column) -> Column:
        n, mean = F.size(s["p"]).cast("double"), s["mean"]
        spread = F.sqrt(F.aggregate(s["p"], F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n)
        return F.greatest(F.lit(0.0), F.least(F.lit(255.0), mean - spread / 2))

    numbers = F.transform(pixels, lambda x: x.cast("double"))
    mean = F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x) / F.size(pixels)
    return _let(F.struct(numbers.alias("p"), mean.alias("mean")), limit)


def binarise(pixels: Column) -> Column:
    """255 where a pixel is above the threshold, else 0."""
    both = F.struct(pixels.alias("p"), threshold(pixels).alias("t"))
    return _let(both, lambda s: F.transform(s["p"], lambda x: F.when(x.cast("double") > s["t"], 255).otherwise(0)))
