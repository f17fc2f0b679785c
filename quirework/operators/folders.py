"""Folders of scanned books: numbered images, pairs of folders, names derived from names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.names import IMAGE_SUFFIXES, page_number
from quirework.functions.paths import stem, suffix
from quirework.operators.validate import page_sequences


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def numbered_images(files: DataFrame) -> DataFrame:
    """Page images of (dir, name) with ``page_no``; names without a page number are none."""
    return files.where(suffix("name").isin(*IMAGE_SUFFIXES)).withColumn("page_no", page_number("name")).where("page_no IS NOT NULL")


def image_sequences(files: DataFrame) -> DataFrame:
    """(dir, status, n_pages, last_page, missing): are the pages of each folder whole?"""
    return page_sequences(numbered_images(files), "dir", "page_no")


def folder_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names of folders that both sides have."""
    return left.select("name").distinct().join(right.select("name").distinct(), "name", "left_semi")


def folders_with_images(files: DataFrame) -> DataFrame:
    return files.where(suffix("name").isin(*IMAGE_SUFFIXES)).select("dir").distinct()


def moved(path: Column | str, source: str, target: str) -> Column:
    """The path below ``target`` that answers to one below ``source``; null for other paths."""
    p = _c(path)
    return F.when(p.startswith(source.rstrip("/") + "/"), F.concat(F.lit(target.rstrip("/")), F.substring(p, F.lit(len(source.rstrip("/")) + 1), F.length(p))))


def books_to_build(json_dirs: DataFrame, image_dirs: DataFrame, done: DataFrame, source: str, target: str) -> DataFrame:
    """(dir, images, state): build, done, or no images for each folder of results."""
    rows = json_dirs.select("dir", moved("dir", source, target).alias("images")).distinct()
    rows = rows.join(image_dirs.select(F.col("dir").alias("images"), F.lit(True).alias("_i")).distinct(), "images", "left")
    rows = rows.join(done.select("dir", F.lit(True).alias("_d")).distinct(), "dir", "left")
    return rows.select("dir", "images", F.when(F.col("_d"), "done").when(F.col("_i"), "build").otherwise("no images").alias("state"))


def images_of_results(results: DataFrame, images: DataFrame, suffixes: tuple[str, ...] = (".png", ".jpg", ".jpeg")) -> DataFrame:
    """Results of (dir, page_no) with ``image``: the first of the suffixes under which the page is there."""
    wanted = results.select("dir", "page_no", F.posexplode(F.array(*[F.format_string(f"page_%05d{s}", F.col("page_no")) for s in suffixes])).alias("pos", "name"))
    best = wanted.join(images.select("dir", "name").distinct(), ["dir", "name"]).groupBy("dir", "page_no").agg(F.min_by("name", "pos").alias("image"))
    return results.join(best, ["dir", "page_no"], "left")


def result_by_stem(images: DataFrame, results: DataFrame) -> DataFrame:
    """Images of (dir, name) with ``result``: the smallest ``<stem>..._result.json`` of the folder that starts with the stem.

    Prefixes become keys: every result offers its own prefixes of the stems' lengths.
    """
    i = images.select("dir", "name", stem("name").alias("_s"))
    lengths = i.select("dir", F.length("_s").alias("_n")).distinct()
    r = results.where(F.col("name").endswith("_result.json")).select("dir", F.col("name").alias("_r"))
    offered = r.join(lengths, "dir").where(F.length("_r") >= F.col("_n")).select("dir", "_r", F.substring("_r", F.lit(1), F.col("_n")).alias("_s"))
    best = offered.groupBy("dir", "_s").agg(F.min("_r").alias("result"))
    return i.join(best, ["dir", "_s"], "left").select("dir", "name", "result")


def anywhere(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """(name, path): each wanted name with the first path under the tree that has it."""
    first = files.groupBy("name").agg(F.min("path").alias("path"))
    return wanted.select("name").distinct().join(first, "name", "left")


def expected_name_by_folder(folder: Column | str, page: Column) -> Column:
    """Result name from a folder ``K<book>_<volume>_<extra>`` and a page; null if the folder has fewer parts."""
    parts = F.split(_c(folder), "_")
    pad = lambda c, n: F.when(F.length(c) >= n, c).otherwise(F.lpad(c, n, "0"))
    book = F.regexp_replace(F.get(parts, F.lit(0)), "^K+", "")
    return F.when(F.size(parts) >= 3, F.concat(pad(book, 4), F.lit("_"), pad(F.get(parts, F.lit(1)), 3), F.lit("_"), F.get(parts, F.lit(2)), F.lit("_"), pad(page.cast("string"), 2), F.lit(".json")))


def expected_name_by_stem(name: Column | str) -> Column:
    """``<stem>.json`` if the stem has four parts or its last part is a number, else null."""
    s = stem(name)
    parts = F.split(s, "_")
    return F.when((F.size(parts) >= 4) | F.element_at(parts, -1).rlike("^[0-9]+$"), F.concat(s, F.lit(".json")))


def last_lines(log: DataFrame, key: str, order: str, n: int = 3) -> DataFrame:
    """The last ``n`` lines of each log: the rows with the ``n`` largest ``order`` values."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return log.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")
