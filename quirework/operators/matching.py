"""Images, results and configured roots brought together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.names import IMAGE_SUFFIXES, candidate_names, result_name, walk_key
from quirework.functions.paths import ancestors, suffix
from quirework.functions.ranks import running


def image_tasks(files: DataFrame, out_dir: str) -> DataFrame:
    """Images of (root, rel, ...) with their result path and ``task_index`` in walk order."""
    images = files.where(suffix("rel").isin(*IMAGE_SUFFIXES))
    ranked = running(images, "root", [walk_key("rel"), "rel"], task_index=F.lit(1))  # a root may hold all images there are
    return ranked.withColumn("output_json", F.concat(F.lit(out_dir + "/"), result_name("rel"))).withColumn("task_index", (F.col("task_index") - 1).cast("int"))


def output_collisions(tasks: DataFrame, by: str = "output_json", order: str = "task_index") -> DataFrame:
    """Tasks that write what an earlier task writes already, with ``first_owner``."""
    w = Window.partitionBy(by).orderBy(order)
    ranked = tasks.withColumn("_n", F.row_number().over(w)).withColumn("first_owner", F.first(order).over(w))
    return ranked.where("_n > 1").drop("_n")


def match_results(images: DataFrame, results: DataFrame) -> DataFrame:
    """Images of (dir, name) with ``result_name``: the first candidate that ``results`` (dir, name) has, null without one.

    Candidates are exploded with their place and met by an equi-join; the smallest
    place wins, whatever order the join gives.
    """
    wanted = images.select("dir", "name", F.posexplode(candidate_names("name")).alias("pos", "candidate"))
    have = results.select("dir", F.col("name").alias("candidate")).distinct()
    best = wanted.join(have, ["dir", "candidate"]).groupBy("dir", "name").agg(F.min_by("candidate", "pos").alias("result_name"))
    return images.join(best, ["dir", "name"], "left")


def missing_results(images: DataFrame, results: DataFrame) -> DataFrame:
    """Images for which no candidate exists."""
    wanted = images.select("dir", "name", F.explode(candidate_names("name")).alias("candidate"))
    found = wanted.join(results.select("dir", F.col("name").alias("candidate")), ["dir", "candidate"], "left_semi").select("dir", "name").distinct()
    return images.join(found, ["dir", "name"], "left_anti")


def not_done(tasks: DataFrame, done: DataFrame, key: str = "output_json") -> DataFrame:
    return tasks.join(done.select(key).distinct(), key, "left_anti")


def json_parents(files: DataFrame) -> DataFrame:
    """Folders that directly hold a name ending in ``.json`` (small letters only)."""
    return files.where(F.col("name").endswith(".json")).select("dir").distinct()


def counts_per_source(sources: DataFrame, files: DataFrame) -> DataFrame:
    """Files per configured source, sources without any included."""
    n = files.groupBy("source_index").agg(F.count(F.lit(1)).alias("n"))
    return sources.join(n, "source_index", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def within_roots(paths: DataFrame, roots: DataFrame, path: str = "path", root: str = "root") -> DataFrame:
    """Paths that lie in any root, by whole components.

    Containment as an equi-join: every ancestor of a path is a key, so no
    nested loop over all pairs is needed.
    """
    keyed = paths.select(path).distinct().withColumn("_a", F.explode(ancestors(path)))
    clean = roots.select(F.regexp_replace(root, r"/+$", "").alias("_a")).distinct()
    inside = keyed.join(clean, "_a", "left_semi").select(path).distinct()
    return paths.join(inside, path, "left_semi")
