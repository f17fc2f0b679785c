"""Page sequences and expected against actual pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.ranks import next_in_sequence


def page_sequences(pages: DataFrame, doc: str, page: str, preview: int = 10) -> DataFrame:
    """(doc, status, n_pages, last_page, missing): ok, duplicate, gap or invalid per document.

    Pages are counted per (document, number) first. Gaps are found between
    neighbours, in chunks of a document, and never written out in full: ``missing``
    shows the first ``preview`` numbers and ``...`` if there are more, so neither a
    huge document nor a damaged number makes a huge group. Rows without a number
    are no pages; a document with none at all has no row.
    """
    counted = pages.where(F.col(page).isNotNull()).groupBy(F.col(doc).alias("_doc"), F.col(page).cast("bigint").alias("_page")).agg(F.count(F.lit(1)).alias("_count"))
    per = counted.groupBy("_doc").agg(
        F.count(F.lit(1)).cast("int").alias("n_pages"), F.max("_count").alias("_most"), F.min("_page").alias("_first"), F.max("_page").alias("last_page"), F.count_if(F.col("_page") >= 1).alias("_numbered")
    )
    follow = next_in_sequence(counted, "_doc", "_page", F.col("_page"), "following")
    inner = follow.where("following > _page + 1 AND following > 1").select("_doc", F.greatest(F.col("_page") + 1, F.lit(1)).alias("_from"), (F.col("following") - 1).alias("_to"))
    before = per.where("_first > 1").select("_doc", F.lit(1).cast("bigint").alias("_from"), (F.col("_first") - 1).alias("_to"))
    # a last page below 1 leaves page 1 itself missing
    none = per.where("last_page < 1").select("_doc", F.lit(1).cast("bigint").alias("_from"), F.lit(1).cast("bigint").alias("_to"))
    gaps = inner.unionByName(before).unionByName(none)
    early = gaps.withColumn("_n", F.row_number().over(Window.partitionBy("_doc").orderBy("_from"))).where(F.col("_n") <= preview)
    numbers = early.select("_doc", F.explode(F.sequence("_from", F.least("_to", F.col("_from") + preview - 1))).alias("_gap"))
    shown = numbers.groupBy(F.col("_doc").alias("_d")).agg(F.array_join(F.slice(F.sort_array(F.collect_list("_gap")), 1, preview), ", ").alias("_shown"))
    out = per.join(shown, F.col("_doc").eqNullSafe(F.col("_d")), "left")
    missing = F.greatest(F.col("last_page"), F.lit(1)) - F.col("_numbered")
    status = F.when(F.col("_first") < 1, "invalid").when(F.col("_most") > 1, "duplicate").when(missing > 0, "gap").otherwise("ok")
    text = F.concat(F.coalesce("_shown", F.lit("")), F.when(missing > preview, "...").otherwise(""))
    return out.select(F.col("_doc").alias(doc), status.alias("status"), "n_pages", "last_page", text.alias("missing"))


def expected_against_actual(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Rows on one side only, with ``side``: missing or extra."""
    e = expected.select(*keys).distinct().withColumn("_e", F.lit(True))
    a = actual.select(*keys).distinct().withColumn("_a", F.lit(True))
    both = e.join(a, keys, "full_outer")
    return both.where("_e IS NULL OR _a IS NULL").select(*keys, F.when(F.col("_a").isNull(), "missing").otherwise("extra").alias("side"))
