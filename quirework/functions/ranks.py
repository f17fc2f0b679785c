"""Order-dependent values without putting one key's rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.session import cut


def distributed_rank(df: DataFrame, key: str, order: str, out: str, buckets: int) -> DataFrame:
    """Zero-based position of each row among the rows of its ``key``.

    The rows of a key are spread over ``buckets`` by a hash of ``order`` (unique
    within the key); each bucket is ranked by itself and shifted by the sizes of
    the buckets before it. The numbering is deterministic, but follows (bucket,
    order), not order alone: right where any fixed numbering does.
    """
    spread = df.withColumn("_b", F.pmod(F.xxhash64(order), F.lit(buckets)))
    if buckets <= 1:
        w = Window.partitionBy(key).orderBy(order)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))
    sizes = spread.groupBy(F.col(key).alias("_k"), F.col("_b").alias("_bb")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_k").orderBy("_bb").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_k", "_bb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    w = Window.partitionBy(key, "_b").orderBy(order)
    ranked = spread.withColumn("_r", F.row_number().over(w) - 1)
    joined = ranked.join(shifts, (F.col(key).eqNullSafe(F.col("_k"))) & (F.col("_b") == F.col("_bb")))
    return joined.withColumn(out, (F.col("_r") + F.col("_shift")).cast("bigint")).drop("_k", "_bb", "_n", "_b", "_r", "_shift")


def next_in_sequence(df: DataFrame, key: str, order: str, value: Column, out: str, span: int = 4096) -> DataFrame:
    """``value`` of the following row of the same ``key`` by the integer ``order``.

    ``lead`` over a whole key would bring a huge key into one task. Rows are
    windowed by (key, order div span); only the first row of each such chunk
    takes part in the window over the key, so that window is ``span`` times
    smaller. Rows with a null order have no successor.
    """
    chunk = F.floor(F.col(order) / F.lit(span))
    base = df.withColumn("_c", chunk).withColumn("_v", value)
    inner = Window.partitionBy(key, "_c").orderBy(order)
    base = base.withColumn("_next", F.lead("_v").over(inner)).withColumn("_last", F.lead(order).over(inner).isNull())
    firsts = df.where(F.col(order).isNotNull()).groupBy(F.col(key).alias("_k"), chunk.alias("_cc")).agg(F.min_by(value, F.col(order)).alias("_first"))
    outer = Window.partitionBy("_k").orderBy("_cc")
    firsts = firsts.select("_k", "_cc", F.lead("_first").over(outer).alias("_after"))
    joined = base.join(firsts, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_c") == F.col("_cc")), "left")
    picked = F.when(F.col("_last"), F.col("_after")).otherwise(F.col("_next"))
    return joined.withColumn(out, picked).drop("_c", "_v", "_next", "_last", "_k", "_cc", "_after")


def last_in_sequence(df: DataFrame, key: str, order: str, value: str, out: str, span: int = 4096) -> DataFrame:
    """The last non-null ``value`` of the rows before each row of the same ``key``, in chunks as above."""
    chunk = F.floor(F.col(order) / F.lit(span))
    base = df.withColumn("_c", chunk)
    inner = Window.partitionBy(key, "_c").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    base = base.withColumn("_here", F.last(value, ignorenulls=True).over(inner))
    lasts = df.where(F.col(value).isNotNull() & F.col(order).isNotNull()).groupBy(F.col(key).alias("_k"), chunk.alias("_cc")).agg(F.max_by(value, order).alias("_lastv"))
    chunks = df.where(F.col(order).isNotNull()).select(F.col(key).alias("_k"), chunk.alias("_cc")).distinct().join(lasts, ["_k", "_cc"], "left")
    outer = Window.partitionBy("_k").orderBy("_cc").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("_k", "_cc", F.last("_lastv", ignorenulls=True).over(outer).alias("_earlier"))
    joined = base.join(chunks, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_c") == F.col("_cc")), "left")
    return joined.withColumn(out, F.coalesce("_here", "_earlier")).drop("_c", "_here", "_k", "_cc", "_earlier")


def running(df: DataFrame, key: str, order: list[Column | str], **sums: Column) -> DataFrame:
    """Adds sums over the rows of ``key`` up to and with each row, in ``order``: a rank from 1 is the sum of ones.

    The rows are cut into ranges of (key, order), so a key with a third of all rows
    lies in many; each range is summed by itself and shifted by the sums of the
    ranges before it. The ranges are kept in the shared folder, so that each row
    stays in its range. ``order`` should be total; equal rows may come either way.
    """
    spark = df.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    base = df.withColumns({f"_o{i}": c for i, c in enumerate(columns)} | {f"_s_{name}": c for name, c in sums.items()})
    names = [f"_o{i}" for i in range(len(columns))]
    base = cut(base.repartitionByRange(ranges, key, *names).withColumn("_p", F.spark_partition_id()))
    totals = base.groupBy(F.col(key).alias("_k"), F.col("_p").alias("_pp")).agg(*[F.sum(f"_s_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy("_k").orderBy("_pp").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_k", "_pp", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_h_{n}") for n in sums])
    here = Window.partitionBy(key, "_p").orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    summed = base.withColumns({f"_r_{n}": F.sum(f"_s_{n}").over(here) for n in sums})
    joined = summed.join(shifts, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_p") == F.col("_pp")))
    out = joined.withColumns({n: F.col(f"_r_{n}") + F.col(f"_h_{n}") for n in sums})
    return out.drop("_k", "_pp", "_p", *names, *[f"_{x}_{n}" for n in sums for x in ("s", "r", "h", "t")])
