"""Orders and joins that no single task carries: numbers in a global order, and joins on keys that very many rows share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

#: No more keys than this are called hot, so a broadcast of them has a fixed bound.
MOST_HOT = 10_000


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows in a global order, with `_part` (a range of the order) and `_row`, which rises with it. Borders are sampled, the ranges written once, so that
    both stay what they are when a task runs again."""
    ordered = df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    return written(ordered, "ranges")


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds each row's number (from 1) in a global order: its place in its range behind all rows of the ranges before."""
    rows = in_ranges(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(parts, "_part").withColumn(out, F.col("_before") + F.col("_row") - F.col("_first") + 1).drop("_part", "_row", "_first", "_before")


def spread_join(many: DataFrame, one: DataFrame, key: str, row: str = "id", how: str = "inner", most: int = 100_000, counted: DataFrame | None = None) -> DataFrame:
    """Join with a table that has each key once and wide columns, where some keys have very many rows.

    A key with more than `most` rows is dealt by a hash of `row` to parts of about `most`, and its one wide row is copied to
    each part only. At most MOST_HOT keys are hot: `most` rises with the rows where there would be more. Rows are counted in `counted`, where a
    table that is cheaper than `many` has no fewer, and by a hash of the key: keys that share one are dealt alike."""
    counts = (many if counted is None else counted).filter(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    counts = written(counts.filter(F.col("_n") > most), "hot")
    rows = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if not rows:
        return many.join(one, key, how)
    most = max(most, -(-rows // MOST_HOT))
    hot = F.broadcast(counts.filter(F.col("_n") > most).select("_key", F.ceil(F.col("_n") / most).cast("int").alias("_parts")))
    dealt = many.withColumn("_key", F.xxhash64(key)).join(hot, "_key", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(row), F.col("_parts")), F.lit(0)).cast("int")).drop("_parts", "_key")
    copied = one.withColumn("_key", F.xxhash64(key)).join(hot, "_key", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0))))).drop("_parts", "_key")
    return dealt.join(copied, [key, "_part"], how).drop("_part")
