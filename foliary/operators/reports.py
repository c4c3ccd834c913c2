"""Reports over matters, listings and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import extension_of
from ..rules.doc_types import DOC_TYPES
from .classify import doc_types


def contains(column: Column, text: str) -> Column:
    """Case-insensitive pattern; null is no match."""
    return F.coalesce(column.rlike("(?i)" + text), F.lit(False))


def filter_matters(df: DataFrame, stage: str = "", case_type: str = "", search: str = "", since: str = "", until: str = "", paid: bool = False, include_rm: bool = False) -> DataFrame:
    if not include_rm:
        df = df.filter(~F.col("not_in_use"))
    if stage:
        df = df.filter(contains(F.col("stage"), stage))
    if case_type:
        df = df.filter(contains(F.col("case_type"), case_type))
    if search:
        all_ = F.concat_ws(" ", F.coalesce("matter", F.lit("")), F.coalesce("client", F.lit("")), F.coalesce("email", F.lit("")))
        df = df.filter(contains(all_, search))
    if since:
        df = df.filter(F.col("signed") >= F.lit(since).cast("timestamp"))
    if until:
        df = df.filter(F.col("signed") <= F.lit(until).cast("timestamp"))
    return df.filter("paid") if paid else df


def summary_by(df: DataFrame, column: str) -> DataFrame:
    """Per value, nulls too: matters, with a book value, its total, paid and the share of all."""
    out = df.groupBy(column).agg(
        F.count(F.lit(1)).alias("matters"), F.count("book_value").alias("with_value"), F.round(F.coalesce(F.sum("book_value"), F.lit(0.0)), 2).alias("total_value"), F.count_if("paid").alias("paid"))
    # the groups are few; their total needs no second pass over the matters
    total = F.sum("matters").over(Window.partitionBy(F.lit(1)))
    return out.withColumn("percent", F.round(100.0 * F.col("matters") / total, 1)).orderBy(F.desc("matters"), column)


def by_month(df: DataFrame, last: int = 12) -> DataFrame:
    months = df.filter("signed is not null").groupBy(F.date_format("signed", "yyyy-MM").alias("month"))
    out = months.agg(F.count(F.lit(1)).alias("matters"), F.round(F.coalesce(F.sum("book_value"), F.lit(0.0)), 2).alias("total_value"), F.count_if("paid").alias("paid"))
    return out.orderBy(F.desc("month")).limit(last)


def overall_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("matters"), F.count_distinct("client").alias("clients"), F.count("book_value").alias("with_value"),
        F.round(F.sum("book_value"), 2).alias("total_value"), F.count_if("paid").alias("paid"),
        F.min(F.col("signed").cast("date")).alias("first_signed"), F.max(F.col("signed").cast("date")).alias("last_signed"),
    )


def top_matters(df: DataFrame, by: str = "book_value", n: int = 20) -> DataFrame:
    return df.filter(F.col(by).isNotNull()).orderBy(F.desc(by), "matter_id").limit(n)


def missing_values(df: DataFrame, cols: list[str]) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot("_all", cols, "column", "missing").filter("missing > 0")
    return long.select("column", "missing", F.round(100.0 * F.col("missing") / F.col("_all"), 1).alias("percent")).orderBy(F.desc("missing"), "column")


def file_type_profile(listing: DataFrame, by: str = "exp", most: int = 10) -> DataFrame:
    """Per case or folder and extension: files and MB, the commonest extensions only."""
    per = listing.groupBy(by, extension_of(F.col("name")).alias("extension")).agg(F.count(F.lit(1)).alias("files"), F.round(F.sum("size") / 1048576.0, 2).alias("mb"))
    order = Window.partitionBy(by).orderBy(F.desc("files"), "extension")
    return per.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def search_cases(listing: DataFrame, text: str) -> DataFrame:
    return listing.filter(F.lower("exp").contains(text.lower())).groupBy("exp").agg(F.count(F.lit(1)).alias("files"))


def stratified_sample(cases: DataFrame, n: int) -> DataFrame:
    """n cases: the same number of each (template, section), topped up from the rest by name."""
    strata = cases.select("template", "section").distinct()
    quota = F.greatest(F.floor(F.lit(n) / F.greatest(F.col("_strata"), F.lit(1))), F.lit(1))
    order = Window.partitionBy("template", "section").orderBy("folder")
    ranked = cases.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n)  # no stratum gives more
    count = strata.agg(F.count(F.lit(1)).alias("_strata"))
    ranked = ranked.withColumn("_k", F.lit(1)).join(F.broadcast(count.withColumn("_k", F.lit(1))), "_k")
    return ranked.withColumn("_extra", F.col("_r") > quota).orderBy("_extra", "template", "section", "folder").limit(n).drop("_r", "_k", "_strata", "_extra")


def type_certainty_counts(spark: SparkSession, rules: list[tuple] = DOC_TYPES) -> DataFrame:
    return doc_types(spark, rules).groupBy("certainty").agg(F.count(F.lit(1)).alias("types"))


def verdict_counts(df: DataFrame, column: str = "verdict") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def archive_yield(entries: DataFrame) -> DataFrame:
    """Per archive: entries read of all, MB read of all. Entries have archive, size and text."""
    read = F.coalesce(F.trim("text") != "", F.lit(False))
    return entries.groupBy("archive").agg(
        F.count_if(read).alias("read"), F.count(F.lit(1)).alias("entries"),
        F.round(F.sum(F.when(read, F.col("size")).otherwise(0)) / 1048576.0, 2).alias("mb_read"), F.round(F.sum("size") / 1048576.0, 2).alias("mb"),
    )
