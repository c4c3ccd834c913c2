"""Shared helpers: the cluster's shared folder, written tables and distributed prefix sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Stands for a null identifier inside operators; the largest, so that it never is the smallest of a class.
NO_ID = 2**63 - 1
#: A word is a maximal run of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where none is named and Spark is local, as in tests, a local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="foliary-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a table in the shared folder: lost executors can't lose them."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Number of words in a text (null: 0), without a regular expression in the hot path."""
    for c in ("\t", "\n", "\u000b", "\f", "\r"):
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.coalesce(F.size(F.array_remove(F.split(text, " "), "")), F.lit(0)).cast("long")


def prefix_sums(
    df: DataFrame, group: list[str], order: list[str], value: str, out: str, per_bucket: int = 20_000, bucket_key: str | None = None
) -> DataFrame:
    """Exclusive running sum of `value` inside each group, without one task per group.

    Rows are dealt to buckets by a hash of the order columns, or by `bucket_key` (a column that
    rises with the order) where the order itself matters. A group's order is then (bucket, order
    columns); each window holds one bucket, and only the buckets' totals are summed a second
    time. Null group values form a group of their own.
    """
    if bucket_key is None:
        n = max(1, -(-df.count() // per_bucket))
        df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)))
    else:
        df = df.withColumn("_bucket", F.col(bucket_key))
    names = [f"_g{i}" for i in range(len(group))]
    # a null-safe copy of each group column: a hash would be unsafe, a struct is exact
    for g, c in zip(names, group):
        df = df.withColumn(g, F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")))
    keys = [*names, "_bucket"]
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    totals = totals.select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return local.join(totals, keys).withColumn(out, (F.col("_before") + F.col("_local")).cast("long")).drop("_before", "_local", *keys)


def borders_of(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most parts - 1 borders that cut a long column into nearly equal ranges. Only the column is read."""
    shares = [i / parts for i in range(1, parts)]
    return sorted({int(x) for x in (df.approxQuantile(key, shares, 0.25 / parts) or [])}) if shares else []


def place_among(borders: list[int], key: Column) -> Column:
    """How many borders are at or below the key (null: none), by a coarse and a fine look, so a row costs about 2 * sqrt(borders)."""
    if not borders:
        return F.lit(0)
    step = max(1, int(len(borders) ** 0.5))
    every = F.array(*[F.lit(b).cast("long") for b in borders])
    coarse = F.array(*[F.lit(b).cast("long") for b in borders[::step]])
    blocks = F.size(F.filter(coarse, lambda b: b <= key))
    start = F.greatest(blocks - 1, F.lit(0)) * step
    return F.coalesce(start + F.size(F.filter(F.slice(every, start + 1, F.lit(step)), lambda b: b <= key)), F.lit(0)).cast("int")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Column | None]:
    """The rows with a number each, in a column `name`: the id or, where ids are null or repeat, a hash of id and text, so that rows
    which differ are told apart; and which rows have such a hash (None: none has)."""
    again = free_name(docs, "_again")
    known = F.col(id_col).cast("long")
    ids = docs.select(known.alias(again))
    repeats = written(ids.filter(F.col(again).isNotNull()).groupBy(again).count().filter("count > 1").select(again), "repeated-ids")
    some, nulls = not repeats.isEmpty(), not ids.filter(F.col(again).isNull()).isEmpty()
    if not some and not nulls:
        return docs.withColumn(name, known), None
    docs = docs.join(repeats, known == F.col(again), "left") if some else docs.withColumn(again, F.lit(None).cast("long"))
    odd = known.isNull() | F.col(again).isNotNull()
    return docs.withColumn(name, F.when(odd, F.xxhash64(known, F.col(text_col))).otherwise(known)), odd
