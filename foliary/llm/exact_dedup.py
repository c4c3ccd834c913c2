"""Exact deduplication as a stateful stream whose keyed state lives on disk and never expires.

State holds, per SHA-256 digest of a whole text, the number of rows, the largest stable
identifier and the content locator (file and row) of that row. A digest with more than one row
is a hit: the full bytes of its rows are compared with those of the row that the locator names,
and rows that differ (two texts of one digest) are settled on the bytes themselves.

Cases: a null text counts as empty; equal texts form one group whatever their source; among rows
that repeat an identifier too, the locator decides, so exactly one row of a group is kept;
columns other than identifier and text are neither read nor returned, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARRIVAL = "digest binary, doc_id bigint, file string, place bigint"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # many small stores: no space set aside for logs, and only changes are uploaded
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def located(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, file, place: each row with the place where its content can be read again.

    Anything but a plain file scan is first written to the shared folder.
    """
    want = [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")]
    try:
        return docs.select(*want, *place)
    except AnalysisException:
        return common.written(docs.select(*want), "located").select("doc_id", "text", *place)


def digests(rows: DataFrame) -> DataFrame:
    return rows.select(F.unhex(F.sha2(F.col("text"), 256)).alias("digest"), "doc_id", "file", "place")


def keyed_state(arrivals: DataFrame) -> DataFrame:
    """The running state per digest; on a stream, kept in the state store without a watermark, so forever."""
    return arrivals.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "place")).alias("best"), F.count(F.lit(1)).alias("n"))


def run_stream(spark: SparkSession, feed: str, checkpoint: str, out: str, partitions: int | None = None) -> None:
    """Take in every arrival file that the checkpoint has not seen and write the digests whose state
    changed to `out`/batch=N. A batch that is run again replaces its own folder."""

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    was = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(ARRIVAL).parquet(feed)
        query = (
            keyed_state(stream)
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(save)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest_state(spark: SparkSession, out: str) -> DataFrame:
    """The last state written for each digest."""
    schema = "digest binary, best struct<doc_id:bigint,file:string,place:bigint>, n bigint, batch int"
    log = spark.read.schema(schema).parquet(out)
    last = log.groupBy("digest").agg(F.max_by(F.struct("best", "n"), "batch").alias("s"))
    return last.select("digest", "s.best", "s.n")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, file, place."""
    spark = docs.sparkSession
    rows = located(docs, id_col, text_col)
    feed, state = common.new_folder(spark, "arrivals"), common.new_folder(spark, "dedup-state")
    digests(rows).write.parquet(feed)
    arrivals = spark.read.schema(ARRIVAL).parquet(feed)
    if arrivals.isEmpty():
        best = keyed_state(arrivals)
    else:
        run_stream(spark, feed, f"{state}/checkpoint", f"{state}/out")
        best = latest_state(spark, f"{state}/out")

    # hits: rows of a digest seen before or again. All texts move once, to their digests; rows of
    # digests that are alone stop there, and only hits are written for the comparison of bytes.
    marked = arrivals.join(best, "digest")
    texts = rows.withColumn("digest", F.unhex(F.sha2(F.col("text"), 256)))
    hits = best.filter("n > 1").select("digest", F.col("best.file").alias("best_file"), F.col("best.place").alias("best_place"))
    pairs = common.written(texts.join(hits, "digest"), "hits")
    kept_text = pairs.filter("file = best_file and place = best_place").select("digest", F.col("text").alias("best_text"))
    differ = pairs.join(kept_text, "digest").filter(F.col("text") != F.col("best_text"))
    differ = common.written(differ.select("digest", "doc_id", "text", "file", "place"), "collisions")

    # normally empty: rows whose bytes differ from their digest's best row form groups by bytes
    by_text = Window.partitionBy("text")
    own = differ.select(
        "file", "place",
        F.max(F.struct("doc_id", "file", "place")).over(by_text).alias("own_best"),
        F.count(F.lit(1)).over(by_text).alias("own_n"),
    )
    lost = differ.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    if not differ.isEmpty():
        marked = marked.join(own, ["file", "place"], "left").join(lost, "digest", "left")
        best_col, n = F.coalesce("own_best", "best"), F.coalesce("own_n", F.col("n") - F.coalesce("lost", F.lit(0)))
    else:
        best_col, n = F.col("best"), F.col("n")
    marked = marked.withColumn("b", best_col).withColumn("size", n)
    return marked.select(
        "doc_id",
        F.col("b.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.struct("doc_id", "file", "place").eqNullSafe(F.col("b")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "file",
        "place",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The kept rows with all their columns."""
    file, place = common.free_name(docs, "_file"), common.free_name(docs, "_place")
    where = [F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place)]
    try:
        rows = docs.select("*", *where)
    except AnalysisException:
        docs = common.written(docs, "documents")
        rows = docs.select("*", *where)
    kept = exact_dedup(docs).filter("kept").select(F.col("file").alias(file), F.col("place").alias(place))
    return rows.join(kept, [file, place], "left_semi").select(*docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = exact_dedup(common.documents(spark, sf_dir))
    return got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
