"""Token ids in ORC: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are dealt to ranges of their id, sorted, encoded and written, one ORC file per range,
so the files in order of their numbers give the ids in order. Stripes are read in parallel; a look-up by id
prunes files and stripes by their statistics and row groups by the Bloom filter.

Cases: a null text is empty and gives the end id alone; rows that repeat an id stand side by side,
in the order of their texts' checksums; an empty table gives no files and no rows; columns other
than identifier and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

#: Words that a worker's cache holds.
CACHED = 800_000
SCHEMA = "doc_id long, n_tokens long, ids array<int>"


def encode_batches(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokens.encoder(path, CACHED).batches, np.array([end_id], dtype="<u4").tobytes()
        for b in (b.slice(at, tokens.ROWS) for b in batches for at in range(0, b.num_rows, tokens.ROWS)):
            ids = b.column("doc_id")
            for at, blobs in encode(b.column("text").to_pylist()):  # bounded output
                ends = np.cumsum([0, *(len(x) // 4 + 1 for x in blobs)])
                flat = pa.array(np.frombuffer(b"".join(x + end for x in blobs), dtype="<i4"), type=pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([ids[at : at + len(blobs)], pa.array(np.diff(ends), type=pa.int64()), lists], names=["doc_id", "n_tokens", "ids"])

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, stripe_bytes: int = 64 << 20, stride: int = 1000,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # range borders come from the ids alone; texts are read once and moved once
    borders = common.borders_of(rows, "doc_id", parts)
    dealt = rows.withColumn("_place", common.place_among(borders, F.col("doc_id"))).repartitionById(len(borders) + 1, F.col("_place"))
    dealt = dealt.sortWithinPartitions("doc_id", F.crc32(F.coalesce("text", F.lit("")))).select("doc_id", "text")
    (
        dealt.mapInArrow(encode_batches(tokenizer, end_id), SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(stride))
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens, ids of all files. A filter on doc_id is pushed down to the files' indexes."""
    return spark.read.schema(SCHEMA).orc(path)


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("ids")
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(ends[:-1], ends[1:])]
        columns = [b.column("file"), b.column("doc_id"), pa.array(np.diff(ends), type=pa.int64()), pa.array(crc, type=pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "doc_id", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, all from the ids read back. Files are in the order of the number in their
    names, so running sums are taken in each file, then over the files."""
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")  # as a number: part-100000 comes after part-99999
    ids = read_tokens(spark, path).select(number.alias("file"), "doc_id", "ids")
    rows = common.written(ids.mapInArrow(checksums, "file long, doc_id long, n_tokens long, ids_crc32 long"), "token-index")
    return common.prefix_sums(rows, [], ["doc_id", "ids_crc32", "n_tokens"], "n_tokens", "start", bucket_key="file").drop("file")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_folder(spark, "tokens")
    write_tokens(common.documents(spark, sf_dir), path, tokens.public_path("byte_bpe_50k.json"), 2)
    return token_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
