"""Best-fit packing of token sequences by hierarchical residual packing.

Each input partition tokenizes its documents, cuts longer ones and packs its pieces best-fit
decreasing. Bins that are full to within `slack` tokens are final. Underfull bins become items, one row a bin,
of the next round: they are dealt into groups of about `most_items`, each packed best-fit, and so up the tree, until
no two open bins anywhere fit into one. What can't fit any other open bin leaves the tree at once. When
more than one group was packed, at most one bin a group is half empty, and one group of those and of as
many bins with the most room settles the rest; so no group holds more than about `most_items` rows, however many
partitions there are. The driver sees a histogram of bin lengths alone, `capacity` rows at most.

Cases: a null text is empty and gives one piece, the end id alone; a document of exactly the
capacity is one piece; a very long text is cut into as many pieces as it needs, by the one task that reads it;
equal rows are packed one by one; ties go to the bin opened first; an empty table gives no rows; columns
other than identifier and text are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
BIN = "bin long, offset long, bin_length long"
NAMES = [c.split()[0] for c in f"{PIECE}, {BIN}".split(", ")]
PLACED = "bin long, into long, shift long, bin_length long"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item, best fit decreasing: into the fullest bin that has room.

    Bins stand in stacks by their room; a bit mask of the rooms in use finds the tightest one.
    """
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[at])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            stack = stacks[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, opened
            opened += 1
        bins[at], offsets[at] = b, capacity - room
        room -= n
        if room:
            stacks[room].append(b)
            rooms |= 1 << room
    return bins, offsets


def cut(texts: list[str | None], ids: list[int | None], path: str, capacity: int, end_id: int) -> Iterator[tuple]:
    encode, end, width = tokens.encoder(path).batches, np.array([end_id], dtype="<u4").tobytes(), 4 * capacity
    for at, blobs in encode(texts):
        for doc, blob in zip(ids[at:], blobs):
            blob += end
            for k in range(0, len(blob), width):
                part = blob[k : k + width]
                yield doc, k // width, k // 4, len(part) // 4, zlib.crc32(part)


def first_round(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(at, tokens.ROWS) for b in batches for at in range(0, b.num_rows, tokens.ROWS))
        rows = [r for p in parts for r in cut(p.column("text").to_pylist(), p.column("doc_id").to_pylist(), path, capacity, end_id)]
        if rows:
            doc, piece, start, length, crc = zip(*rows)
            bins, offset = best_fit(np.array(length), capacity)
            full = np.bincount(bins, weights=length).astype(np.int64)[bins]
            number = (TaskContext.get().partitionId() << 32) + bins
            columns = [doc, pa.array(piece, type=pa.int32()), start, length, crc, number, offset, full]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=pa.int64()) for c in columns], names=NAMES)

    return run


def next_round(capacity: int):
    """Bins of a group as items: into which bin each goes, named by the smallest of its bins, and where."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin", kind="stable")
        bins, shift = best_fit(rows["bin_length"].to_numpy(), capacity)
        rows = rows.assign(new=bins, shift=shift)
        whole = rows.groupby("new")
        return pd.DataFrame({"bin": rows["bin"], "into": whole["bin"].transform("min"), "shift": shift, "bin_length": whole["bin_length"].transform("sum")})

    return run


def longest_to_merge(lengths: dict[int, int], capacity: int, most_items: int, again: bool) -> int:
    """Bins up to this length can still merge with another; 0 if no two bins can. `lengths` counts bins by length."""
    order = sorted(lengths)
    two = [n for n in order for _ in range(min(2, lengths[n]))][:2]
    if len(two) < 2 or sum(two) > capacity:
        return 0
    reach = capacity - two[0]
    if again and sum(c for n, c in lengths.items() if n <= reach) > most_items:
        # only a bin that is half empty can take another: as many partners as there are of those will do
        small = sum(c for n, c in lengths.items() if n <= capacity // 2)
        for n in order:
            if n > capacity // 2:
                small -= lengths[n]
            if n >= reach or n > capacity // 2 and small <= 0:
                return min(n, reach)
    return reach


def merged(bins: DataFrame, capacity: int, most_items: int) -> DataFrame:
    """Where each open bin (bin, bin_length) ends: bin, into, shift, bin_length. Bins that stay alone are in it too."""
    placed = bins.select("bin", F.col("bin").alias("into"), F.lit(0).cast("long").alias("shift"), "bin_length")
    for level in itertools.count():
        heads = placed.filter("bin = into").select("bin", "bin_length")
        lengths = {r["bin_length"]: r["count"] for r in heads.groupBy("bin_length").count().collect()}
        reach = longest_to_merge(lengths, capacity, most_items, level > 0)
        if not reach:
            return placed
        rows = sum(c for n, c in lengths.items() if n <= reach)
        group = F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(-(-rows // most_items))).alias("group")
        dealt = heads.filter(F.col("bin_length") <= reach).select("*", group)
        step = common.written(dealt.groupBy("group").applyInPandas(next_round(capacity), PLACED), "bins")
        step = step.select(F.col("bin").alias("into"), F.col("into").alias("_into"), F.col("shift").alias("_shift"), F.col("bin_length").alias("_length"))
        moved = placed.join(step, "into", "left")
        moved = moved.select("bin", F.coalesce("_into", "into").alias("into"), (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift"), F.coalesce("_length", "bin_length").alias("bin_length"))
        placed = common.written(moved, "placed")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, slack: int = 16, most_items: int = 100_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, sequence_length."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = common.written(texts.mapInArrow(first_round(tokenizer, capacity, end_id), f"{PIECE}, {BIN}"), "pieces")
    full = F.col("bin_length") >= capacity - slack
    piece = ["doc_id", "piece", "start", "length", "ids_crc32"]
    done = rows.filter(full).select(*piece, F.col("bin").alias("sequence_id"), "offset", F.col("bin_length").alias("sequence_length"))
    bins = rows.filter(~full).filter("offset = 0").select("bin", "bin_length")
    placed = merged(common.written(bins, "open-bins"), capacity, most_items)
    left = rows.filter(~full).drop("bin_length").join(placed, "bin")
    left = left.select(*piece, F.col("into").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"), F.col("bin_length").alias("sequence_length"))
    return done.unionByName(left)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pack(common.documents(spark, sf_dir), tokens.public_path("word_bpe_49k.json"), 4096, 1)
    return got.drop("sequence_length")
