"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: at line ends, at sentence marks and, in long runs without any, where
a hash of the bytes before a space says so, so that an edit changes only the paragraphs it touches.
Each distinct paragraph's 64-bit digest goes to one cell in each of three subtables; a cell has a
count, a sum of digests and a sum of check values. The sketches of two versions subtract cell
by cell, and peeling cells with one digest left recovers the paragraphs that only one version
has. If cells remain, the comparison is made again with sketches four times as large and other
hashes, up to a size at which it all but always ends; the last resort compares the digests.
The fingerprint is the smallest sketch, as text; likeness is shared paragraphs over all.

Cases: a null text is empty, has no paragraphs and is like another empty one (1.0) and unlike the
rest (0.0); equal texts have equal fingerprints; rows that repeat an id follow one another in the
order of their texts' digests; a lone document is its own next; an empty table gives no
rows; other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .shingles import BASE, BYTES, INVERSE, mixed, powers

SLICE = 1 << 20
SUBTABLES = 3
#: Cells of the stored sketch, and how much larger each retry is.
CELLS, LARGER = 15, 4
ENDS = np.zeros(256, dtype=bool)
ENDS[[10, 13, 33, 44, 46, 59, 63]] = True


def paragraph_digests(data: bytes) -> np.ndarray:
    """Distinct digests of a text's paragraphs, sorted. Long texts go slice by slice, from border to border."""
    found, lo = [], 0
    while lo < len(data):
        x = np.frombuffer(data, dtype=np.uint8, count=min(SLICE, len(data) - lo), offset=lo)
        w = x.astype(np.uint32)
        border = ENDS[x]
        if len(x) > 4:
            h = w[3:-1] * np.uint32(2654435761) + w[2:-2] * np.uint32(2246822519) + w[1:-3] * np.uint32(3266489917) + w[:-4] * np.uint32(668265263)
            border[4:] |= (x[4:] == 32) & ((h >> np.uint32(15)) % np.uint32(12) == 0)
        ends = np.flatnonzero(border) + 1
        last = lo + len(x) >= len(data)
        if last and (not len(ends) or ends[-1] != len(x)):
            ends = np.append(ends, len(x))
        if not len(ends):
            ends = np.array([len(x)])  # a slice without any border
        starts = np.r_[0, ends[:-1]]
        sums = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(BYTES[x] * powers(BASE, len(x)), out=sums[1:])
        found.append(mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(x) + 1)[starts] + (ends - starts).astype(np.uint64)))
        lo += int(ends[-1])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def check_of(digest: np.ndarray) -> np.ndarray:
    return mixed(digest ^ np.uint64(0xA0761D6478BD642F))


def cell_of(digest: np.ndarray, sub: int, cells: int) -> np.ndarray:
    """Cell in subtable `sub`; each size of sketch hashes anew."""
    each = cells // SUBTABLES
    return sub * each + (mixed(digest + np.uint64(1 + sub + SUBTABLES * cells)) % np.uint64(each)).astype(np.int64)


class Sketches:
    """Sketches of many texts side by side: text i has cells i * cells up to (i + 1) * cells."""

    def __init__(self, texts: int, cells: int):
        self.texts, self.cells = texts, cells
        self.count = np.zeros(texts * cells, dtype=np.int64)
        self.key = np.zeros(texts * cells, dtype=np.uint64)
        self.check = np.zeros(texts * cells, dtype=np.uint64)

    def add(self, text: np.ndarray, digest: np.ndarray, sign: np.ndarray) -> None:
        factor = sign.astype(np.uint64)  # -1 wraps to the inverse in modular sums
        key, check = digest * factor, check_of(digest) * factor
        for sub in range(SUBTABLES):
            at = text * self.cells + cell_of(digest, sub, self.cells)
            np.add.at(self.count, at, sign)
            np.add.at(self.key, at, key)
            np.add.at(self.check, at, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, digest and sign of all that can be recovered, and which texts came out whole."""
        texts, digests, signs = [], [], []
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[at]
            digest = self.key[at] * sign.astype(np.uint64)
            pure = check_of(digest) * sign.astype(np.uint64) == self.check[at]
            at, sign, digest = at[pure], sign[pure], digest[pure]
            if not len(at):
                break
            text = at // self.cells
            order = np.lexsort((digest, text))
            text, digest, sign = text[order], digest[order], sign[order]
            new = np.r_[True, (text[1:] != text[:-1]) | (digest[1:] != digest[:-1])]
            text, digest, sign = text[new], digest[new], sign[new]
            self.add(text, digest, -sign)
            texts.append(text)
            digests.append(digest)
            signs.append(sign)
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        whole = ~left.reshape(self.texts, self.cells).any(axis=1)
        empty = np.zeros(0, dtype=np.int64)
        return (
            np.concatenate(texts) if texts else empty,
            np.concatenate(digests) if digests else empty.astype(np.uint64),
            np.concatenate(signs) if signs else empty,
            whole,
        )

    def text(self, i: int) -> str:
        s = slice(i * self.cells, (i + 1) * self.cells)
        packed = self.count[s].astype("<i4").tobytes() + self.key[s].astype("<u8").tobytes() + self.check[s].astype("<u4").tobytes()
        return base64.b64encode(packed).decode()


def sketched(sets: list[np.ndarray], cells: int) -> Sketches:
    out = Sketches(len(sets), cells)
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    out.add(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), flat, np.ones(len(flat), dtype=np.int64))
    return out


def differences(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of versions, how many paragraphs only the first has and how many only the second."""
    only = np.zeros((2, len(a)), dtype=np.int64)
    todo, cells = np.arange(len(a)), CELLS
    while len(todo):
        both = sketched([a[i] for i in todo], cells)
        other = sketched([b[i] for i in todo], cells)
        both.count -= other.count
        both.key -= other.key
        both.check -= other.check
        text, _, sign, whole = both.peel()
        for side, s in ((0, 1), (1, -1)):
            only[side, todo] = np.bincount(text[sign == s], minlength=len(todo))
        todo = todo[~whole]
        last = [i for i in todo if cells >= LARGER * (len(a[i]) + len(b[i]) + CELLS)]
        for i in last:
            shared = len(np.intersect1d(a[i], b[i], assume_unique=True))
            only[:, i] = len(a[i]) - shared, len(b[i]) - shared
        todo, cells = np.setdiff1d(todo, last), cells * LARGER
    return only[0], only[1]


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    first, second = differences(a, b)
    n = np.array([len(x) for x in a])
    union = n + second
    return np.where(union > 0, (n - first) / np.maximum(union, 1), 1.0)


def fingerprint_texts(sets: list[np.ndarray]) -> list[str]:
    all_ = sketched(sets, CELLS)
    return [f"{len(s)}:{all_.text(i)}" for i, s in enumerate(sets)]


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(rows: list[tuple[int, str]], after: str) -> pd.DataFrame:
    """Results of some rows in order; `after` is the text behind the last."""
    texts = [t for _, t in rows]
    edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, [*texts[1:], after])]
    raw = [e.encode("utf-8", "replace") for e in edited]
    sets = [paragraph_digests(t.encode("utf-8", "replace")) for t in [*texts, after]]
    new = [paragraph_digests(e) for e in raw]
    return pd.DataFrame(
        {
            "doc_id": [d for d, _ in rows],
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(e).hexdigest() for e in raw],
            "fingerprint": fingerprint_texts(sets[:-1]),
            "edited_fingerprint": fingerprint_texts(new),
            "near_edited": likeness(sets[:-1], new),
            "near_next": likeness(sets[:-1], sets[1:]),
        }
    )


def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come in order; those marked `ahead` only serve the row before them."""
    rows: list[tuple[int, str]] = []
    size, over = 0, False
    for b in batches:
        for doc, text, ahead in zip(b["doc_id"], b["text"], b["ahead"]):
            if over:
                continue
            if rows and (ahead or size >= SLICE):
                yield compared(rows, text)
                rows, size = [], 0
            over = ahead
            if not ahead:
                rows.append((doc, text))
                size += len(text)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt to ranges of the id and sorted downwards. The first row of each range also stands, marked
    `ahead`, at the end of the range above it, and the very first behind the very last."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id")
    place = common.place_among(common.borders_of(ids, "doc_id", parts), F.col("doc_id"))
    # one row per range, so never more than there are partitions
    heads = sorted(ids.withColumn("place", place).groupBy("place").agg(F.max("doc_id")).collect())
    above = [(h[1], heads[(i + 1) % len(heads)][0]) for i, h in enumerate(heads)] or [(0, 0)]
    extra = F.broadcast(spark.createDataFrame(above, "head long, extra int"))
    rows = rows.withColumn("place", place).join(extra, F.col("doc_id") == F.col("head"), "left")
    here = F.struct(F.col("place"), F.lit(False).alias("ahead"))
    there = F.struct(F.col("extra").alias("place"), F.lit(True).alias("ahead"))
    to = F.when(F.col("head").isNull(), F.array(here)).otherwise(F.array(here, there))
    rows = rows.select("doc_id", "text", F.inline(to))
    dealt = rows.repartitionById(max(1, len(heads) and heads[-1][0] + 1), F.col("place"))
    return dealt.sortWithinPartitions("place", "ahead", F.desc("doc_id"), F.sha2("text", 256)).select("doc_id", "text", "ahead")


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all documents and of their edited versions, with the likeness of each to its
    edited version and to the next document."""
    return with_next(docs, id_col, text_col).mapInPandas(walk, COLUMNS)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(common.documents(spark, sf_dir))
