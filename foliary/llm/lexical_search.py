"""Ranked lexical search: the best documents of each item by weighted term frequencies, exactly.

Scores are whole numbers, so results don't hang on the order of sums. A document's profile (its number of terms, and those
among the items' terms with their frequencies) is taken in one pass over the texts; numbers of documents, terms and
documents of a term are aggregated from profiles. Postings with their impacts are dealt to groups of
documents by a hash of the row. A group holds, for each term, a posting list in the order of documents with a
sparse table of range maxima over the impacts. For an item, intervals of documents are opened best first: the sum over its terms
of the largest impact inside bounds every score of the interval. An opened interval is split at the document of its
largest impact, which is scored; what is left of and right of it gets bounds of its own. An interval whose bound can't
reach the ten best so far is never opened. Many intervals are opened at a time, as arrays. Each group's best rows of each
item are ranked once more over all groups.

Items are taken in blocks of at most `block_terms` terms (one item at least), which travel with the tasks. Their vocabulary filters
profiles inside the tasks if it has at most `most_bytes` bytes, and by a join beyond.

Cases: a null or empty text has no term, isn't counted and never found; rows that repeat an id are documents of their own, and
of equal scores the smaller id comes first, a null id last, then the row read first; rows of items that share an id (null too)
are one item with the terms of all; an item without a term, or with none that any document has, gives no rows; very long texts are taken
whole; empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
TO_TERMS = bytes.maketrans(SEPARATORS + bytes(range(65, 91)), b" " * len(SEPARATORS) + bytes(range(97, 123)))
#: Intervals that are opened at a time.
AT_ONCE = 512
#: Buckets in which terms are numbered.
BUCKETS = 1024


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and anything beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(TO_TERMS).split()


def flat(column: list, kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, column)])
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array([x for c in column for x in c], type=kind))


def profiles(docs: DataFrame, number: dict[bytes, int] | None) -> DataFrame:
    """Per row with a term: _row, doc_id, n, and its terms with their frequencies: as numbers, those that `number` has, or all as text (None)."""
    kind, sql = (pa.string(), "string") if number is None else (pa.int32(), "int")
    sent = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for b in batches:
            for at in range(0, b.num_rows, 500):  # bounded output
                part = b.slice(at, 500)
                counts, n = [], []
                for text in part.column("text").to_pylist():
                    all_ = terms_of(text)
                    n.append(len(all_))
                    counts.append(Counter(all_))
                if number is not None:
                    counts = [{number[t]: f for t, f in c.items() if t in number} for c in counts]
                else:
                    counts = [{t.decode(): f for t, f in c.items()} for c in counts]
                columns = [part.column("_row"), part.column("doc_id"), pa.array(n, type=pa.int64()), flat([c.keys() for c in counts], kind), flat([c.values() for c in counts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["_row", "doc_id", "n", "terms", "times"])

    found = docs.mapInArrow(run, f"_row long, doc_id long, n long, terms array<{sql}>, times array<long>")
    return common.written(found.filter("n > 0"), "profiles")


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item_id, term) of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [[t.decode() for t in dict.fromkeys(terms_of(x))] for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), flat(terms, pa.string())], names=["item_id", "terms"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "item_id long, terms array<string>").select("item_id", F.explode("terms").alias("term")).distinct()


class Postings:
    """Posting lists of a group of documents, one behind the other, with sparse tables of range maxima over the impacts."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int):
        order = np.lexsort((doc, term))
        self.docs, self.doc, self.impact = docs, doc[order], impact[order]
        term = term[order]
        self.terms, starts = np.unique(term, return_index=True)
        self.starts = np.append(starts, len(term))
        place = np.repeat(np.arange(len(self.terms)), np.diff(self.starts))
        self.keys = place * docs + self.doc  # rise all along
        # at[j][i]: where the largest impact of the 2**j postings from the i-th on is. Lists needn't be kept apart: no look crosses a border
        self.at = [np.arange(len(term), dtype=np.int32)]
        longest = int(np.diff(self.starts).max()) if len(term) else 0
        for j in range(1, longest.bit_length()):
            half = 1 << (j - 1)
            below = self.at[-1]
            left, right = below[:-half] if half < len(below) else below[:0], below[half:]
            self.at.append(np.where(self.impact[right] > self.impact[left], right, left))

    def maxima(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the largest impact in [a, b) is, for many ranges; -1 for an empty one."""
        out = np.full(a.shape, -1, dtype=np.int64)
        size = b - a
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        for j in np.unique(level[size > 0]):
            this = (level == j) & (size > 0)
            left, right = self.at[j][a[this]], self.at[j][b[this] - (1 << j)]
            out[this] = np.where(self.impact[right] > self.impact[left], right, left)
        return out

    def best(self, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best for an item with these terms, the best first, of equal ones the first in order."""
        at = np.searchsorted(self.terms, wanted)
        at = at[at < len(self.terms)][self.terms[at[at < len(self.terms)]] == wanted[at < len(self.terms)]]
        docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if not len(at):
            return docs, scores
        base = at * self.docs
        lo, hi = self.starts[at][None, :], self.starts[at + 1][None, :]  # postings of each open interval, by term
        top = self.maxima(lo, hi)
        peaks = np.where(top >= 0, self.impact[top], 0)
        bound, peak = peaks.sum(axis=1), top[np.arange(len(top)), peaks.argmax(axis=1)]
        first = np.zeros(1, dtype=np.int64)
        while len(bound):
            if len(bound) > AT_ONCE:
                order = np.argpartition(-bound, AT_ONCE)
                now, later = order[:AT_ONCE], order[AT_ONCE:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, dtype=np.int64)
            split = self.doc[peak[now]]
            here = np.searchsorted(self.keys, base[None, :] + split[:, None])  # first posting of each term at the document or behind it
            here = np.clip(here, lo[now], hi[now])
            inside = np.minimum(here, len(self.keys) - 1)
            has = (here < hi[now]) & (self.doc[inside] == split[:, None])
            docs = np.concatenate([docs, split])
            scores = np.concatenate([scores, np.where(has, self.impact[inside], 0).sum(axis=1)])
            best = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[best], scores[best]
            a, b = np.concatenate([lo[now], here + has]), np.concatenate([here, hi[now]])
            start = np.concatenate([first[now], split + 1])
            top = self.maxima(a, b)
            peaks = np.where(top >= 0, self.impact[top], 0)
            new = peaks.sum(axis=1)
            lead = top[np.arange(len(top)), peaks.argmax(axis=1)]
            lo, hi, bound = np.concatenate([lo[later], a]), np.concatenate([hi[later], b]), np.concatenate([bound[later], new])
            peak, first = np.concatenate([peak[later], lead]), np.concatenate([first[later], start])
            least, last = (scores[-1], docs[-1]) if len(docs) == k else (0, -1)
            open_ = (bound > least) | ((bound == least) & (first < last) & (bound > 0))
            lo, hi, bound, peak, first = lo[open_], hi[open_], bound[open_], peak[open_], first[open_]
        return docs, scores


def searched(sent: Broadcast, k: int):
    """Best rows of one group for each item, of (item_id, numbers of its terms)."""

    def run(group: pa.Table) -> pa.Table:
        items = sent.value
        column = lambda c: group.column(c).combine_chunks()
        row, known = column("_row").to_numpy(), column("doc_id")
        null = np.asarray(known.is_null())
        ids = known.fill_null(0).to_numpy()
        rows, where = np.unique(row, return_index=True)
        order = np.lexsort((rows, ids[where], null[where]))
        place = np.empty(len(rows), dtype=np.int64)
        place[order] = np.arange(len(rows))
        postings = Postings(place[np.searchsorted(rows, row)], column("term").to_numpy(), column("impact").to_numpy(), len(rows))
        found = [postings.best(terms, k) for _, terms in items]
        at = where[order][np.concatenate([d for d, _ in found])] if found else np.zeros(0, dtype=np.int64)
        item = [i for (i, _), (d, _) in zip(items, found) for _ in range(len(d))]
        score = np.concatenate([s for _, s in found]) if found else np.zeros(0, dtype=np.int64)
        return pa.table({"item_id": pa.array(item, type=pa.int64()), "doc_id": known.take(pa.array(at)), "_row": row[at], "score": score})

    return run


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, k1: tuple[int, int] = (1000, 8), b: int = 90, per_group: int = 500_000,
    block_terms: int = 100_000, most_bytes: int = 16 << 20,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0.

    A term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))); a document's length gives m = 100 - b + (b n N) div L; a term with frequency tf adds
    w * ((10^9 tf) div (k1[0] tf + k1[1] m)).
    """
    spark = docs.sparkSession
    wanted = common.written(item_terms(items, item_id_col, item_text_col), "item-terms")
    bucket = F.pmod(F.xxhash64("term"), F.lit(BUCKETS))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("term"))
    numbered = wanted.select("term").distinct().withColumn("bucket", bucket).withColumn("number", (rank * BUCKETS + F.col("bucket")).cast("int"))
    vocabulary = common.written(numbered.select("term", "number"), "vocabulary")
    size = vocabulary.agg(F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0))).first()[0]
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    fits = size <= most_bytes
    profile = profiles(rows, {r["term"].encode(): r["number"] for r in vocabulary.collect()} if fits else None)
    one = profile.select("_row", "doc_id", "n", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("times").alias("tf"))))
    if not fits:
        one = one.join(vocabulary, "term").select("_row", "doc_id", "n", F.col("number").alias("term"), "tf")
    total, length = profile.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = one.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * total + 2) / (2.0 * F.col("df") + 1)))
    weights = common.written(df.select("term", "df", weight.alias("w")), "weights")
    count = weights.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    m = 100 - b + F.expr(f"({b}L * n * {total}L) div {max(length, 1)}L")
    impact = F.col("w") * F.call_function("div", F.lit(10**9) * F.col("tf"), F.lit(k1[0]) * F.col("tf") + F.lit(k1[1]) * m)
    groups = F.pmod(F.xxhash64("_row"), F.lit(-(-count // per_group) or 1)).cast("int")
    postings = one.join(weights.select("term", "w"), "term").select(groups.alias("group"), "_row", "doc_id", "term", impact.alias("impact"))
    postings = postings.filter("impact > 0")
    # items in blocks of bounded size, each a search of its own
    sizes = wanted.join(vocabulary, "term").groupBy("item_id").agg(F.sort_array(F.collect_list("number")).alias("terms"))
    sizes = sizes.select("item_id", "terms", F.size("terms").cast("long").alias("size"))
    sizes = common.written(common.prefix_sums(sizes, [], ["item_id"], "size", "before").withColumn("block", F.expr(f"before div {block_terms}")), "items")
    found = None
    for (block,) in sizes.select("block").distinct().orderBy("block").toLocalIterator():
        here = [(r["item_id"], np.array(r["terms"], dtype=np.int32)) for r in sizes.filter(F.col("block") == block).select("item_id", "terms").collect()]
        part = postings.groupBy("group").applyInArrow(searched(spark.sparkContext.broadcast(here), k), "item_id long, doc_id long, _row long, score long")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], "item_id long, doc_id long, _row long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
docs AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM docs),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w FROM df, totals),
lengths AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // length AS m FROM docs, totals),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
