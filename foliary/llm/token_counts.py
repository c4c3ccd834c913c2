"""Token counts as delta-maintained rollups.

Changes are signed: an insert adds a document's counts, a delete takes them back, a revision takes back
the old and adds the new. A batch of changes is summed to one delta per source, language and
tokenizer version and written under the batch's number; the write's success marker is the commit.
A batch number that is committed already is left alone, so replays change nothing; a write
that failed half-way has no marker and is replaced. Totals are the sum of committed deltas;
`compact` folds them into a base that names the batches it holds, so that history doesn't slow reads, a late
batch of any number still counts, and a replay of a folded one doesn't. One writer commits at a time.

Cases: null and empty texts are documents of no tokens; a very long text is counted whole by the task that reads it; a
null source or language is a group of its own; repeated rows count each time they are inserted; groups
whose totals are all zero are gone; an empty batch commits no rows; columns other than source, lang, the text and
those to carry aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"


def bpe_counter(path: str):
    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = tokens.encoder(path).batches
        for b in batches:
            parts = (b.slice(at, tokens.ROWS).to_pylist() for at in range(0, len(b), tokens.ROWS))
            yield pa.array([len(x) // 4 for texts in parts for _, blobs in encode(texts) for x in blobs], type=pa.int64())

    return count


def counted(docs: DataFrame, counters: dict[str, object], text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """source, lang, tokenizer, tokens: a row per document and tokenizer version."""
    counts = F.array(*[F.struct(F.lit(name).alias("tokenizer"), f(F.col(text_col)).cast("long").alias("tokens")) for name, f in counters.items()])
    return docs.select(*carry, F.col("source").cast("string"), F.col("lang").cast("string"), F.inline(counts))


def signed(rows: DataFrame, sign: int | Column = 1) -> DataFrame:
    s = F.lit(sign) if isinstance(sign, int) else sign
    return rows.select(*KEYS, s.cast("long").alias("docs"), (s * F.col("tokens")).cast("long").alias("tokens"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes from old to new counts of the same documents."""
    return signed(old, -1).unionByName(signed(new, 1))


class Rollup:
    """A folder of committed deltas and a base of those folded."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there)

    def _children(self, path: str, prefix: str, marker: str) -> list[int]:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = there.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(there):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(there)]
        return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and self._exists(f"{path}/{n}/{marker}"))

    def batches(self) -> list[int]:
        """Numbers of the batches whose deltas are there."""
        return self._children(f"{self.path}/deltas", "batch=", "_SUCCESS")

    def base(self) -> int | None:
        """Number of the last whole base; its totals are written last."""
        return max(self._children(f"{self.path}/base", "fold=", "totals/_SUCCESS"), default=None)

    def folded(self) -> set[int]:
        """Numbers of the batches in the base."""
        base = self.base()
        if base is None:
            return set()
        return {r["batch"] for r in self.spark.read.schema("batch long").parquet(f"{self.path}/base/fold={base}/batches").collect()}

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Commit a batch of signed changes; False if that batch is in already."""
        if self._exists(f"{self.path}/deltas/batch={batch}/_SUCCESS") or batch in self.folded():
            return False
        delta = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        delta.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")
        return True

    def totals(self, upto: int | None = None) -> DataFrame:
        """Totals of all batches, or of those up to a number, which no folded batch may be above."""
        base, folded = self.base(), self.folded()
        if upto is not None and folded and upto < max(folded):
            raise ValueError(f"batch {max(folded)} is folded into the base")
        paths = [f"{self.path}/base/fold={base}/totals"] if base is not None else []
        paths += [f"{self.path}/deltas/batch={b}" for b in self.batches() if b not in folded and (upto is None or b <= upto)]
        rows = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        out = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return out.filter("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Fold the committed deltas into a new base."""
        base, folded = self.base(), self.folded()
        new = folded | set(self.batches())
        if new != folded:
            path = f"{self.path}/base/fold={0 if base is None else base + 1}"
            self.spark.createDataFrame([(b,) for b in sorted(new)], "batch long").write.mode("overwrite").parquet(f"{path}/batches")
            self.totals().write.mode("overwrite").parquet(f"{path}/totals")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after each of three batches: all documents are inserted with two tokenizer versions; exact copies are
    deleted (of equal texts one row stays, that with the largest doc_id), with a replay; word counts are revised
    to counts of characters, a third version."""
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "source", "lang")
    counters = {"words-1": common.words_of, "byte-bpe-1": bpe_counter(tokens.public_path("byte_bpe_50k.json")), "chars-1": lambda t: F.coalesce(F.length(t), F.lit(0))}
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    counts = common.written(counted(docs.select("*", digest), counters, carry=("doc_id", "digest")), "token-counts")
    # one row of each text and version: null ids come first, and rows that repeat an id leave one too
    kept = counts.groupBy("digest", "tokenizer").agg(F.max(F.struct("doc_id", "source", "lang", "tokens")).alias("best")).select("tokenizer", "best.*")
    kept = common.written(kept, "kept-counts")
    old = lambda rows: rows.filter("tokenizer <> 'chars-1'")
    book = Rollup(spark, common.new_folder(spark, "token-rollup"))
    book.commit(1, signed(old(counts)))
    for _ in range(2):
        book.commit(2, revised(old(counts), old(kept)))
    book.commit(3, revised(kept.filter("tokenizer = 'words-1'"), kept.filter("tokenizer = 'chars-1'")))
    before = [book.totals(upto=b).withColumn("batch", F.lit(b)) for b in (1, 2)]
    book.compact()
    return before[0].unionByName(before[1]).unionByName(book.totals().withColumn("batch", F.lit(3)))
