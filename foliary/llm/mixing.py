"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame functions only.

Each source's documents are put in a hashed order and read as one stream of words, cut into blocks of equally many words
(the last, or the only one of a small source, may be shorter), so a source needs a number of slots to meet its target. There are as many
slots as all sources need. Golden-ratio points x_k = frac(k * phi) are mapped through the cumulative shares of
the needs, which gives slot k to a source. Slots are ranked per source. The slot of
rank r takes block r mod (number of blocks), so a source that must be repeated starts over, and its
last slot is cut where the target is met. A sequence's discrepancy is at most logarithmic, so a
source may end a few slots short or over: the slots that some sources have beyond their need, in order, go to the
ranks that others miss, in a hashed order, so all slots are filled and none is appended.

Targets: source weights share all words; a source's target stops at `most` times its own words
and what is over is shared anew by weight among the rest, until none is above. Sorted by room per weight, the
stopped sources come first, so one running sum finds them.

The number of sources isn't bounded: plans are a table of a row per source, broadcast only up to `few_sources` rows.

Cases: a null text has no words; a null source is a source, the last; a source without words has
target 0 and takes nothing; documents that repeat an identifier are mixed one by one; a very long text spans
many blocks, one row each; an empty table gives no rows; columns other than identifier, text, source and those to
carry are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Slots of one bucket of the schedule; ranks are counted in buckets, then between them.
SLOT_BUCKET = 1 << 14
#: The fractional part of the golden ratio as a fraction of 2**32, so that points are exact integers.
PHI32 = 2654435769


def cycle_weights(i: Column) -> Column:
    """Weights 1, 2, 3, repeating."""
    return (i % 3 + 1).cast("double")


def planned(sizes: DataFrame, block: int, weights: Callable[[Column], Column], most: float) -> DataFrame:
    """Of sources and their sizes: i (the place by code point), source, source_size, target and goal in words, the
    source's blocks, the slots it needs, the words its last slot takes, and the share of the 2**32 points from low to high."""
    every = Window.partitionBy(F.lit(0))
    before = lambda order: every.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    upto = every.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = sizes.withColumn("i", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
    rows = rows.withColumns({"weight": weights(F.col("i")), "room": most * F.col("source_size")}).withColumn("share", F.col("room") / F.col("weight"))
    filled = before(["share", "i"])
    rows = rows.withColumns({
        "left": F.sum("source_size").over(every) - F.coalesce(F.sum("room").over(filled), F.lit(0.0)),
        "heavy": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0)),
    })
    stops = F.col("left") * F.col("weight") > F.col("room") * F.col("heavy")
    rows = rows.withColumn("stops", stops).withColumn("shared", F.min(F.when(~stops, F.struct("share", "i", "left", "heavy"))).over(every))
    last = F.struct("share", "i") >= F.struct("shared.share", "shared.i")
    target = F.when(last, F.col("shared.left") * F.col("weight") / F.col("shared.heavy")).otherwise(F.col("room"))
    rows = rows.withColumn("target", F.coalesce(target, F.lit(0.0)))
    goal, size = F.round("target").cast("long"), F.col("source_size")
    rest = F.when(size > 0, goal % size).otherwise(0)
    rows = rows.withColumns({"blocks": F.ceil(size / block), "rest": rest, "passes": F.when(size > 0, F.floor(goal / size)).otherwise(0)})
    slots = F.ceil(F.col("rest") / block)
    rows = rows.withColumns({
        "need": F.col("passes") * F.col("blocks") + slots,
        "last_take": F.when(F.col("rest") > 0, F.col("rest") - (slots - 1) * block).otherwise(block),
    }).withColumn("high", F.round(F.sum("need").over(upto) / F.greatest(F.sum("need").over(every), F.lit(1)) * F.lit(2.0**32)).cast("long"))
    rows = rows.withColumn("low", F.lag("high", 1, 0).over(every.orderBy("i")))
    return rows.select("i", "source", "source_size", "target", "blocks", "need", "last_take", "low", "high")


def schedule(plan: DataFrame, slots: int, few: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """slot, i (source), rank, block, cut: the mix in order. A slot reads its whole block, or `cut` words of it."""
    k = plan.sparkSession.range(slots).withColumnRenamed("id", "slot")
    x = F.pmod(F.col("slot").cast("decimal(20,0)") * F.lit(PHI32).cast("decimal(10,0)"), F.lit(2**32).cast("decimal(11,0)")).cast("long")
    # a point's source: the one whose share it lies in, looked up in the point's stretch of 2**20
    shares = plan.filter("low < high").select("i", "low", "high", "need", "blocks", "last_take", F.explode(F.sequence(F.shiftright("low", 20), F.shiftright(F.col("high") - 1, 20))).alias("_part"))
    k = k.withColumn("_x", x).withColumn("_part", F.shiftright("_x", 20)).join(few(shares), "_part").filter("low <= _x and _x < high")
    k = k.select("slot", "i", "need", "blocks", "last_take", F.floor(F.col("slot") / SLOT_BUCKET).alias("_bucket"), F.lit(1).alias("_one"))
    k = common.prefix_sums(k, ["i"], ["slot"], "_one", "rank", bucket_key="_bucket").select("slot", "i", "rank", "need", "blocks", "last_take")
    k = common.written(k, "slots")  # used three times; the driver needn't hold its plan as often
    reached = k.groupBy("i").agg(F.count(F.lit(1)).alias("got"))
    # slots beyond their source's need, numbered in order, go to the ranks that the points did not reach, numbered in an order by hash
    spare = k.filter("rank >= need").select("slot", F.floor(F.col("slot") / SLOT_BUCKET).alias("_bucket"), F.lit(1).alias("_one"))
    spare = common.prefix_sums(spare, [], ["slot"], "_one", "_free", bucket_key="_bucket").select("slot", "_free")
    missed = plan.join(reached, "i", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < need")
    missed = missed.select("i", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("rank"), "need", "blocks", "last_take", F.lit(1).alias("_one"))
    missed = missed.withColumn("_h", F.xxhash64("i", "rank")).withColumn("_bucket", F.shiftright("_h", 48))
    missed = common.prefix_sums(missed, [], ["_h", "i", "rank"], "_one", "_free", bucket_key="_bucket")
    both = k.filter("rank < need").unionByName(missed.join(spare, "_free").select(*k.columns))
    both = common.written(both, "mix-slots")
    return both.select("slot", "i", "rank", (F.col("rank") % F.col("blocks")).alias("block"), F.when(F.col("rank") == F.col("need") - 1, F.col("last_take")).alias("cut"))


def streams(docs: DataFrame, block: int, weights: Callable[[Column], Column], most: float, few_sources: int, id_col: str, text_col: str, source_col: str, carry: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Each document with its place in its source's stream of words, and the pieces of documents in the slots of the mix."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        common.words_of(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("_text"), *[F.col(c) for c in carry],
    )
    rows = common.written(rows, "sizes")  # narrow: texts are read once
    sizes = common.written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    plan = common.written(planned(sizes, block, weights, most), "mix-plan")
    facts = plan.agg(F.count(F.lit(1)), F.coalesce(F.sum("need"), F.lit(0))).first()
    few = F.broadcast if facts[0] <= few_sources else lambda df: df
    chosen = schedule(plan, facts[1], few)
    named = few(plan.select("i", F.col("source").alias("_source"), "source_size", "target"))
    rows = rows.join(named, rows["source"].eqNullSafe(F.col("_source"))).drop("_source").withColumn("_h", F.xxhash64("doc_id", F.lit(4)))
    stream = common.prefix_sums(rows, ["i"], ["_h", "doc_id", "_text", "size"], "size", "start").drop("_h", "_text")
    stream = common.written(stream, "streams")
    pieces = stream.filter("size > 0").select(
        "i", "source", "doc_id", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"),
    )
    # the words of the source's stream that the document has in the block, and the slot takes
    first, last = F.greatest(F.col("block") * block, F.col("start")), F.least((F.col("block") + 1) * block, F.col("start") + F.col("size"))
    pieces = pieces.join(chosen, ["i", "block"]).withColumn("first", first)
    pieces = pieces.withColumn("last", F.least(last, F.coalesce(F.col("block") * block + F.col("cut"), last))).filter("first < last")
    return stream, pieces


def mixed_sequence(
    docs: DataFrame, block: int = 256, weights: Callable[[Column], Column] = cycle_weights, most: float = 3.0, few_sources: int = 10_000,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: slot, rank, source, doc_id, first_word, last_word. In the order of slot, source, rank and first_word, it reads
    the documents' words (last_word isn't among them) so that the sources' shares of every stretch are near the targets."""
    _, pieces = streams(docs, block, weights, most, few_sources, id_col, text_col, source_col, ())
    return pieces.select("slot", "rank", "source", "doc_id", (F.col("first") - F.col("start")).alias("first_word"), (F.col("last") - F.col("start")).alias("last_word"))


def mix(
    docs: DataFrame, block: int = 256, weights: Callable[[Column], Column] = cycle_weights, most: float = 3.0, few_sources: int = 10_000,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken (words that the mix reads) and the columns to carry.

    `block` is the number of words of a slot (raise it with the corpus: there are about words / block slots, one a pass at least for each source)."""
    stream, pieces = streams(docs, block, weights, most, few_sources, id_col, text_col, source_col, carry)
    # a document with words is named by its place in its source's stream
    taken = pieces.groupBy("i", "start").agg(F.sum(F.col("last") - F.col("first")).alias("taken")).withColumn("_some", F.lit(True))
    out = stream.withColumn("_some", F.col("size") > 0).join(taken, ["i", "start", "_some"], "left")
    return out.select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *carry)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
