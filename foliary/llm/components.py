"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import common


def both_ways(links: DataFrame) -> DataFrame:
    """Distinct links (a, b) and (b, a), written: what finds them is a plan by itself, taken once."""
    ways = [F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba")]
    return common.written(links.select(F.explode(F.array(*ways)).alias("way")).select("way.a", "way.b").distinct(), "links")


def components_of(both: DataFrame) -> DataFrame:
    """id, label: the smallest id that each linked id reaches. Links are those of `both_ways`.

    Each round takes the smallest label among an id's own and its neighbours', then follows that label's own
    label, so paths halve; rounds end when no label falls, which the round's own write tells. Aggregations combine
    before the shuffle, so a hub with many links is no single task's.
    """
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("id"), "label")
    labels = common.written(labels, "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").select(F.col("a").alias("id"), F.lit(None).cast("long").alias("was"), "label")
        told = near.union(labels.select("id", F.col("label").alias("was"), "label"))
        step = told.groupBy("id").agg(F.max("was").alias("was"), F.min("label").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        step = step.join(jump, "label", "left").select("id", "was", F.least("label", F.coalesce("far", "label")).alias("label"))
        fell = Observation()
        step = common.written(step.observe(fell, F.count_if(F.col("label") < F.col("was")).alias("n")), "labels")
        labels = step.select("id", "label")
        if not fell.get["n"]:
            return labels


def components(links: DataFrame) -> DataFrame:
    """id, label: the smallest id that each linked id reaches. Links are (a, b) of longs."""
    both = both_ways(links)
    return both.select(F.col("a").alias("id"), F.col("b").alias("label")) if both.isEmpty() else components_of(both)
