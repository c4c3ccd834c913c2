"""Sharding work over teams, estimating it and planning a stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extension_of
from .journal import IMAGES, has_hash

TEAMS = {"team1": (0, 1, 4, 5), "team2": (2, 3, 6, 7), "team3": (8, 9, 10, 11)}
PAGES_PER_HOUR, NEEDS_OCR_SHARE, IMBALANCE = 743, 0.61, 0.1
#: Mean pages of a file by size bucket, where no log tells.
PAGES = {0: 1.3, 1: 2.9, 2: 7.5, 3: 14.1, 4: 27.9, 5: 33.8}
LOG_READ = r"  LEIDO .*\(([\d.]+) MB, (\d+) pag\.\)"


def share_key() -> Column:
    """What decides a file's shard: its content if known, so that copies stay together."""
    return F.coalesce(F.nullif(F.col("hash"), F.lit("")), F.col("id"))


def md5_shard(key: Column, n: int) -> Column:
    """md5 as a 128-bit number modulo n, by 32-bit digits. A multiple of n nests in it."""
    digest, r = F.md5(key.cast("binary")), F.lit(0).cast("long")
    for i in range(4):
        digit = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
        r = (r * F.lit(1 << 32) + digit) % F.lit(n)
    return r.cast("int")


def shard_filter(df: DataFrame, parts: list[int], n: int) -> DataFrame:
    return df.filter(md5_shard(share_key(), n).isin(parts))


def unique_work(pending: DataFrame, n: int) -> DataFrame:
    """Distinct contents left to read, in each of n shards."""
    return pending.select(share_key().alias("key")).distinct().groupBy(md5_shard(F.col("key"), n).alias("shard")).agg(F.count(F.lit(1)).alias("contents"))


def allocate_shards(spark: SparkSession, teams: list[tuple[str, int, float]], left: int) -> DataFrame:
    """Shards per team in proportion to processes times rate (files a minute), and the hours they take."""
    share = [max(1, round(p * r)) for _, p, r in teams]
    total, at, rows = sum(share), 0, []
    for (name, processes, rate), n in zip(teams, share):
        files = left * n / total
        rows.append((name, list(range(at, at + n)), total, files, files / (processes * rate) / 60))
        at += n
    return spark.createDataFrame(rows, "team string, shards array<int>, of int, files double, hours double")


def size_bucket(mb: Column) -> Column:
    return F.when(mb < 0.1, 0).when(mb < 0.5, 1).when(mb < 1, 2).when(mb < 2, 3).when(mb < 5, 4).otherwise(5)


def pages_by_size_bucket(log: DataFrame) -> DataFrame:
    """Mean pages per size bucket, from a log's lines."""
    part = lambda i: F.regexp_extract("value", LOG_READ, i)
    rows = log.filter(F.col("value").rlike(LOG_READ))
    return rows.groupBy(size_bucket(part(1).cast("double")).alias("bucket")).agg(F.avg(part(2).cast("int")).alias("pages"))


def default_pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PAGES.items()), "bucket int, pages double")


def planned(status: DataFrame, teams: dict[str, tuple] = TEAMS) -> DataFrame:
    """Status rows with their half shard (of 24) and team (by shard of 12)."""
    owner = F.element_at(F.create_map(*[x for t, parts in teams.items() for p in parts for x in (F.lit(p), F.lit(t))]), md5_shard(share_key(), 12))
    return status.withColumn("half_shard", md5_shard(share_key(), 24)).withColumn("team", owner)


def estimate_hours(plan: DataFrame, pages: DataFrame) -> DataFrame:
    """Hours of each pending file. Of equal contents the first is read; the others cost two seconds."""
    pending = plan.filter(F.col("status").startswith("pending"))
    first = pending.filter(has_hash()).groupBy(F.col("hash").alias("_hash")).agg(F.min("id").alias("_first"))
    work = pending.join(first, F.col("hash") == F.col("_hash"), "left").drop("_hash")
    work = work.withColumn("_later", F.coalesce(F.col("id") != F.col("_first"), F.lit(False))).drop("_first")
    mb = F.col("size") / 1048576.0
    work = work.withColumn("bucket", size_bucket(mb)).join(F.broadcast(pages), "bucket", "left")
    n = F.when(extension_of(F.col("name")).isin(IMAGES), 1.0).when(mb >= 5, mb * 6).otherwise(F.coalesce("pages", F.lit(7.0)))
    hours = (
        F.when(F.col("_later"), 2 / 3600)
        .when(F.col("status") == "pending: OCR", n / PAGES_PER_HOUR + 4 / 3600)
        .when(F.lower("name").endswith(".pdf"), NEEDS_OCR_SHARE * n / PAGES_PER_HOUR + 5 / 3600)
        .otherwise(5 / 3600)
    )
    return work.withColumn("hours", hours).drop("bucket", "pages", "_later")


def loads(work: DataFrame) -> DataFrame:
    """Hours and files per team and half shard: at most 24 half shards for each team."""
    return work.groupBy("team", "half_shard").agg(F.sum("hours").alias("hours"), F.count(F.lit(1)).alias("files"))


def rebalance(load: DataFrame, most_moves: int = 6, by_hand: list[tuple[int, str, str]] = []) -> DataFrame:
    """half_shard, from_team, to_team of the moves that even out the teams, or of those made by hand."""
    spark = load.sparkSession
    hours = {(r["team"], r["half_shard"]): r["hours"] for r in load.collect()}  # at most 24 per team
    moves = [(t, a, b) for t, a, b in by_hand]
    while not by_hand and len(moves) < most_moves and hours:
        total: dict[str, float] = {}
        for (team, _), h in sorted(hours.items()):
            total[team] = total.get(team, 0.0) + h
        most, least = max(total, key=lambda k: total[k]), min(total, key=lambda k: total[k])
        gap = total[most] - total[least]
        if total[most] <= total[least] * (1 + IMBALANCE):
            break
        options = [(abs(gap - 2 * h), t) for (team, t), h in sorted(hours.items()) if team == most and abs(gap - 2 * h) < gap]
        if not options:
            break
        t = min(options)[1]
        hours[(least, t)] = hours.get((least, t), 0.0) + hours.pop((most, t))
        moves.append((t, most, least))
    return spark.createDataFrame(moves, "half_shard int, from_team string, to_team string")


def apply_moves(plan: DataFrame, moves: DataFrame) -> DataFrame:
    """Moves in order; a half shard that moved twice ends where its last move says. A handful of rows."""
    to = F.col("team")
    for m in moves.collect():
        to = F.when((F.col("half_shard") == m["half_shard"]) & (to == m["from_team"]), m["to_team"]).otherwise(to)
    return plan.withColumn("team", to)


def check_plan(plan: DataFrame) -> DataFrame:
    """Three checks of a plan: ids are unique, each content is one team's, every pending file has a team."""
    pending = plan.filter(F.col("status").startswith("pending"))
    ids = pending.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("d")).select(F.lit("ids unique").alias("check"), (F.col("n") == F.col("d")).alias("ok"))
    one = pending.filter(has_hash()).groupBy("hash").agg((F.min("team") == F.max("team")).alias("one"))
    one = one.agg(F.coalesce(F.bool_and("one"), F.lit(True)).alias("ok")).select(F.lit("each content in one team").alias("check"), "ok")
    all_ = pending.agg((F.count(F.lit(1)) == F.count("team")).alias("ok")).select(F.lit("lists add up").alias("check"), "ok")
    return ids.union(one).union(all_)


def case_state(status: DataFrame) -> DataFrame:
    """Per case: files, GB, read, copies of read, pending, complete."""
    pending = F.count_if(F.col("status").startswith("pending"))
    return status.groupBy("exp").agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.sum("size") / 1073741824.0, 2).alias("gb"),
        F.count_if(F.col("status") == "read").alias("read"),
        F.count_if(F.col("status") == "copy of a read file").alias("copies"),
        pending.alias("pending"),
        F.when(pending == 0, "si").otherwise("no").alias("complete"),
    )
