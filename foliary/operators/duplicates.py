"""The verdict on each matter against its client's others, without making a client's pairs.

A matter's verdict is that of its best pair: a duplicate before an unspecified duplicate before a distinct case, and of equal ones the
pair with the smallest other id. So one other matter settles each: the smallest that is a duplicate of it; else, for
a generic name, the smallest specific one that doesn't rule it out; else the smallest of all. What makes duplicates:

    a shared case number, file number or address, under conditions on what else both have: the two smallest ids are kept for each
    (client, markers, value) and condition, so no list of a value is ever paired
    names that are much alike: a similarity join of distinct names, see `alike`

The rules themselves are `compare_matters`, which gives verdict and reason of the one pair of each matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.helpers import ratio
from ..functions.names import normalize_name, words
from ..sources.shared import written
from .identity import SAME, SAME_GENERIC, compare_matters, matter_features

FEATURES = ["matter", "indexes", "files", "addresses", "markers", "people", "generic"]
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "
#: Groups of at most so many names are compared as they are.
FEW = 32
#: Ranks in a list up to which its names lead pairs, round by round; what has found its duplicate by then leaves.
ROUNDS = (8, 512, 2**31 - 1)


def two_smallest(rows: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """keys, first, second (null if there is but one). A list is cut to two in each task before it moves."""
    order = Window.partitionBy(*keys).orderBy(id_col)
    two = rows.select(*keys, id_col).distinct().withColumn("_place", F.row_number().over(order)).filter("_place <= 2")
    return two.groupBy(*keys).agg(F.min(id_col).alias("first"), F.max(F.when(F.col("_place") == 2, F.col(id_col))).alias("second"))


def other_than(me: str) -> Column:
    return F.when(F.col("first") != F.col(me), F.col("first")).otherwise(F.col("second"))


def met(mine: DataFrame, theirs: DataFrame, keys: list[str]) -> DataFrame:
    """id, other: the smallest other id in each list that an id asks."""
    return mine.join(two_smallest(theirs, keys), keys).select("id", other_than("id").alias("other")).filter("other is not null")


def allowed(flag: str) -> Column:
    """Values of the other's flag: one of both must lack it."""
    return F.explode(F.when(F.col(flag), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))


def asked_people() -> Column:
    """Lists of people that a matter asks: those who share one with it or have none, or, if it has none itself, all."""
    return F.explode(F.when(F.size("people") == 0, F.array(F.lit("all"))).otherwise(F.concat(F.transform("people", lambda p: F.concat(F.lit("="), p)), F.array(F.lit("none")))))


def listed_people() -> Column:
    """Lists of people that a matter is in."""
    own = F.when(F.size("people") == 0, F.array(F.lit("none"))).otherwise(F.transform("people", lambda p: F.concat(F.lit("="), p)))
    return F.explode(F.concat(own, F.array(F.lit("all"))))


def by_values(f: DataFrame) -> DataFrame:
    """id, other: smallest duplicates by case number, file number and address."""
    numbers = f.select("id", "client", F.explode("indexes").alias("value"))
    found = met(numbers, numbers, ["client", "value"])
    files = f.select("id", "client", "mark", "has_index", F.explode("files").alias("value"))
    found = found.unionAll(met(files.withColumn("has_index", allowed("has_index")), files, ["client", "mark", "value", "has_index"]))
    places = f.select("id", "client", "mark", "has_index", "has_file", "people", F.explode("addresses").alias("value"))
    ask = places.withColumn("has_index", allowed("has_index")).withColumn("has_file", allowed("has_file")).withColumn("person", asked_people())
    keys = ["client", "mark", "value", "has_index", "has_file", "person"]
    return found.unionAll(met(ask, places.withColumn("person", listed_people()), keys))


def profiles(f: DataFrame) -> DataFrame:
    """Distinct names of a client, as far as the rules can tell them apart, with their two smallest ids; `first` names the profile."""
    keys = ["client", "mark", "name", "has_index", "has_file", "has_address", "people", "generic"]
    rows = two_smallest(f, keys)
    counts = F.array(*[(F.length("name") - F.length(F.replace(F.col("name"), F.lit(c), F.lit("")))).cast("int") for c in LETTERS])
    return rows.withColumn("size", F.length("name")).withColumn("counts", counts)


def rarest(p: DataFrame, tokens: Column, prefix: Column, out: str) -> DataFrame:
    """first, client, mark, `out`: of each name's tokens the rarest in its group, as many as `prefix` says."""
    rows = p.select("first", "client", "mark", prefix.alias("_n"), F.explode(tokens).alias(out))
    often = rows.groupBy("client", "mark", out).agg(F.count(F.lit(1)).alias("_often"))
    order = Window.partitionBy("first").orderBy("_often", out)
    rows = rows.join(often, ["client", "mark", out]).withColumn("_place", F.row_number().over(order))
    return rows.filter("_place <= _n and _often > 1").select("first", "client", "mark", out)


def letters_of(p: DataFrame) -> Column:
    """A name's letters with the number of each, so that a name with two l's has l1 and l2; an empty name has one of its own."""
    each = lambda i, c: F.transform(F.sequence(F.lit(0), F.col("counts")[i]), lambda k: F.when(k > 0, F.concat(F.lit(c), k)))
    return F.when(F.col("size") == 0, F.array(F.lit("~"))).otherwise(F.array_compact(F.flatten(F.array(*[each(i, c) for i, c in enumerate(LETTERS)]))))


def list_keys(p: DataFrame, least: float, few: int) -> DataFrame:
    """client, mark, key, first: lists in which any two names with a similarity of `least` or more meet.

    If 2 m of the s letters of two names match, in order, they share m letters as multisets, and at least 5 m - 2 s - 2 runs of three letters, as a
    letter that is only in one name breaks at most three of its own runs and two of the other's. Where that is two or more, both have
    two common runs among their rarest: a list is kept for each two of them. Names so short that it may be less meet by their rarest letters too.
    """
    group = p.groupBy("client", "mark").agg(F.count(F.lit(1)).alias("_names")).filter("_names > 1")
    p = p.join(group, ["client", "mark"])
    small = p.filter(F.col("_names") <= few).select("client", "mark", F.lit("").alias("key"), "first")
    size, short = F.col("size"), F.ceil(F.col("size") * least / (2 - least) - 1e-9)  # of the shortest name that can be like it
    common = F.ceil((size + short) * (2.5 * least - 2) - 2 - 1e-9)
    runs = F.when(size >= 3, F.transform(F.sequence(F.lit(1), size - 2), lambda i: F.substring("name", i, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    large = written(p.filter(F.col("_names") > few).withColumn("_runs", runs).withColumn("_common", common), "names")
    again = F.transform("_runs", lambda r, i: F.concat(r, F.size(F.filter(F.slice("_runs", F.lit(1), i + 1), lambda x: x == r))))
    kept = rarest(large, again, size - 2 - F.greatest(F.col("_common"), F.lit(2)) + 2, "run")
    kept = kept.groupBy("client", "mark", "first").agg(F.sort_array(F.collect_list("run")).alias("_r"))
    two = F.flatten(F.transform("_r", lambda x, i: F.transform(F.slice("_r", i + 2, F.size("_r")), lambda y: F.concat_ws("/", x, y))))
    by_runs = kept.select("client", "mark", F.explode(two).alias("key"), "first")
    shared = F.ceil((size + short) * least / 2 - 1e-9)
    tight = large.filter("_common < 2")
    by_letters = rarest(tight, letters_of(tight), F.greatest(size - shared + 1, F.lit(1)), "key").select("client", "mark", "key", "first")
    return small.unionAll(by_runs).unionAll(by_letters)


def can_be_alike(a: str, b: str, least: Column) -> Column:
    """No rule before the names decides, and lengths and letters allow the similarity."""
    A, B = lambda c: F.col(a + c), lambda c: F.col(b + c)
    people = (F.size(A("people")) == 0) | (F.size(B("people")) == 0) | F.arrays_overlap(A("people"), B("people"))
    total = A("size") + B("size")
    shared = F.aggregate(F.zip_with(A("counts"), B("counts"), lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    apart = ~(A("has_index") & B("has_index")) & ~(A("has_file") & B("has_file")) & ~(A("has_address") & B("has_address"))
    return apart & people & (2 * F.least(A("size"), B("size")) >= least * total - 1e-9) & (2 * shared >= least * total - 1e-9)


def alike(f: DataFrame, few: int = FEW, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """id, other: smallest duplicates by names that are much alike.

    Distinct names meet in the lists of `list_keys`. A list's names lead pairs in the order of their ids, in a few rounds; a name that has
    found a duplicate only goes on to smaller ids. The similarity depends on which name comes first: where it is enough in one
    order only, the ids of both names settle who is before whom.
    """
    spark = f.sparkSession
    p = written(profiles(f), "profiles")
    keys = list_keys(p, SAME, few).unionAll(list_keys(p.filter("generic"), SAME_GENERIC, few).withColumn("key", F.concat(F.lit("generic/"), "key")))
    place = F.row_number().over(Window.partitionBy("client", "mark", "key").orderBy("first"))
    lists = written(keys.distinct().withColumn("place", place), "lists")
    longest = lists.agg(F.coalesce(F.max("place"), F.lit(0))).first()[0]
    # of a name that stands for several matters, the others are duplicates of each other
    alone = F.col("has_index") | F.col("has_file") | F.col("has_address")
    own = p.filter(~alone & F.col("second").isNotNull()).select("first", F.col("second").alias("best"))
    best, found, low = own, None, 0
    side = lambda s: p.select(*[F.col(c).alias(s + c) for c in ("first", "name", "has_index", "has_file", "has_address", "people", "generic", "size", "counts")])
    ordered = lambda c: F.concat_ws(" ", F.array_sort(words(F.col(c))))
    alike_ = lambda a, b: F.greatest(ratio(F.col(a + "name"), F.col(b + "name")), ratio(ordered(a + "name"), ordered(b + "name")))
    for high in rounds:
        here = lists.join(best, "first", "left")
        lead = here.filter((F.col("place") > low) & (F.col("place") <= high)).select("client", "mark", "key", F.col("place").alias("a_place"), F.col("first").alias("a_first"), F.col("best").alias("a_best"))
        rest = here.select("client", "mark", "key", F.col("place").alias("b_place"), F.col("first").alias("b_first"), F.col("best").alias("b_best"))
        wanted = F.coalesce(F.col("b_first") < F.col("a_best"), F.lit(True)) | F.coalesce(F.col("a_first") < F.col("b_best"), F.lit(True))
        pairs = lead.join(rest, ["client", "mark", "key"]).filter(F.col("a_place") < F.col("b_place")).filter(wanted).select("a_first", "b_first").distinct()
        least = F.when(F.col("a_generic") & F.col("b_generic"), SAME_GENERIC).otherwise(SAME)
        pairs = pairs.join(side("a_"), "a_first").join(side("b_"), "b_first").filter(can_be_alike("a_", "b_", least))
        pairs = pairs.withColumn("_least", least).withColumn("_ab", alike_("a_", "b_")).withColumn("_ba", alike_("b_", "a_"))
        pairs = pairs.select("a_first", "b_first", (F.col("_ab") >= F.col("_least")).alias("ab"), (F.col("_ba") >= F.col("_least")).alias("ba"))
        pairs = written(pairs.filter("ab or ba"), "alike")
        found = pairs if found is None else found.unionAll(pairs)
        if high >= longest:
            break
        sure = pairs.filter("ab and ba")
        new = sure.select(F.col("a_first").alias("first"), F.col("b_first").alias("best")).unionAll(sure.select(F.col("b_first").alias("first"), F.col("a_first").alias("best")))
        best, low = written(best.unionAll(new).groupBy("first").agg(F.min("best").alias("best")), "best"), high
    members = written(f.join(p.select("client", "mark", "name", "has_index", "has_file", "has_address", "people", "generic", "first"), ["client", "mark", "name", "has_index", "has_file", "has_address", "people", "generic"]).select("id", "first"), "members")
    both = found.unionAll(found.select(F.col("b_first").alias("a_first"), F.col("a_first").alias("b_first"), F.col("ba").alias("ab"), F.col("ab").alias("ba")))
    # ab: my name comes first, so the other's id is the larger
    smallest = both.filter("ab and ba").groupBy(F.col("a_first").alias("first")).agg(F.min("b_first").alias("other"))
    out = members.join(smallest, "first").select("id", "other")
    out = out.unionAll(members.join(own, "first").select("id", F.when(F.col("id") == F.col("first"), F.col("best")).otherwise(F.col("first")).alias("other")))
    if both.filter("ab <> ba").isEmpty():
        return out
    before = both.filter("ba and not ab").select(F.col("a_first").alias("first"), F.col("b_first").alias("other"))
    out = out.unionAll(members.join(before, "first").filter("other < id").select("id", "other"))
    behind = both.filter("ab and not ba").select("a_first", "b_first")
    mine = behind.join(members.withColumnRenamed("first", "a_first"), "a_first").select("a_first", "b_first", "id", F.lit(None).cast(f.schema["id"].dataType).alias("theirs"))
    theirs = behind.join(members.withColumnRenamed("first", "b_first"), "b_first").select("a_first", "b_first", "id", F.col("id").alias("theirs"))
    later = Window.partitionBy("a_first", "b_first").orderBy(F.desc("id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_ = mine.unionAll(theirs).withColumn("other", F.min("theirs").over(later)).filter("theirs is null and other is not null")
    return out.unionAll(next_.select("id", "other"))


def unspecified(f: DataFrame) -> DataFrame:
    """id, other: for generic names, the smallest specific matter that no rule tells apart. It isn't a duplicate if the id has none."""
    ask = f.filter("generic").select("id", "client", "mark", "people", allowed("has_file").alias("has_file")).withColumn("person", asked_people())
    there = f.filter("not generic").select("id", "client", "mark", "has_file", "people").withColumn("person", listed_people())
    return met(ask, there, ["client", "mark", "has_file", "person"])


def classify_client_matters(matters: DataFrame, few: int = FEW, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """matter_id, client, verdict, reason of every matter against its client's others. A matter without a client or an id has no others;
    ids tell matters apart, and a null name is empty."""
    f = matter_features(matters).withColumn("id", F.col("matter_id"))
    f = f.withColumns({
        "mark": F.array_join("markers", " "), "name": normalize_name(F.col("matter")),
        "has_index": F.size("indexes") > 0, "has_file": F.size("files") > 0, "has_address": F.size("addresses") > 0,
    })
    f = written(f.select("id", "client", "mark", "name", "has_index", "has_file", "has_address", *FEATURES), "matters")
    known = f.filter("client is not null and id is not null")
    level = lambda df, n: df.select("id", F.struct(F.lit(n).alias("level"), "other").alias("o"))
    any_ = met(known.select("id", "client"), known.select("id", "client"), ["client"])
    others = level(by_values(known), 0).unionAll(level(alike(known, few, rounds), 0)).unionAll(level(unspecified(known), 1)).unionAll(level(any_, 2))
    chosen = written(others.groupBy("id").agg(F.min("o").alias("o")).select("id", F.col("o.other").alias("other")), "chosen")
    side = lambda s, key: f.select(F.col("id").alias(key), *[F.col(c).alias(s + c) for c in FEATURES])
    ends = chosen.select("id", "other", F.least("id", "other").alias("_a"), F.greatest("id", "other").alias("_b"))
    pairs = compare_matters(ends.join(side("a_", "_a"), "_a").join(side("b_", "_b"), "_b"))
    mine, theirs = F.when(F.col("id") == F.col("_a"), F.col("a_generic")).otherwise(F.col("b_generic")), F.coalesce(F.when(F.col("id") == F.col("_a"), F.col("b_matter")).otherwise(F.col("a_matter")), F.lit(""))
    text = F.concat(F.lit("no especifica el caso y el cliente si tiene otro matter especificado ("), theirs, F.lit(")"))
    vague = F.col("verdict") == "DUPLICADO SIN ESPECIFICAR"
    told = F.when(~vague, F.struct("verdict", F.concat("reason", F.lit(" (vs "), theirs, F.lit(")")).alias("reason")))
    told = told.when(mine, F.struct("verdict", text.alias("reason"))).otherwise(F.struct(F.lit("CASO DISTINTO").alias("verdict"), F.lit("esta especificado").alias("reason")))
    best = pairs.select("id", told.alias("v"))
    alone = F.when(F.col("generic"), F.struct(F.lit("INCOMPLETO").alias("verdict"), F.lit("el nombre solo dice el cliente o el tipo de caso: falta el caso").alias("reason")))
    alone = alone.otherwise(F.struct(F.lit("CASO UNICO").alias("verdict"), F.lit("el cliente tiene un solo matter y esta especificado").alias("reason")))
    out = f.select("id", "client", "generic").join(best, "id", "left").withColumn("v", F.coalesce("v", alone))
    return out.select(F.col("id").alias("matter_id"), "client", "v.verdict", "v.reason")
