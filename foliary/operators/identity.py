"""Which case a document is of, and which matters are the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.helpers import ratio
from ..functions.names import (
    address_keys, client_tokens, extract_state_indexes, folder_surnames, is_generic_matter, matter_markers, name_similarity, normalize_name, person_tokens, words,
)
from .indexes import CAPTION

SURNAME_LIKE, SAME, SAME_GENERIC = 0.85, 0.90, 0.85
#: Words that tell no client from another.
NO_SURNAMES = [
    "llc", "inc", "corp", "ltd", "the", "and", "new", "york", "city", "county", "court", "group", "llp", "pllc", "company", "associates",
    "properties", "realty", "holdings", "trust", "estate", "management", "enterprises", "partners", "development", "construction", "ventures",
    "capital", "consulting", "services", "incorporated", "corporation", "limited", "avenue", "street", "road", "place", "house", "action", "federal",
    "page", "plaintiff", "defendant", "defendants", "exhibit", "index", "supreme", "district", "eastern", "southern", "western", "northern", "civil",
    "case", "matter", "file",
]


def useful_surnames(folder: Column, own_names: list[str] = []) -> Column:
    """Surname words that can tell a client; `own_names` are the firm's people, who are in every text."""
    return F.filter(folder_surnames(folder), lambda w: (F.length(w) > 3) & ~w.isin(NO_SURNAMES + own_names))


def cases_in_text(docs: DataFrame, cases: DataFrame, own_names: list[str] = []) -> DataFrame:
    """doc_id, folder of the cases all of whose useful words are in a document's caption.

    Distinct sets of useful words meet documents on their rarest word only, so a word of all cases makes no pairs but
    for the cases that have no other; what is left is tested whole."""
    useful = cases.select("folder", F.array_sort(F.array_distinct(useful_surnames(F.col("folder"), own_names))).alias("_u")).filter(F.size("_u") > 0)
    sets = useful.select("_u").distinct()
    uses = sets.select("_u", F.explode("_u").alias("token"))
    common = uses.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = uses.join(common, "token").groupBy("_u").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    captions = docs.select("doc_id", F.array_distinct(words(normalize_name(F.left("text", F.lit(CAPTION))))).alias("_have"))
    met = captions.select("doc_id", "_have", F.explode("_have").alias("token")).join(rarest, "token")
    met = met.filter(F.size(F.array_except("_u", "_have")) == 0).select("doc_id", "_u").distinct()
    return met.join(useful, "_u").select("doc_id", "folder")


def is_client_of_folder(pairs: DataFrame, person: str, folder: str, out: str = "is_client") -> DataFrame:
    """Whether a person's surname is, or is much like, one of a folder's."""
    names, own = client_tokens(F.col(person)), folder_surnames(F.col(folder))
    keyed = pairs.withColumn("_row", F.monotonically_increasing_id())
    both = keyed.select("_row", F.explode(names).alias("a"), own.alias("_o")).select("_row", "a", F.explode("_o").alias("b"))
    like = both.filter((F.col("a") == F.col("b")) | (ratio(F.col("a"), F.col("b")) >= SURNAME_LIKE)).select("_row").distinct().withColumn(out, F.lit(True))
    return keyed.join(like, "_row", "left").withColumn(out, F.coalesce(out, F.lit(False))).drop("_row")


def resolve_case(docs: DataFrame, cases: DataFrame, people: DataFrame | None = None, own_names: list[str] = []) -> DataFrame:
    """doc_id, folder, reason, confirmed. Docs have doc_id, text, numbers (found anywhere) and
    caption_numbers; cases folder, base, index_number; people doc_id and person."""
    known = cases.filter("index_number is not null and index_number not in ('', '0', '-', 's/n')").select("folder", F.col("index_number").alias("number"))
    by_index = docs.select("doc_id", "caption_numbers", F.explode(F.array_distinct("numbers")).alias("number")).join(known, "number")
    by_index = by_index.withColumn("_caption", F.array_contains("caption_numbers", F.col("number")))
    by_index = by_index.groupBy("doc_id").agg(
        F.count_distinct("folder").alias("n_index"), F.min("folder").alias("_any"),
        F.count_distinct(F.when(F.col("_caption"), F.col("folder"))).alias("n_caption"), F.min(F.when(F.col("_caption"), F.col("folder"))).alias("_cap"),
    )
    one = F.when(F.col("n_index") == 1, F.col("_any")).when(F.col("n_caption") == 1, F.col("_cap"))
    by_index = by_index.select("doc_id", F.when(one.isNotNull(), 1).otherwise(F.col("n_index")).alias("n_index"), one.alias("index_case"))

    named = cases_in_text(docs, cases, own_names)
    if people is not None:
        tokens = people.select("doc_id", F.explode(client_tokens(F.col("person"))).alias("a")).distinct()
        sur = cases.select("folder", F.explode(folder_surnames(F.col("folder"))).alias("b"))
        # words of a ratio of 0.85 or more share two letters in a row, so pairs come from an equi-join;
        # each pair of distinct words is compared once
        two = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(F.col(c), i, F.lit(2))))
        a = tokens.select("a").distinct().select("a", F.explode(two("a")).alias("two"))
        b = sur.select("b").distinct().select("b", F.explode(two("b")).alias("two"))
        close = 2 * F.least(F.length("a"), F.length("b")) >= SURNAME_LIKE * (F.length("a") + F.length("b"))
        near = a.join(b, "two").filter(close).select("a", "b").distinct()
        like = near.filter((F.col("a") == F.col("b")) | (ratio(F.col("a"), F.col("b")) >= SURNAME_LIKE))
        named = named.union(tokens.join(like, "a").join(sur, "b").select("doc_id", "folder")).distinct()
    base = cases.select("folder", F.array_except(F.array_distinct(F.filter(words(normalize_name(F.col("base"))), lambda w: F.length(w) > 2)), F.array(*[F.lit(w) for w in NO_SURNAMES + own_names])).alias("_full"))
    caption = docs.select("doc_id", words(normalize_name(F.left("text", F.lit(CAPTION)))).alias("_cap_words"))
    named = named.join(base, "folder").join(caption, "doc_id")
    whole = (F.size("_full") > 0) & (F.size(F.array_except("_full", "_cap_words")) == 0)
    named = named.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_name"), F.min("folder").alias("_one"), F.count_if(whole).alias("n_full"), F.min(F.when(whole, F.col("folder"))).alias("_full_one"))
    single = F.when(F.col("n_name") == 1, F.col("_one")).when(F.col("n_full") == 1, F.col("_full_one"))
    named = named.select("doc_id", F.when(single.isNotNull(), 1).otherwise(F.col("n_name")).alias("n_name"), single.alias("name_case"))

    out = docs.join(by_index, "doc_id", "left").join(named, "doc_id", "left")
    ni, nn = F.coalesce("n_index", F.lit(0)), F.coalesce("n_name", F.lit(0))
    useful = useful_surnames(F.col("index_case"), own_names)
    confirmed = F.coalesce((ni == 1) & F.arrays_overlap(useful, words(normalize_name(F.col("text")))), F.lit(False))
    case = F.when(ni == 1, F.col("index_case")).when((nn == 1) & (ni == 0), F.col("name_case"))
    reason = (
        F.when(confirmed, "both signals agree: index number and surname")
        .when(ni == 1, "index number only, the surname is not inside")
        .when((nn == 1) & (ni == 0), "surname only, no index number")
        .when((ni > 0) | (nn > 0), F.concat(F.lit("AMBIGUOUS: "), ni, F.lit(" cases by index and "), nn, F.lit(" by surname, someone has to decide")))
        .otherwise("nothing in the document ties it to a case")
    )
    return out.select("doc_id", case.alias("folder"), reason.alias("reason"), confirmed.alias("confirmed"))


def matter_features(matters: DataFrame, name: str = "matter", client: str = "client") -> DataFrame:
    """Adds the sets that matters are compared by. File numbers may come as an array `files`."""
    n = F.col(name)
    files = F.col("files") if "files" in matters.columns else F.array().cast("array<string>")
    return matters.withColumns({
        "indexes": extract_state_indexes(n), "files": files, "addresses": address_keys(n), "markers": matter_markers(n),
        "people": person_tokens(n), "generic": is_generic_matter(n, F.col(client)),
    })


def compare_matters(pairs: DataFrame, a: str = "a_", b: str = "b_") -> DataFrame:
    """Adds verdict and reason to pairs of matters with features under two prefixes. The order of the rules counts."""
    A, B = lambda c: F.col(a + c), lambda c: F.col(b + c)
    both = lambda c: (F.size(A(c)) > 0) & (F.size(B(c)) > 0)
    meet = lambda c: F.size(F.array_intersect(A(c), B(c))) > 0
    shown = lambda c: F.array_join(F.array_sort(F.array_intersect(A(c), B(c))), ", ")
    apart = lambda c, sep="/": F.concat(F.array_join(A(c), sep), F.lit(" vs "), F.array_join(B(c), sep))
    odd = F.array_union(F.array_except(A("markers"), B("markers")), F.array_except(B("markers"), A("markers")))
    percent = F.concat(F.round(F.col("_ratio") * 100, 0).cast("int"), F.lit("%"))
    # the similarity is only taken of pairs that the sets leave open
    set_rules = [
        (meet("indexes"), "DUPLICADO", F.concat(F.lit("mismo index number: "), shown("indexes"))),
        (both("indexes"), "CASO DISTINTO", F.concat(F.lit("index distinto: "), apart("indexes"))),
        (F.size(odd) > 0, "CASO DISTINTO", F.concat(F.lit("asuntos distintos ("), F.array_join(F.array_sort(odd), ", "), F.lit(")"))),
        (meet("files"), "DUPLICADO", F.concat(F.lit("mismo file number: "), shown("files"))),
        (both("files"), "CASO DISTINTO", F.concat(F.lit("file number distinto: "), apart("files"))),
        (both("people") & ~meet("people"), "CASO DISTINTO", F.concat(F.lit("los nombres se refieren a personas distintas ("), apart("people", " "), F.lit(")"))),
        (meet("addresses"), "DUPLICADO", F.lit("misma direccion en los dos nombres")),
        (both("addresses"), "CASO DISTINTO", F.lit("direcciones distintas: son dos propiedades")),
    ]
    name_rules = [
        (F.col("_ratio") >= SAME, "DUPLICADO", F.concat(F.lit("nombres casi identicos ("), percent, F.lit(" de coincidencia)"))),
        (A("generic") != B("generic"), "DUPLICADO SIN ESPECIFICAR", F.lit("un nombre no especifica el caso y el otro si")),
        (A("generic") & (F.col("_ratio") >= SAME_GENERIC), "DUPLICADO", F.concat(F.lit("dos nombres genericos casi iguales ("), percent, F.lit(")"))),
        (A("generic"), "CASO DISTINTO", F.lit("genericos pero con nombres diferentes")),
    ]
    told = lambda rules: F.coalesce(*[F.when(when, F.struct(F.lit(verdict).alias("verdict"), reason.alias("reason"))) for when, verdict, reason in rules])
    last = F.struct(F.lit("CASO DISTINTO").alias("verdict"), F.concat(F.lit("nombres diferentes ("), percent, F.lit(" de coincidencia)")).alias("reason"))
    settled = pairs.withColumn("_v", told(set_rules))
    # one pass: of settled pairs, names that are null are compared
    name = lambda c: F.when(F.col("_v").isNull(), c)
    out = settled.withColumn("_ratio", name_similarity(name(A("matter")), name(B("matter"))))
    out = out.withColumn("_v", F.coalesce("_v", told(name_rules), last)).drop("_ratio")
    return out.withColumn("verdict", F.col("_v.verdict")).withColumn("reason", F.col("_v.reason")).drop("_v")
