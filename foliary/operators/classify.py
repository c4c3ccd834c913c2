"""Classification of documents and routing to folders, by ordered rule tables that are parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.literals import candidates, may_match
from ..functions.text import blank, contains_ssn, mask_ssn, normalize_folder_name, py_regex
from ..rules.doc_types import DESCRIPTIONS, DOC_TYPES
from ..rules.folders import FOLDER_PATTERNS, FOLDERS, TEMPLATES

TITLE, HEAD, CLIP = 300, 900, 6000
UNCLASSIFIED = "00_Sin clasificar"
FCRA_KINDS = ["ID Theft", "Wrongful Reporting", "FCRA", "Time-Barred", "EFTA", "RESPA", "ID Theft + Wrongful Reporting"]

TYPE_SCHEMA = "rank int, name string, pattern string, dest_foreclosure string, dest_fcra string, certainty string, name_pattern string, generic boolean"


def doc_types(spark: SparkSession, rules: list[tuple] = DOC_TYPES) -> DataFrame:
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], TYPE_SCHEMA)


def describe_types(spark: SparkSession, descriptions: dict[str, str] = DESCRIPTIONS) -> DataFrame:
    return spark.createDataFrame(list(descriptions.items()), "document_type string, description string")


def first_rule(conditions: list[tuple[int, Column]]) -> Column:
    """Rank of the first rule that holds, null if none."""
    return F.coalesce(*[F.when(c, F.lit(i)) for i, c in conditions])


def staged(df: DataFrame, conditions: list[tuple[int, Column]], out: str, stage: int, still: Column | None = None) -> DataFrame:
    """Adds the rank of the first rule that holds, `stage` rules to a step; a step looks only at rows (of those `still` open) that none before has told."""
    told: list[str] = []
    for lo in range(0, len(conditions), stage):
        open_ = F.coalesce(*told).isNull() if told else F.lit(True)
        told.append(f"_stage{lo}")
        df = df.withColumn(told[-1], F.when(open_ if still is None else open_ & still, first_rule(conditions[lo : lo + stage])))
    return df.withColumn(out, F.coalesce(*told)).drop(*told)


def with_name_type(df: DataFrame, name: str, out: str = "name_rank", rules: list[tuple] = DOC_TYPES, stage: int = 12, distinct: bool = True) -> DataFrame:
    """Adds the rank of the first type whose name pattern fits the raw name or the one with its separators as spaces.

    A rule's pattern runs only on names that hold a literal it needs. Names of files
    repeat, so each `distinct` name is looked at once and joined back; not where rows are wide, as with texts."""
    if distinct:
        names = with_name_type(df.select(name).distinct(), name, out, rules, stage, False)
        return df.join(names, name, "left").select(*df.columns, out)
    raw = F.col(name)
    df = df.withColumn("_airy", F.regexp_replace(raw, r"[_\-.]+", " ")).withColumn("_lower", F.lower(F.concat(raw, F.lit("\n"), F.col("_airy"))))
    fits = lambda p: may_match(F.col("_lower"), p) & (raw.rlike(py_regex(p)) | F.col("_airy").rlike(py_regex(p)))
    return staged(df, [(i, fits(r[5] or r[1])) for i, r in enumerate(rules)], out, stage).drop("_airy", "_lower")


def with_text_type(df: DataFrame, text: str, out: str = "text_type", rules: list[tuple] = DOC_TYPES, stage: int = 100) -> DataFrame:
    """Adds a struct of rank and where. Each window is a step of its own, computed once.

    Which rules a text may fit is told by the literals they need, in one pass over the text; only those rules' patterns run, window after
    window, so a text costs that pass and a few patterns, however many rules there are."""
    t = F.col(text)
    df = df.withColumn("_may", candidates(t, [r[1] for r in rules]))
    seen = lambda window, rs: [(i, F.array_contains("_may", i) & window.rlike(py_regex(r[1]))) for i, r in rs]
    all_ = list(enumerate(rules))
    df = df.withColumn("_start", F.left(t, F.lit(TITLE))).withColumn("_top", F.left(t, F.lit(HEAD)))
    df = staged(df, seen(F.col("_start"), [(i, r) for i, r in all_ if not r[6]]), "_title", stage)
    df = staged(df, seen(F.col("_top"), all_), "_head", stage, F.col("_title").isNull())
    early = F.coalesce("_title", "_head")
    df = staged(df, seen(t, all_), "_any", stage, early.isNull())
    rank = F.when(~blank(t), F.coalesce("_title", "_head", "_any"))
    where = F.when(rank.isNull(), "").when(early.isNotNull(), "titulo").otherwise("mencion")
    return df.withColumn(out, F.struct(rank.alias("rank"), where.alias("where"))).drop("_may", "_title", "_head", "_any", "_start", "_top")


def evidence_line(df: DataFrame, text: str, rank: str, out: str = "evidence", rules: list[tuple] = DOC_TYPES, most: int = 150) -> DataFrame:
    """The line or lines around the type's first match, squeezed. The search begins at line starts only, so it is linear in long lines."""
    t = F.col(text)
    around = lambda r: F.regexp_extract(t, "(?imd)^([^\\n]*?(?:" + r[1] + ")[^\\n]*)", 1)
    line = reduce(lambda c, ir: c.when(F.col(rank) == ir[0], around(ir[1])), enumerate(rules), F.when(F.lit(False), ""))
    squeezed = F.trim(F.regexp_replace(F.coalesce(line, F.lit("")), r"\s+", " "))
    return df.withColumn(out, F.left(squeezed, F.lit(most)))


def route_document(df: DataFrame, name: str, text: str, template: str, clip_chars: int | None = CLIP, rules: list[tuple] = DOC_TYPES) -> DataFrame:
    """Adds goes_to, document_type, certainty, decided_by and evidence.

    The name decides if it has a type with a folder in the row's template; otherwise the text, or
    nobody. `template` is a column. The rule table is small and of fixed size, so it is broadcast.
    """
    spark = df.sparkSession
    cut = F.left(F.col(text), F.lit(clip_chars)) if clip_chars else F.col(text)
    df = with_name_type(df.withColumn("_cut", F.coalesce(cut, F.lit(""))), name, "_rn", rules, distinct=False)
    types = F.broadcast(doc_types(spark, rules).select("rank", "name", "dest_foreclosure", "dest_fcra", "certainty"))

    def looked_up(d: DataFrame, rank: str, p: str) -> DataFrame:
        t = types.select(F.col("rank").alias(rank), *[F.col(c).alias(p + c) for c in ("name", "dest_foreclosure", "dest_fcra", "certainty")])
        d = d.join(t, rank, "left")
        return d.withColumn(p + "dest", F.when(F.col(template) == "FCRA", F.col(p + "dest_fcra")).otherwise(F.col(p + "dest_foreclosure")))

    df = looked_up(df, "_rn", "_a_")
    df = df.withColumn("_need", F.col("_a_dest").isNull()).withColumn("_cut", F.when(F.col("_need"), F.col("_cut")).otherwise(""))
    df = with_text_type(df, "_cut", "_rtt", rules).withColumn("_rt", F.col("_rtt.rank"))
    df = evidence_line(looked_up(df, "_rt", "_b_"), "_cut", "_rt", "_ev", rules)
    by_text = F.col("_need") & F.col("_b_dest").isNotNull()
    out = {
        "goes_to": F.coalesce("_a_dest", F.when(by_text, F.col("_b_dest")), F.lit("")),
        "document_type": F.when(~F.col("_need"), F.col("_a_name")).otherwise(F.coalesce("_b_name", F.lit(""))),
        "certainty": F.when(~F.col("_need"), F.col("_a_certainty")).when(by_text, F.col("_b_certainty")).otherwise(""),
        "decided_by": F.when(~F.col("_need"), "el nombre").when(by_text, F.concat(F.lit("el contenido ("), F.col("_rtt.where"), F.lit(")"))).otherwise(""),
        "evidence": F.when(~F.col("_need"), "").otherwise(F.col("_ev")),
    }
    gone = [c for c in df.columns if c.startswith("_a_") or c.startswith("_b_")] + ["_cut", "_need", "_ev"]
    return df.withColumns(out).drop(*gone)


def map_folder(df: DataFrame, name: str, template: str, folders: list[tuple] = FOLDERS, patterns: list[tuple] = FOLDER_PATTERNS) -> DataFrame:
    """Adds destination and certainty of an old folder's name."""
    df = df.withColumn("_key", normalize_folder_name(F.col(name)))
    df = df.withColumn("_bare", F.regexp_replace("_key", r"(\s+copy|\s+\d)$", ""))
    table = df.sparkSession.createDataFrame(folders, "key string, f string, c string, certainty string")
    for p, k in (("_a", "_key"), ("_b", "_bare")):
        df = df.join(F.broadcast(table.select(F.col("key").alias(k), F.struct("f", "c", "certainty").alias(p))), k, "left")
    row = lambda t: F.struct(F.lit(t[1]).cast("string").alias("f"), F.lit(t[2]).cast("string").alias("c"), F.lit(t[3]).alias("certainty"))
    by_word = F.coalesce(*[F.when(F.col("_key").rlike("(?md)" + t[0]), row(t)) for t in patterns])
    df = df.withColumn("_row", F.coalesce("_a", "_b", by_word))
    chosen = F.when(F.col(template) == "FCRA", F.col("_row.c")).otherwise(F.col("_row.f"))
    certainty = (
        F.when(F.col("_row").isNull(), "no match")
        .when(chosen.isNotNull(), F.col("_row.certainty"))
        .when(F.col("_row.certainty") == "ASK", "ASK")
        .otherwise("no place in this template")
    )
    df = df.withColumn("destination", F.coalesce(chosen, F.lit(UNCLASSIFIED))).withColumn("certainty", certainty)
    return df.drop("_key", "_bare", "_a", "_b", "_row")


def describe_type(df: DataFrame, column: str = "document_type") -> DataFrame:
    d = describe_types(df.sparkSession).withColumnRenamed("document_type", column)
    return df.join(F.broadcast(d), column, "left").withColumn("description", F.coalesce("description", F.lit("")))


def flatten_template(spark: SparkSession, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(t, p) for t, ps in templates.items() for p in ps], "template string, path string")


def validate_destinations(spark: SparkSession, rules: list[tuple] = DOC_TYPES, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """Destinations that their template lacks."""
    t = doc_types(spark, rules)
    used = t.select("name", F.lit("Foreclosure").alias("template"), F.col("dest_foreclosure").alias("path"))
    used = used.union(t.select("name", F.lit("FCRA"), "dest_fcra")).filter("path is not null")
    return used.join(flatten_template(spark, templates), ["template", "path"], "left_anti").select("name", "template", "path")


def validate_routes(rows: DataFrame, rules: list[tuple] = DOC_TYPES, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """Rows (template, type_rank) with the path their type routes to (null: none) and whether their template has it."""
    t = doc_types(rows.sparkSession, rules).select(F.col("rank").alias("type_rank"), "dest_foreclosure", "dest_fcra")
    there = flatten_template(rows.sparkSession, templates).withColumn("_there", F.lit(True))
    path = F.when(F.col("template") == "FCRA", F.col("dest_fcra")).otherwise(F.col("dest_foreclosure"))
    routed = rows.join(F.broadcast(t), "type_rank", "left").withColumn("path", path).drop("dest_foreclosure", "dest_fcra")
    return routed.join(F.broadcast(there), ["template", "path"], "left").withColumn("valid", F.when(F.col("path").isNotNull(), F.coalesce("_there", F.lit(False)))).drop("_there")


def template_for_matter(kind: Column) -> Column:
    return F.when(kind.isin(FCRA_KINDS), "FCRA").otherwise("Foreclosure")


def expected_folders(cases: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """folder, template, path of all that each case should have."""
    return cases.select("folder", "template").join(F.broadcast(flatten_template(cases.sparkSession, templates)), "template")


def missing_folders(cases: DataFrame, existing: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    return expected_folders(cases, templates).join(existing.select("folder", "path").distinct(), ["folder", "path"], "left_anti")


def infer_case_template(tree: DataFrame) -> DataFrame:
    """A case is FCRA if a folder inside starts with 02_FCRA."""
    fcra = F.bool_or((F.col("level") == 3) & F.col("name").startswith("02_FCRA"))
    return tree.groupBy("client_folder").agg(F.when(fcra, "FCRA").otherwise("Foreclosure").alias("template"))


def assemble_ocr_text(fragments: DataFrame, least: float = 0.55, line_height: float = 12.0) -> DataFrame:
    """A page's text from its fragments, in reading order, with how sure they were."""
    keep = F.col("confidence") >= least
    piece = F.when(keep, F.struct(F.bround(F.col("top") / line_height).alias("row"), "left", "top", "text"))
    return fragments.groupBy("page").agg(
        F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"])).alias("text"),
        F.count_if(keep).alias("kept"), F.count_if(~keep).alias("discarded"),
        F.round(F.avg(F.when(keep, F.col("confidence"))), 3).alias("mean_confidence"),
        F.min(F.when(keep, F.col("confidence"))).alias("min_confidence"),
    )


def file_record(files: DataFrame, mask: bool = False, with_text: bool = True, max_mb: float = 25, clip_chars: int | None = CLIP) -> DataFrame:
    """The record of each file: name, subfolder, size, text, read_with, failure, template -> where it goes and why."""
    mb = F.col("size") / 1048576.0
    big = (mb > max_mb) if max_mb else F.lit(False)
    text = F.when(big, "").otherwise(F.coalesce("text", F.lit("")))
    routed = route_document(files.withColumn("_text", text), "file_name", "_text", "template", clip_chars)
    some = lambda c: F.when(~big & (F.col(c) != ""), F.col(c))
    shown = mask_ssn(F.col("_text")) if mask else F.col("_text")
    out = routed.select(
        *[c for c in ("id",) if c in files.columns], "file_name",
        F.coalesce(F.when(F.col("subfolder") != "", F.col("subfolder")), F.lit("(folder root)")).alias("subfolder"),
        F.round(mb, 2).alias("size_mb"),
        (~big & ~blank(F.col("_text"))).alias("was_read"),
        some("read_with").alias("read_with"),
        F.when(big, F.lit(f"larger than {max_mb} MB")).otherwise(some("failure")).alias("not_read_because"),
        some("document_type").alias("document_type"), some("goes_to").alias("goes_to"), some("decided_by").alias("decided_by"),
        some("evidence").alias("decided_because"),
        F.when(~big, contains_ssn(F.col("_text"))).alias("contains_ssn"),
        F.when(~big, F.length("_text")).cast("long").alias("extracted_text_length"),
        F.when(~big & (shown != ""), shown).alias("extracted_text"),
    )
    return out if with_text else out.drop("extracted_text")
