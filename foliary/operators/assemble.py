"""Complete cases and the records that their files are described by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import split_case_name
from ..functions.text import is_password_file, password_candidates
from .journal import first_original_by_hash, has_hash, is_definitive, latest_records, must_reread, was_read
from .scale import spread_join

READING = ["was_read", "not_read_because", "ocr_ok", "reader_version"]


def complete_cases(listing: DataFrame, records: DataFrame) -> DataFrame:
    """exp, files, complete: whether each file is settled or its content was read elsewhere."""
    done = records.filter(is_definitive()).select("id", F.lit(True).alias("_done"))
    read = records.filter(was_read() & has_hash()).select("hash").distinct().withColumn("_copy", F.lit(True))
    files = listing.select("id", "exp", "hash").join(done, "id", "left").join(read, "hash", "left")
    return files.groupBy("exp").agg(F.count(F.lit(1)).alias("files"), F.bool_and(F.coalesce("_done", "_copy", F.lit(False))).alias("complete"))


def case_summary(records: DataFrame, totals: DataFrame) -> DataFrame:
    """The header of each case: described, in the matter, coverage, read, with SSN, pages, partial."""
    flag = lambda c: F.count_if(F.coalesce(c, F.lit(False))) if c in records.columns else F.lit(0).cast("long")
    pages = F.array_sort(F.collect_set("pages_read")) if "pages_read" in records.columns else F.array(F.lit("2"))
    out = records.groupBy(F.col("caso").alias("matter")).agg(
        F.count(F.lit(1)).alias("files_described"), flag("was_read").alias("files_read"), flag("contains_ssn").alias("files_with_ssn"), pages.alias("pages_read_per_file")
    )
    out = out.join(totals.select(F.col("exp").alias("matter"), F.col("files").alias("files_in_matter")), "matter", "left")
    covered = F.when(F.col("files_in_matter") > 0, F.round(F.col("files_described") / F.col("files_in_matter"), 3))
    partial = F.coalesce(F.col("files_described") < F.col("files_in_matter"), F.lit(True))
    return out.withColumn("coverage", covered).withColumn("partial", partial)


def subfolder(sub: Column) -> Column:
    return F.when(sub.contains("/"), F.regexp_replace(sub, "/[^/]*$", "")).otherwise("(folder root)")


def assemble_case_records(listing: DataFrame, records: DataFrame, incomplete: bool = False) -> DataFrame:
    """A record for each file: its own settled one, else its original's; for incomplete cases the last
    failure, else that it wasn't read in this stage."""
    cols = [c for c in READING + ["read_with", "document_type", "contains_ssn", "pages_read", "extracted_text"] if c in records.columns]
    own = records.select("id", is_definitive().alias("_done"), F.struct(*cols).alias("_own"))
    original = first_original_by_hash(records).select("hash", F.col("id").alias("_from"), F.struct(*cols).alias("_copy"))
    # a file without a hash is dealt by its id: "i" and "h" keep them apart
    key = lambda df: df.withColumn("_hash", F.concat(F.lit("h"), "hash"))
    files = key(listing).withColumn("_hash", F.coalesce("_hash", F.concat(F.lit("i"), "id"), F.lit("n")))
    files = spread_join(files.join(own, "id", "left"), key(original).drop("hash"), "_hash", how="left", counted=key(listing))
    nothing = F.struct(*[F.lit("not read in this stage").alias(c) if c == "not_read_because" else (F.lit(False) if c == "was_read" else F.lit(None).cast(records.schema[c].dataType)).alias(c) for c in cols])
    settled = F.coalesce("_done", F.lit(False))
    pick = F.when(settled, F.col("_own")).when(F.col("_copy").isNotNull(), F.col("_copy"))
    pick = F.coalesce(pick, F.col("_own"), nothing) if incomplete else pick
    source = F.when(settled, "own").when(F.col("_copy").isNotNull(), "copy").when(F.col("_own").isNotNull(), "failure").otherwise("nothing")
    out = files.withColumn("_r", pick).withColumn("source", source)
    out = out if incomplete else out.filter("_r is not null")
    return out.select(
        "id", F.col("exp").alias("caso"), F.col("name").alias("file_name"), subfolder(F.coalesce("sub", F.lit(""))).alias("subfolder"),
        F.round(F.col("size") / 1048576.0, 2).alias("size_mb"), "hash", "_r.*", F.when(F.col("source") == "copy", F.col("_from")).alias("copied_from"), "source",
    )


def compare_live(listing: DataFrame, live: DataFrame, resolved: DataFrame) -> DataFrame:
    """Per case of the listing: files new and gone today, unread, and what the case is.

    `live` has exp and id of today; `resolved` the ids that have a text or a final answer. A case without
    any live row has no folder any more.
    """
    then = listing.select("exp", "id", F.lit(1).alias("then"))
    both = then.join(live.select("exp", "id", F.lit(1).alias("now")), ["exp", "id"], "full_outer")
    both = both.join(resolved.select("id").distinct().withColumn("_ok", F.lit(1)), "id", "left")
    had, has = F.col("then").isNotNull(), F.col("now").isNotNull()
    out = both.groupBy("exp").agg(
        F.count_if(had).alias("files"), F.count_if(has).alias("live"), F.count_if(has & ~had).alias("added"),
        F.count_if(had & ~has).alias("removed"), F.count_if(had & F.col("_ok").isNull()).alias("unread"),
    ).filter("files > 0")
    kind = F.when(F.col("live") == 0, "sin_carpeta").when(F.col("unread") > 0, "incompletos").when((F.col("added") > 0) | (F.col("removed") > 0), "cambiados").otherwise("sin cambios")
    moved = F.when((F.col("live") > 0) & ((F.col("added") > 0) | (F.col("removed") > 0)), F.format_string("%d new files that are not in this JSONL, %d no longer there.", "added", "removed"))
    lost = F.when(F.col("live") == 0, F.lit("The case's folder no longer exists under this name."))
    left = F.when(F.col("unread") > 0, F.format_string("%d files could not be read.", "unread"))
    return out.withColumn("kind", kind).withColumn("notice", F.concat_ws(" ", lost, moved, left))


def split_base_by_team(assignment: DataFrame, listing: DataFrame, journal: DataFrame) -> DataFrame:
    """team and id of the records that each team needs: its own, and originals of the contents it holds."""
    best = latest_records(journal)
    files = listing.join(assignment.select(F.col("expediente").alias("exp"), F.col("equipo").alias("team")), "exp")
    own = files.select("team", "id").join(best.select("id"), "id", "left_semi").select("team", "id")
    original = first_original_by_hash(journal.filter(~must_reread())).select("hash", F.col("id"))
    held = files.filter(has_hash()).select("team", "hash").distinct()
    return own.union(held.join(original, "hash").select("team", "id")).distinct()


def changed_cases(summary: DataFrame, previous: DataFrame) -> DataFrame:
    """Cases whose number of records isn't that of the last publication."""
    was = previous.select("matter", F.col("files").alias("_was"))
    return summary.join(was, "matter", "left").filter("_was is null or _was <> files_described").drop("_was")


def resolve_current_name(cases: DataFrame, live: DataFrame) -> DataFrame:
    """caso, current, result: today's name of each old case name, if one and only one fits."""

    def key(df: DataFrame, name: str) -> DataFrame:
        s = split_case_name(F.col(name))
        return df.withColumn("_base", F.lower(F.trim(s["base"]))).withColumn("_index", F.trim(s["index_number"])).withColumn("_closed", s["closed"])

    same = cases.select("caso").distinct().join(live.select(F.col("folder").alias("caso")).distinct(), "caso", "left_semi")
    lost = key(cases.select("caso").distinct().join(live.select(F.col("folder").alias("caso")), "caso", "left_anti"), "caso")
    names = key(live.select("folder").distinct(), "folder").groupBy("_base", "_index", "_closed").agg(F.count(F.lit(1)).alias("_n"), F.min("folder").alias("_name"))
    found = lost.join(names, ["_base", "_index", "_closed"], "left")
    result = F.when(F.col("_n") == 1, "renamed").when(F.col("_n") > 1, "ambiguous").otherwise("missing")
    found = found.select("caso", F.when(F.col("_n") == 1, F.col("_name")).alias("current"), result.alias("result"))
    return same.select("caso", F.col("caso").alias("current"), F.lit("same").alias("result")).union(found)


def ancestors(path: Column) -> Column:
    """All folders above a path, without the path itself."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def longest_prefix_destination(files: DataFrame, moves: DataFrame, name_map: DataFrame) -> DataFrame:
    """id, case, subfolder where each file (id, path, caso) is now: by the longest moved prefix of its path,
    else by its folder's single current name. Files of one folder go the same way, so only distinct folders look for their prefixes."""
    # a path up to its last slash has the same folders above it
    place = F.when(F.col("path").contains("/"), F.regexp_replace("path", "[^/]*$", "")).otherwise(F.col("path"))
    files = files.select("id", place.alias("path"), "caso")
    places = files.select("path", "caso").distinct()
    up = places.select("path", F.explode(ancestors(F.col("path"))).alias("origin")).distinct()
    hit = up.join(moves.distinct(), "origin").groupBy("path").agg(F.max_by(F.struct("origin", "destination"), F.length("origin")).alias("m"))
    single = unique_case_by_origin(name_map)
    out = places.join(hit, "path", "left").join(single.select(F.col("origin").alias("caso"), "current"), "caso", "left")
    rest = F.regexp_replace(F.ltrim(F.lit("/"), F.expr("substring(path, length(m.origin) + 1)")), "/?[^/]*$", "")
    dest_case = F.substring_index("m.destination", "/", 1)
    dest_sub = F.when(F.col("m.destination").contains("/"), F.regexp_replace("m.destination", "^[^/]*/", "")).otherwise("")
    moved_sub = F.array_join(F.filter(F.array(dest_sub, rest), lambda x: x != ""), "/")
    mark = F.concat(F.lit("/"), "caso", F.lit("/"))
    inside = F.when(F.instr("path", mark) > 0, F.expr("substring(path, instr(path, concat('/', caso, '/')) + length(caso) + 2)")).otherwise("")
    own_sub = F.when(inside.contains("/"), F.regexp_replace(inside, "/[^/]*$", "")).otherwise("")
    case = F.when(F.col("m").isNotNull(), dest_case).otherwise(F.coalesce("current", F.lit("")))
    sub = F.when(F.col("m").isNotNull(), moved_sub).when(F.col("current").isNotNull(), own_sub).otherwise("")
    told = out.select(F.col("path").alias("_path"), F.col("caso").alias("_caso"), case.alias("case"), sub.alias("subfolder"))
    # places that say nothing needn't be met
    told = told.filter("case <> '' or subfolder <> ''")
    met = files.join(told, F.col("path").eqNullSafe(F.col("_path")) & F.col("caso").eqNullSafe(F.col("_caso")), "left")
    return met.select("id", F.coalesce("case", F.lit("")).alias("case"), F.coalesce("subfolder", F.lit("")).alias("subfolder"))


def unique_case_by_origin(name_map: DataFrame) -> DataFrame:
    """Origins that map to exactly one case."""
    named = name_map.filter("nombre_origen is not null and nombre_origen <> '' and nombre_actual is not null and nombre_actual <> ''")
    one = named.groupBy(F.col("nombre_origen").alias("origin")).agg(F.count(F.lit(1)).alias("n"), F.min("nombre_actual").alias("current"))
    return one.filter("n = 1").drop("n")


def files_per_case(tree: DataFrame, name_map: DataFrame) -> DataFrame:
    """Files of each origin folder, carried over to its single case."""
    files = tree.filter(~F.col("es_carpeta")).groupBy(F.col("client_folder").alias("origin")).agg(F.count(F.lit(1)).alias("files"))
    return files.join(unique_case_by_origin(name_map), "origin").groupBy("current").agg(F.sum("files").alias("files"))


def sibling_passwords(files: DataFrame, texts: DataFrame, most_bytes: int = 5 * 1024 * 1024) -> DataFrame:
    """id, passwords: candidates from password-like files beside each file, in order, without repeats.

    Only the few password-like files give rows; they meet the folder's other files by folder.
    """
    keys = files.filter(is_password_file(F.col("name")) & (F.col("size") < most_bytes)).join(texts, "id")
    found = keys.select("exp", "sub_folder", F.col("id").alias("_of"), F.col("name").alias("_name"), F.posexplode(password_candidates(F.col("text"))).alias("_k", "password"))
    met = files.select("id", "exp", "sub_folder").join(found, ["exp", "sub_folder"]).filter("id <> _of")
    first = met.groupBy("id", "password").agg(F.min(F.struct("_name", "_of", "_k")).alias("_at"))
    ordered = F.array_sort(F.collect_list(F.struct("_at", "password")))
    return first.groupBy("id").agg(F.transform(ordered, lambda x: x["password"]).alias("passwords"))


def resume_worklist(plan: DataFrame, log: DataFrame) -> DataFrame:
    """Rows of a plan that the log has not as ok."""
    return plan.join(log.filter("estado = 'ok'").select("origen"), "origen", "left_anti")


def outcome_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("estado").agg(F.count(F.lit(1)).alias("n"))
