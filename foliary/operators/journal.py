"""Reading state: which record of a file counts, what is done, what is left to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import extension_of
from .scale import in_ranges, numbered, spread_join

READER_VERSION, OLDEST_VERSION = 4, 3
#: Reasons that a later attempt can't change.
PERMANENT = ["larger than", "no reader for", "not a document", "empty file", "password protected", "the HTML page has no text", "the text file is empty"]
NO_TEXT = ["OCR found no text in the image", "OCR returned only", "OCR returned noise", "OCR found no text on the pages", "the Word file has no text and its images have none either"]
NEEDS_OCR = "needs OCR: left for a machine with GPU"
IMAGES = ["jpg", "jpeg", "png", "tif", "tiff", "bmp", "gif", "webp", "heic", "heif", "jfif", "jpe"]
OWN_OUTPUT = r"^Claude-.*\.jsonl?$"
HEAVY = 5 * 1024 * 1024


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _reason() -> Column:
    return F.coalesce("not_read_because", F.lit(""))


def was_read() -> Column:
    return F.coalesce("was_read", F.lit(False))


def is_definitive() -> Column:
    """Whether a record settles its file: read, or failed for good."""
    for_good = _any([_reason().contains(p) for p in PERMANENT])
    no_text = F.coalesce("ocr_ok", F.lit(False)) & _any([_reason().startswith(p) for p in NO_TEXT])
    return was_read() | for_good | F.coalesce(F.col("file_name").startswith("~$"), F.lit(False)) | no_text


def must_reread() -> Column:
    """Records of readers that are too old."""
    version = F.coalesce("reader_version", F.lit(1))
    return (version < OLDEST_VERSION) | ((version < READER_VERSION) & _reason().contains("no reader for"))


def record_class() -> Column:
    return F.when(was_read(), 2).when(is_definitive(), 1).otherwise(0)


def has_hash() -> Column:
    return F.coalesce(F.col("hash") != "", F.lit(False))


def latest_records(journal: DataFrame, order_cols: list[str] = ["_seq"], columns: list[str] | None = None) -> DataFrame:
    """One record per id: read beats settled beats failed, and within a class the last counts. If `columns` are named, only they move.

    The choice is an aggregation of narrow columns that combines before the shuffle; a file with very
    many attempts is no task's burden. Other columns are joined back by the chosen row.
    """
    fresh = journal.filter(~must_reread())
    rank = F.struct(record_class().alias("class"), *[F.col(c) for c in order_cols])
    columns = journal.columns if columns is None else ["id", *[c for c in columns if c != "id"]]
    if "extracted_text" not in columns:
        best = fresh.groupBy("id").agg(F.max_by(F.struct(*[F.col(c) for c in columns if c != "id"]), rank).alias("r"))
        return best.select("id", "r.*").select(*columns)
    best = fresh.groupBy("id").agg(F.max(rank).alias("_rank")).select("id", *[F.col(f"_rank.{c}").alias(c) for c in order_cols])
    return fresh.join(best, ["id", *order_cols], "left_semi").select(*columns)


def latest_facts(journal: DataFrame, facts: dict[str, Column], order_cols: list[str] = ["_seq"]) -> DataFrame:
    """id and some facts of its best record, as in `latest_records`: only the facts move, not the record."""
    rank = F.struct(record_class().alias("class"), *[F.col(c) for c in order_cols])
    rows = journal.filter(~must_reread()).select("id", rank.alias("_rank"), F.struct(*[v.alias(k) for k, v in facts.items()]).alias("_facts"))
    return rows.groupBy("id").agg(F.max_by("_facts", "_rank").alias("r")).select("id", "r.*")


def repeated_reads(journal: DataFrame) -> DataFrame:
    fresh = journal.filter(~must_reread())
    return fresh.agg(F.count(F.lit(1)).alias("attempts"), F.count_distinct("id").alias("files")).withColumn("superseded", F.col("attempts") - F.col("files"))


def first_original_by_hash(records: DataFrame, order_col: str = "id") -> DataFrame:
    """The first read record of each content hash; rows without a hash are no one's original."""
    read = records.filter(was_read() & has_hash())
    cols = [c for c in records.columns if c != "hash"]
    first = read.groupBy("hash").agg(F.min_by(F.struct(*cols), F.col(order_col)).alias("r"))
    return first.select("hash", "r.*").select(*records.columns)


COPIED = ["was_read", "read_with", "document_type", "contains_ssn", "pages_read", "extracted_text_length", "extracted_text"]


def copy_text_from_original(listing: DataFrame, records: DataFrame) -> DataFrame:
    """Records for files that have none but whose content another file's reading gave."""
    carried = [c for c in COPIED if c in records.columns]
    original = first_original_by_hash(records.select(*dict.fromkeys(["id", "hash", "was_read", *carried]))).select("hash", F.col("id").alias("copied_from"), *carried)
    # asked for a fact of the record, so that records which are an aggregation move once for this and for the originals
    has = records.select("id", was_read().alias("_has"))
    missing = listing.filter(has_hash()).join(has, "id", "left").filter("_has is null").drop("_has")
    return spread_join(missing, original, "hash", counted=listing)


def reading_status(listing: DataFrame, journal: DataFrame, queue: DataFrame | None = None, carry: list[str] = ["exp", "name", "size", "hash"]) -> DataFrame:
    """id, the columns to carry and status of every file of the listing. Of a record only what the status follows from moves."""
    facts = {"_has": F.lit(True), "_read": was_read(), "_done": is_definitive(), "_asks": _reason() == NEEDS_OCR, "_gives": F.when(was_read() & has_hash(), F.col("hash"))}
    best = latest_facts(journal, facts)
    own = best.drop("_gives")
    # a hash counts once, and null hashes never reach the join
    read = best.filter("_gives is not null").select(F.col("_gives").alias("_hash")).distinct().withColumn("_copy", F.lit(True))
    # a file without a hash is dealt by its id, which is no hash: the flag keeps it from meeting one
    some = F.coalesce("hash", F.concat(F.lit("id:"), "id"))
    files = listing.select("id", *carry, extension_of(F.col("name")).isin(IMAGES).alias("_image"), F.col("hash").isNotNull().alias("_some"), some.alias("_hash"))
    files = files.join(read, "_hash", "left").withColumn("_copy", F.col("_copy") & F.col("_some")).drop("_hash", "_some").join(own, "id", "left")
    waits = F.col("_image") | F.coalesce("_asks", F.lit(False))
    if queue is not None:
        files = files.join(queue.select("id").distinct().withColumn("_queued", F.lit(True)), "id", "left")
        waits = waits | F.coalesce("_queued", F.lit(False))
    status = (
        F.when(F.col("_done") & F.col("_read"), "read")
        .when(F.col("_done"), "resolved without text")
        .when(F.col("_copy"), "copy of a read file")
        .when(waits, "pending: OCR")
        .when(F.col("_has").isNull(), "pending: never read")
        .otherwise("pending: failed")
    )
    return files.select("id", *carry, status.alias("status"))


def pending_files(listing: DataFrame, journal: DataFrame, queue: DataFrame, which: str = "no_ocr") -> DataFrame:
    """Files without a settled record; `no_ocr` leaves images and queued ids, `ocr_only` takes just them."""
    done = latest_records(journal).filter(is_definitive()).select("id")
    left = listing.join(done, "id", "left_anti")
    queued = queue.select("id").distinct().withColumn("_queued", F.lit(True))
    for_ocr = extension_of(F.col("name")).isin(IMAGES) | F.coalesce("_queued", F.lit(False))
    return left.join(queued, "id", "left").filter(~for_ocr if which == "no_ocr" else for_ocr).drop("_queued")


def ocr_queue(journal: DataFrame, listing: DataFrame) -> DataFrame:
    """Ids that wait for OCR and why: their last word asks for it or OCR failed, and they aren't settled."""
    best = latest_records(journal)
    ask = best.filter(~is_definitive() & (_reason().startswith("needs OCR") | _reason().startswith("OCR")))
    return ask.select("id", _reason().alias("reason")).join(listing.select("id"), "id", "left_semi")


def ocr_queue_report(journal: DataFrame, listing: DataFrame) -> DataFrame:
    """Counts by reason, images that wait, and queued ids that the listing no longer has. Records and listing meet once."""
    asks = _reason().startswith("needs OCR") | _reason().startswith("OCR")
    best = latest_facts(journal, {"_has": F.lit(True), "_done": is_definitive(), "_asked": F.when(~is_definitive() & asks, _reason())})
    images = F.count_if(extension_of(F.col("name")).isin(IMAGES)).alias("_images")
    met = listing.groupBy("id").agg(images).withColumn("_listed", F.lit(True)).join(best, "id", "full_outer")
    waiting = F.coalesce(F.sum(F.when(~F.coalesce("_done", F.lit(False)), F.col("_images"))), F.lit(0))
    gone = F.count_if(F.col("_asked").isNotNull() & F.col("_listed").isNull())
    some = met.groupBy(F.when(F.col("_listed"), F.col("_asked")).alias("_reason")).agg(F.count(F.lit(1)).alias("_n"), waiting.alias("_images"), gone.alias("_gone"))
    row = lambda what, n: F.struct(what.alias("what"), n.cast("long").alias("count"))
    rows = F.array(row(F.concat(F.lit("reason: "), "_reason"), F.col("_n")), row(F.lit("pending images"), F.col("_images")), row(F.lit("not in the listing"), F.col("_gone")))
    none = listing.sparkSession.createDataFrame([("pending images", 0), ("not in the listing", 0)], "what string, count long")
    return some.select(F.inline(rows)).filter("what is not null").union(none).groupBy("what").agg(F.sum("count").alias("count"))


def restrict_to_list(listing: DataFrame, ids: DataFrame) -> DataFrame:
    return listing.join(ids.select("id"), "id", "left_semi")


def carry_over_records(journals: DataFrame, ids: DataFrame, mine: DataFrame) -> DataFrame:
    """Settled records of listed ids that others' journals have and mine lack; read ones first."""
    best = latest_records(journals.join(ids.select("id"), "id", "left_semi"))
    return best.filter(is_definitive()).join(mine.select("id"), "id", "left_anti")


def drop_own_outputs(listing: DataFrame) -> DataFrame:
    return listing.filter(~F.col("name").rlike(OWN_OUTPUT))


def dedupe_delta(items: DataFrame, order_col: str = "seq") -> DataFrame:
    """The last state of each id that a crawl returned more than once."""
    rest = [c for c in items.columns if c != "id"]
    return items.groupBy("id").agg(F.max_by(F.struct(*rest), order_col).alias("r")).select("id", "r.*").select(*items.columns)


def small_sample_per_case(files: DataFrame, n: int) -> DataFrame:
    """n files of each case: those read already first, then by kind and size."""
    ext = F.lower(F.substring_index("name", ".", -1))
    kind = F.when(ext == "docx", 0).when(ext == "pdf", 1).when(ext == "doc", 2).when(ext == "msg", 3).otherwise(4)
    order = Window.partitionBy("exp").orderBy(F.col("already_read").desc(), kind, "size", "id")
    return files.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def order_work_queue(files: DataFrame, broken: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Adds each file's place in the queue (from 1) and what it follows from: group, copy, times_broken. Images, light scans, heavy scans, each with its
    copies after it; ids that broke the engine last, by how often. Of other columns only those to `carry` move (None: all)."""
    image = F.coalesce(extension_of(F.col("name")).isin(IMAGES), F.lit(False)).alias("_image")
    kept = files.columns if carry is None else carry
    files = files.select(*dict.fromkeys(["id", "size", *kept]), image, F.when(has_hash(), F.col("hash")).alias("_hash"))
    # the smallest row of each hash is no copy; rows without a hash aren't, and don't meet
    first = files.filter("_hash is not null").groupBy("_hash").agg(F.min(F.struct("size", "id")).alias("_first"))
    some = F.coalesce(F.concat(F.lit("h"), "_hash"), F.concat(F.lit("i"), "id"))  # a file without a hash is dealt by its id
    files = files.withColumn("_hash", some).join(first.withColumn("_hash", F.concat(F.lit("h"), "_hash")), "_hash", "left").drop("_hash")
    files = files.withColumn("copy", F.col("_first").isNotNull() & ~F.struct("size", "id").eqNullSafe(F.col("_first"))).drop("_first")
    group = F.when(F.col("_image"), 0).when(F.col("size") <= HEAVY, 2).otherwise(4) + F.col("copy").cast("int")
    times = broken.groupBy("id").agg(F.count(F.lit(1)).alias("times_broken"))
    out = files.withColumn("group", group).drop("_image").join(times, "id", "left").withColumn("times_broken", F.coalesce("times_broken", F.lit(0)))
    out = numbered(out, [F.col(c) for c in ("times_broken", "group", "size", "id")], "place")
    return out.select(*kept, *[c for c in ("id", "copy", "group", "times_broken", "place") if c not in kept])


def _marked(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records with `_lost`: they are bad ids' readings or copies made from such. Only copies are dealt by what they were made from, and all end
    dealt by their own id."""
    bad = ids.select("id").distinct()
    own = records.filter("copied_from is null").withColumn("_from", F.lit(None).cast("boolean"))
    copies = records.filter("copied_from is not null").join(bad.select(F.col("id").alias("copied_from"), F.lit(True).alias("_from")), "copied_from", "left")
    parts = [p.join(bad.withColumn("_bad", F.lit(True)), "id", "left").select(*records.columns, "_bad", "_from") for p in (own, copies)]
    lost = (was_read() & F.coalesce("_bad", F.lit(False))) | F.coalesce("_from", F.lit(False))
    return parts[0].unionAll(parts[1]).withColumn("_lost", lost).drop("_bad", "_from")


def cascade_invalidate(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records without the bad ids' readings and the copies made from them."""
    return _marked(records, ids).filter(~F.col("_lost")).select(*records.columns)


def reopened_cases(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Cases that lose a record in `cascade_invalidate`, and no record of its id stays."""
    rows = _marked(records.select("id", "caso", "was_read", "copied_from"), ids)
    left = rows.groupBy("id").agg(F.bool_or(~F.col("_lost")).alias("_kept"), F.collect_set(F.struct("caso")).alias("_cases"))
    return left.filter("not _kept or id is null").select(F.explode("_cases").alias("c")).select("c.caso").distinct()


def truncated_reads_from_log(lines: DataFrame) -> DataFrame:
    """The file read just before a session's first CUDA error, or just before a restart for a broken GPU.

    Lines have log, seq, kind, detail. A session starts behind a start line or an end line; each log is
    one reader's, and its lines are its order. Logs are dealt to ranges of (log, seq). What a range has to know of those before it (how many
    sessions were opened, the last line, the session of the last CUDA error) is summed up by range and carried on, so no task
    holds a whole log.
    """
    start, cuda = F.col("kind") == "ARRANQUE", (F.col("kind") == "NO LEIDO") & F.col("detail").contains("CUDA error")
    rows = in_ranges(lines.select("log", "seq", "kind", "detail"), [F.col("log"), F.col("seq")])
    inside, ranges = Window.partitionBy("_part", "log").orderBy("seq"), Window.partitionBy("log").orderBy("_part")
    sofar = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    edge = F.col("kind").isin("ARRANQUE", "FIN").cast("int")
    # an end line still belongs to the session that it ends
    one = rows.groupBy("_part", "log").agg(F.sum(edge).alias("_edges"), F.max_by(F.struct("kind", "detail"), "seq").alias("_last"))
    one = one.select("_part", "log", F.coalesce(F.sum("_edges").over(sofar(ranges)), F.lit(0)).alias("_opened"), F.lag("_last").over(ranges).alias("_last"))
    marked = rows.join(one, ["_part", "log"])
    opened = F.col("_opened") + F.coalesce(F.sum(edge).over(sofar(inside)), F.lit(0))
    before = F.coalesce(F.lag(F.struct("kind", "detail")).over(inside), F.col("_last"))
    marked = marked.withColumn("session", opened + start.cast("int")).withColumn("_prev", before).drop("_opened", "_last")
    two = marked.groupBy("_part", "log").agg(F.max(F.when(cuda, F.col("session"))).alias("_cuda"))
    two = two.select("_part", "log", F.max("_cuda").over(sofar(ranges)).alias("_cuda"))
    earlier = F.greatest(F.max(F.when(cuda, F.col("session"))).over(sofar(inside)), F.col("_cuda"))
    marked = marked.join(two, ["_part", "log"]).withColumn("_first", F.coalesce(earlier < F.col("session"), F.lit(True)))
    broken = (F.col("kind") == "FIN") & F.col("detail").contains("REINICIO POR GPU ROTA")
    # the line before is of the same session unless it ended one or this one starts one
    hit = ((cuda & F.col("_first")) | broken) & (F.col("_prev.kind") == "LEIDO") & ~start
    return marked.filter(hit).select("log", "seq", F.col("_prev.detail").alias("file"), F.when(cuda, "CUDA error").otherwise("restart").alias("because"))
