"""Sources: listings, reading journals, id lists and the CRM export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LISTING = "id string, name string, size long, hash string, exp string, sub string, modified string, file_modified string"
JOURNAL = (
    "id string, caso string, file_name string, subfolder string, size_mb double, origen string, se_migra boolean, hash string, reader_version int, "
    "was_read boolean, read_with string, not_read_because string, document_type string, contains_ssn boolean, pages_read string, ocr_ok boolean, "
    "extracted_text_length long, extracted_text string, copied_from string, _corrupt string"
)
CRM = {
    "Record ID": "matter_id", "Matter Name": "matter", "Matter Stage": "stage", "Case Type": "case_type", "Retainer Sent Date": "sent",
    "Retainer Signed Date": "signed", "Initial Payment Date": "first_payment", "Number of Associated Contacts": "contacts",
    "Number of Associated Matters": "associated_matters", "Book Value": "book_value", "Associated Contact": "contact",
}


def read_file_listing(spark: SparkSession, path: str) -> DataFrame:
    """A listing in JSON lines, with each file's full path."""
    df = spark.read.schema(LISTING).json(path)
    sub = F.coalesce("sub", F.lit(""))
    return df.withColumn("path", F.concat_ws("/", F.lit("/Matters"), "exp", F.when(sub != "", sub)))


def read_journals(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The union of journals, cut at line feeds only, blank lines left out, with `_seq`, one number that rises with the file's
    name, then its path, then the line, however the files are split. Lines that aren't JSON keep only `_corrupt` and `file`.

    A first look counts the lines of each split and reads nothing else of them; a split's numbers begin behind those of all splits before it."""
    text = spark.read.option("lineSep", "\n").text(paths)
    m = F.col("_metadata")
    # ids rise within a split and splits are ordered by their start
    rows = text.select(m["file_name"].alias("file"), m["file_path"].alias("_path"), m["file_block_start"].alias("_start"), F.monotonically_increasing_id().alias("_line"), "value")
    splits = rows.groupBy("file", "_path", "_start").agg(F.min("_line").alias("_first"), (F.max("_line") - F.min("_line") + 1).alias("_n"))
    files = splits.groupBy("file", "_path").agg(F.sum("_n").alias("_lines"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_path", F.coalesce(F.sum("_lines").over(earlier(Window.orderBy("file", "_path"))), F.lit(0)).alias("_files"))  # a row per file
    inside = F.coalesce(F.sum("_n").over(earlier(Window.partitionBy("_path").orderBy("_start"))), F.lit(0))
    splits = splits.select("_path", "_start", "_first", inside.alias("_splits")).join(files, "_path")
    splits = splits.select("_path", "_start", (F.col("_files") + F.col("_splits") - F.col("_first")).alias("_shift"))
    rows = rows.join(splits, ["_path", "_start"]).select("file", (F.col("_line") + F.col("_shift")).alias("_seq"), "value")
    rows = rows.filter(F.trim("value") != "")
    return parsed_lines(rows, "value")


def parsed_lines(rows: DataFrame, line: str) -> DataFrame:
    """Rows with the journal's columns instead of their line. What isn't one JSON object and nothing else (an empty line, two objects, an object with
    a tail) keeps only `_corrupt`: from_json gives null for the first and reads no further than the first object of the others."""
    rest = [c for c in rows.columns if c != line]
    value, mark = F.coalesce(F.col(line), F.lit("")), F.xxhash64(line).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "maxStringLen": str(2**31 - 1)}
    # only where an object could end before the line does: followed by one more object, in a list, it must be the first of two
    early = F.instr(value, "}") < F.length(F.rtrim(value, F.lit(" \t\r\n")))
    two = F.from_json(F.concat(F.lit("["), value, F.lit(',{"id":"'), mark, F.lit('"}]')), "array<struct<id: string>>", {"maxStringLen": str(2**31 - 1)})
    one = F.when(early, F.coalesce((F.size(two) == 2) & (F.get(two, F.lit(1))["id"] == mark), F.lit(False))).otherwise(True)
    read = rows.select(*rest, value.alias("_value"), F.when(one, F.from_json(value, JOURNAL, options)).alias("r"))
    names = [c.split()[0] for c in JOURNAL.split(", ")][:-1]
    return read.select(*rest, *[f"r.{c}" for c in names], F.when(F.col("r").isNull(), F.col("_value")).otherwise(F.col("r._corrupt")).alias("_corrupt"))


def journal_records(journals: DataFrame) -> DataFrame:
    return journals.filter("_corrupt is null and id is not null").drop("_corrupt")


def corrupt_line_report(journals: DataFrame) -> DataFrame:
    return journals.filter("_corrupt is not null").groupBy("file").agg(F.count(F.lit(1)).alias("corrupt_lines"))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    ids = spark.read.text(path).select(F.trim("value").alias("id"))
    return ids.filter("id <> '' and not startswith(id, '#')")


def typed_crm(raw: DataFrame, today: str | None = None) -> DataFrame:
    """The export's columns renamed, trimmed and typed; what can't be read as its type is null."""
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    df = raw.select(*[(text(f"`{c}`") if c in raw.columns else F.lit(None).cast("string")).alias(n) for c, n in CRM.items()])
    day = F.current_date() if today is None else F.lit(today).cast("date")
    when = lambda c: F.coalesce(F.try_to_timestamp(F.col(c)), F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm")))
    first = F.get(F.split("contact", ";"), F.lit(0))
    return df.withColumns({
        "book_value": F.col("book_value").try_cast("double"), "contacts": F.col("contacts").try_cast("double").cast("long"),
        "associated_matters": F.col("associated_matters").try_cast("double").cast("long"),
        "sent": when("sent"), "signed": when("signed"), "first_payment": when("first_payment"),
    }).withColumns({
        "not_in_use": F.coalesce(F.col("stage").contains("RM Migration"), F.lit(False)),
        "stage": F.trim(F.regexp_replace("stage", r"(?U)^[^\w(]+\s*", "")),
        "case_type": F.coalesce("case_type", F.lit("(sin tipo)")),
        "client": F.trim(F.regexp_replace(first, r"\s*\(.*\)\s*$", "")),
        "email": F.nullif(F.trim(F.regexp_extract(first, r"\(([^)]*)\)", 1)), F.lit("")),
        "days_since_signed": F.datediff(day, F.col("signed")), "month": F.date_format("signed", "yyyy-MM"), "year": F.year("signed"),
        "paid": F.col("first_payment").isNotNull(),
    })


def read_crm_export(spark: SparkSession, path: str, today: str | None = None) -> DataFrame:
    return typed_crm(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path), today)
