"""Sinks: one JSON-lines file per case, and the lists of a stage."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import split_case_name
from ..functions.text import json_line

# The header's note, and what it says besides where texts aren't masked.
NOTE = "One JSON object per line. First line is this summary; the rest are documents. Compare files_described with files_in_matter to know what is still pending; more lines can be appended later."
UNMASKED = " Full extracted text, unmasked - contains document contents verbatim, including any personal data they carry."


def case_file_names(cases: DataFrame) -> DataFrame:
    """caso and file: by internal id, and by the index too where folders share an id."""
    s = split_case_name(F.col("caso"))
    ids = cases.select("caso").distinct().withColumn("_id", F.coalesce(F.nullif(s["internal_id"], F.lit("")), F.lit("sin-id")))
    shared = ids.groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    tail = F.replace(F.trim(F.substring_index("caso", " - ", -1)), F.lit("/"), F.lit("-"))
    name = F.concat(F.lit("Claude-"), "_id", F.when(F.col("_n") > 1, F.concat(F.lit("_"), tail)).otherwise(""))
    return ids.join(shared, "_id").select("caso", name.alias("file"))


def case_lines(records: DataFrame, summary: DataFrame, masked: bool = False, generated: str | None = None) -> DataFrame:
    """caso, kind, subfolder, file_name, id, value: every case's header line, then its documents by subfolder and name. Nothing is
    collected: a case's lines are rows. The header says when it was `generated` (now, if not given); if the summary has a folder's id
    (sharepoint_folder_id), it comes first, and where it is null it is left out."""
    docs = [c for c in records.columns if c not in ("id", "caso")]
    body = records.select(
        F.col("caso"), F.lit(1).alias("kind"), F.coalesce("subfolder", F.lit("")).alias("subfolder"), F.coalesce("file_name", F.lit("")).alias("file_name"), F.col("id"),
        json_line(F.struct(F.col("id").alias("sharepoint_id"), *docs)).alias("value"),
    )
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss") if generated is None else F.lit(generated)
    rest = [c for c in summary.columns if c not in ("sharepoint_folder_id", "matter")]
    fields = ["matter", now.alias("generated"), *rest, F.lit(NOTE if masked else NOTE + UNMASKED).alias("note")]
    line = json_line(F.struct(*fields))
    if "sharepoint_folder_id" in summary.columns:
        line = F.when(F.coalesce("sharepoint_folder_id", F.lit("")) != "", json_line(F.struct("sharepoint_folder_id", *fields))).otherwise(line)
    head = summary.select(F.col("matter").alias("caso"), F.lit(0).alias("kind"), F.lit("").alias("subfolder"), F.lit("").alias("file_name"), F.lit("").alias("id"), line.alias("value"))
    return head.unionByName(body)


#: Characters that Spark escapes in the names of partitions' folders.
ESCAPED = {c: f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]}


def local_root(spark: SparkSession, path: str) -> str | None:
    """The folder as a plain path, where it lies on a file system that all executors mount."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.toUri().getPath() if there.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file" else None


def folder_of(root: str, name: str | None) -> str:
    return os.path.join(root, "file=" + ("".join(ESCAPED.get(c, c) for c in name) if name else "__HIVE_DEFAULT_PARTITION__"))


def place_files(root: str):
    """Writes rows (file, value), in the order of files, to root/file=.../part-00000.txt. A file gets its name when it is whole, so a task that runs again, or
    twice, leaves the same."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, out, temp, files = None, None, "", 0

        def close() -> None:
            if out is not None:
                out.close()
                os.replace(temp, os.path.join(os.path.dirname(temp), "part-00000.txt"))

        for b in batches:
            for name, value in zip(b.column("file").to_pylist(), b.column("value").to_pylist()):
                if out is None or name != last:
                    close()
                    folder = folder_of(root, name)
                    os.makedirs(folder, exist_ok=True)
                    last, temp, files = name, os.path.join(folder, f"_{uuid.uuid4().hex}"), files + 1
                    out = open(temp, "wb")
                out.write(value.encode() + b"\n")
        close()
        yield pa.RecordBatch.from_pydict({"files": [files]})

    return place


def read_files(root: str, most: int = 4 << 20):
    """Reads the files of the named cases whole, as many to a batch as some MB hold."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for name in b.column("file").to_pylist():
                folder = folder_of(root, name)
                for part in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
                    if part.startswith(("_", ".")):
                        continue
                    with open(os.path.join(folder, part), encoding="utf-8", newline="") as f:
                        rows.append({"value": f.read(), "file": name})
                    size += len(rows[-1]["value"])
                    if size >= most:
                        yield pa.RecordBatch.from_pylist(rows, schema=WHOLE)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=WHOLE)

    return read


WHOLE = pa.schema([("value", pa.string()), ("file", pa.string())])


def write_case_jsonl(records: DataFrame, summary: DataFrame, path: str, masked: bool = False, generated: str | None = None) -> None:
    """One file in a folder of its own for each case."""
    lines = case_lines(records, summary, masked, generated).join(case_file_names(records), "caso")
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartition(parts, "file").sortWithinPartitions("file", "kind", "subfolder", "file_name", "id")
    # tasks place their own files, as the driver would take one after the other; _SUCCESS tells when all are there
    root = local_root(records.sparkSession, path)
    if root is not None:  # without Hadoop's native library its writer starts some commands for each file
        shutil.rmtree(root, ignore_errors=True)
        os.makedirs(root)
        dealt.select("file", "value").mapInArrow(place_files(root), "files long").agg(F.sum("files")).collect()
        open(os.path.join(root, "_SUCCESS"), "wb").close()
        return
    placed = dealt.select("file", "value").write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    placed.partitionBy("file").text(path)


def write_stage_lists(plan: DataFrame, state: DataFrame, path: str) -> None:
    """Per team the sorted ids that it must read; the cases' state; the pending files in detail."""
    pending = plan.filter(F.col("status").startswith("pending"))
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = pending.select("team", F.col("id").alias("value")).repartitionByRange(parts, "team", "value").sortWithinPartitions("team", "value")
    ids.write.mode("overwrite").partitionBy("team").text(f"{path}/lists")
    state.write.mode("overwrite").option("header", True).csv(f"{path}/case_state")
    pending.select("id", "exp", "name", "size", "status", "team").write.mode("overwrite").option("header", True).csv(f"{path}/pending")
