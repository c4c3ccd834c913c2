"""Global numbers, spread joins, logs in ranges, journals' line numbers and compound files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliary.functions import text
from foliary.operators import journal, scale
from foliary.plans import samples
from foliary.sources import readers


def test_numbers_are_places(spark):
    r = random.Random(1)
    rows = [(r.randint(0, 30), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = scale.numbered(df, [F.desc("a"), F.col("b")], "place").collect()
    assert {(x["a"], x["b"]): x["place"] for x in got} == {x: i for i, x in enumerate(sorted(rows, key=lambda x: (-x[0], x[1])), 1)}
    assert scale.numbered(df.filter("false"), [F.col("a")], "place").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [3, 10**6])
def test_spread_join(spark, how, most, monkeypatch):
    """Hot, rare, null and unmatched keys; with a bound on how many keys are hot."""
    r = random.Random(2)
    rows = [(f"r{i}", r.choice(["hot", "hot", "hot", "warm", f"k{i}", None, "lost"])) for i in range(400)]
    one = [("hot", "text of hot"), ("warm", "text of warm"), ("unused", "x")] + [(f"k{i}", str(i)) for i in range(0, 400, 2)]
    many, wide = spark.createDataFrame(rows, "id string, hash string"), spark.createDataFrame(one, "hash string, wide string")
    for hottest in (scale.MOST_HOT, 1):
        monkeypatch.setattr(scale, "MOST_HOT", hottest)
        got = sorted(map(tuple, scale.spread_join(many, wide, "hash", how=how, most=most).select("id", "hash", "wide").collect()), key=str)
        texts = dict(one)
        assert got == sorted(((i, h, texts.get(h)) for i, h in rows if how == "left" or h in texts), key=str)


def test_a_hot_hash_is_dealt(spark):
    """No task of the join has more than about `most` rows of the hash, and its text stands once a part."""
    many = spark.range(20_000).select(F.concat(F.lit("f"), "id").alias("id"), F.lit("h").alias("hash"))
    one = spark.createDataFrame([("h", "wide")], "hash string, wide string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = scale.spread_join(many, one, "hash", most=1000).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(c)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(x["count"] for x in out) == 20_000 and len(out) > 10 and max(x["count"] for x in out) < 5_000


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_logs_in_ranges(spark, partitions):
    """Equal to one pass over each log, wherever the ranges end."""
    r, rows, want = random.Random(partitions), [], []
    for log in ("a", "b", "long"):
        before, cuda = None, False
        for seq in range(800 if log == "long" else 40):
            kind, detail = r.choice([("ARRANQUE", ""), ("FIN", "REINICIO POR GPU ROTA"), ("FIN", "done"), ("NO LEIDO", "CUDA error"), ("NO LEIDO", "HTTP 429"), *[("LEIDO", f"{log}{seq}.pdf")] * 6])
            rows.append((log, seq, kind, detail))
            if kind == "ARRANQUE":
                before, cuda = None, False
            if before and before[0] == "LEIDO" and (kind == "NO LEIDO" and "CUDA" in detail and not cuda or kind == "FIN" and "GPU" in detail):
                want.append((log, seq, before[1], "CUDA error" if kind == "NO LEIDO" else "restart"))
            cuda = cuda or (kind == "NO LEIDO" and "CUDA" in detail)
            before = (kind, detail)
            if kind == "FIN":
                before, cuda = None, False
    r.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = journal.truncated_reads_from_log(spark.createDataFrame(rows, "log string, seq long, kind string, detail string")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(tuple, got)) == sorted(want)


def test_line_numbers_are_total(spark, tmp_path):
    """Files of one name in two folders, split and packed in several ways: the last record is always the same."""
    want = []
    for folder in ("b", "a"):
        (tmp_path / folder).mkdir()
        for name in ("x.jsonl", "w.jsonl"):
            lines = [json.dumps({"id": f"i{k % 7}", "was_read": True, "reader_version": 4, "file_name": f"{folder}/{name}/{k}"}) for k in range(60)]
            (tmp_path / folder / name).write_text("\n\n".join(lines) + ("\n" if name == "x.jsonl" else ""))
    want = [f"{folder}/{name}/{k}" for name in ("w.jsonl", "x.jsonl") for folder in ("a", "b") for k in range(60)]
    last = {f"i{k % 7}": f"b/x.jsonl/{k}" for k in range(60)}
    for size, cost in (("128m", "4m"), ("700b", "0"), ("1500b", "100b"), ("128m", "128m")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            df = readers.read_journals(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
            rows = df.select("_seq", "file_name").collect()
            best = journal.latest_records(readers.journal_records(df)).select("id", "file_name").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len({x["_seq"] for x in rows}) == len(rows) and [x["file_name"] for x in sorted(rows)] == want
        assert {x["id"]: x["file_name"] for x in best} == last


@pytest.mark.parametrize("sector", [512, 4096])
@pytest.mark.parametrize("names, kind", [
    (["WordDocument"], "doc"), (["1Table", "WordDocument", "Data"], "doc"), (["Workbook"], "xls"), (["Book"], "xls"), (["__properties_version1.0", "__substg1.0_0037001F"], "msg"),
    (["Contents"], "ole"), ([], "ole"), ([f"n{i}" for i in range(200)] + ["WordDocument"], "doc"), (["WordDocument2"], "ole"),
])
def test_compound_files(spark, names, kind, sector):
    whole = samples.compound_file(names, sector)
    circle = bytearray(whole)
    circle[sector + 4 : sector + 8] = (1).to_bytes(4, "little")  # the directory's chain runs into itself
    data = [whole, whole + b"more", whole[:-sector], whole[: sector + 20], whole[:40], bytes(circle), whole[:30] + b"\x20\0" + whole[32:]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], "k int, d binary")
    got = [x["kind"] for x in df.select("k", text.sniff_content(F.col("d"), F.lit("download")).alias("kind")).orderBy("k").collect()]
    assert got == [kind, kind] + ["ole"] * 5 if len(names) < 200 else got[:2] == [kind, kind] and set(got[2:]) == {"ole"}


def test_case_headers(spark):
    """What a header says: when, the folder's id first where there is one, and that texts aren't masked."""
    from foliary.sources import sinks

    summary = spark.createDataFrame([("A", 1, "ID1"), ("B", 2, None)], "matter string, files_described int, sharepoint_folder_id string")
    records = spark.createDataFrame([("x", "A", "s", "n.pdf")], "id string, caso string, subfolder string, file_name string")
    for masked in (False, True):
        heads = {x["caso"]: json.loads(x["value"]) for x in sinks.case_lines(records, summary, masked, "2024-05-06T07:08:09").filter("kind = 0").collect()}
        assert list(heads["A"]) == ["sharepoint_folder_id", "matter", "generated", "files_described", "note"] and "sharepoint_folder_id" not in heads["B"]
        assert heads["A"]["generated"] == "2024-05-06T07:08:09" and heads["A"]["note"].endswith("personal data they carry." if not masked else "appended later.")
    now = json.loads(sinks.case_lines(records, summary).filter("kind = 0").first()["value"])["generated"]
    assert len(now) == 19 and now[10] == "T"
