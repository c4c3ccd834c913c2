"""Rules that need more than one row."""

from datetime import date
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from foliary.operators import assemble, classify, duplicates, identity, journal, staging
from foliary.sources import readers, sinks
from foliary.streaming import journals

JOURNAL = "id string, file_name string, hash string, was_read boolean, not_read_because string, ocr_ok boolean, reader_version int, _seq long"


def rows(*attempts, name="a.pdf", version=4):
    """Attempts of one file: True for read, else the reason."""
    return [("x", name, None, a is True, None if a is True else a, False, version, i) for i, a in enumerate(attempts)]


@pytest.mark.parametrize("attempts, kept", [
    ((True, "HTTP 429"), 0), (("password protected", "HTTP 429"), 0), (("HTTP 429", "empty file (0 bytes)"), 1), ((True, True), 1),
])
def test_precedence(spark, attempts, kept):
    best = journal.latest_records(spark.createDataFrame(rows(*attempts), JOURNAL)).collect()
    assert [r["_seq"] for r in best] == [kept]


def test_stale_readers(spark):
    assert journal.latest_records(spark.createDataFrame(rows(True, version=2), JOURNAL)).count() == 0
    assert journal.latest_records(spark.createDataFrame(rows("no reader for .doc", version=3), JOURNAL)).count() == 0


def test_definitive(spark):
    data = [("x", "a", None, False, "OCR found no text in the image", True, 4, 0), ("y", "a", None, False, "OCR found no text in the image", None, 4, 0), ("z", "~$a.docx", None, False, "any", None, 4, 0), ("w", None, None, None, None, None, None, 0)]
    got = spark.createDataFrame(data, JOURNAL).select("id", journal.is_definitive().alias("d")).collect()
    assert {r["id"]: r["d"] for r in got} == {"x": True, "y": False, "z": True, "w": False}


def test_latest_is_the_same_however_dealt(spark):
    data = [(f"f{i % 7}", "a", None, i % 3 == 0, "HTTP 429", False, 4, i) for i in range(60)]
    df = spark.createDataFrame(data, JOURNAL)
    once = {tuple(r) for r in journal.latest_records(df).collect()}
    assert once == {tuple(r) for r in journal.latest_records(df.repartition(9)).collect()} == {tuple(r) for r in journal.latest_records(journal.latest_records(df)).collect()}


def test_shards_nest_and_keep_copies_together(spark):
    df = spark.createDataFrame([(f"i{i}", f"h{i % 9}" if i % 2 else None) for i in range(200)], "id string, hash string")
    got = df.select("hash", staging.md5_shard(staging.share_key(), 12).alias("a"), staging.md5_shard(staging.share_key(), 24).alias("b")).collect()
    assert all(r["b"] % 12 == r["a"] for r in got)
    assert all(len({r["a"] for r in got if r["hash"] == h}) == 1 for h in {r["hash"] for r in got} - {None})


def test_text_windows(spark):
    late = "x" * 400
    data = [(1, "Notice of Appearance " + "y" * 781 + " certificate of service"), (2, "Dear " + "z " * 250 + "credit report"), (3, "Dear " + late * 5 + " credit report"), (4, "  ")]
    types = {i: t[0] for i, t in enumerate(classify.DOC_TYPES)}
    got = classify.with_text_type(spark.createDataFrame(data, "id int, t string"), "t").select("id", "text_type.*").collect()
    assert {r["id"]: (types.get(r["rank"]), r["where"]) for r in got} == {1: ("Notice of appearance", "titulo"), 2: ("Credit report", "titulo"), 3: ("Letter", "titulo"), 4: (None, "")}


@pytest.mark.parametrize("name, template, result", [
    ("W2 and TAX RETURNS - Copy", "Foreclosure", ("02_Loss Mitigation/Taxes", "clear")), ("Notices(1)", "FCRA", ("11_Notices", "proposed")),
    ("HOA, INSURANCE, UTILITY, RE TAXES", "Foreclosure", ("02_Loss Mitigation", "proposed")), ("PRIOR BANKRUPTCY", "Foreclosure", ("00_Sin clasificar", "ASK")),
    ("Correspondence", "FCRA", ("00_Sin clasificar", "no place in this template")), ("Zebra", "FCRA", ("00_Sin clasificar", "no match")),
])
def test_map_folder(spark, name, template, result):
    got = classify.map_folder(spark.createDataFrame([(name, template)], "n string, t string"), "n", "t").first()
    assert (got["destination"], got["certainty"]) == result


def test_destinations_exist(spark):
    assert classify.validate_destinations(spark).count() == 0


def test_matters(spark):
    data = [(1, "p", "Sam Poe (Index# 712345/2023)"), (2, "p", "Sam Poe - Index# 712345/2023"), (3, "l", "Lee Dee Moe - Foreclosure - 12 Alpha Corp - Art 15"), (4, "l", "Lee Dee Moe - Foreclosure - 12 Beta Place Springfield, NY 11111"), (5, "b", "Example Bank National Trust Company - Foreclosure")]
    df = spark.createDataFrame(data, "matter_id int, client string, matter string").withColumn("client", F.when(F.col("client") == "b", "Example Bank National Trust Company").when(F.col("client") == "p", "Sam Poe").otherwise("Lee Dee Moe"))
    got = {r["matter_id"]: r["verdict"] for r in duplicates.classify_client_matters(df).collect()}
    assert got == {1: "DUPLICADO", 2: "DUPLICADO", 3: "CASO DISTINTO", 4: "CASO DISTINTO", 5: "INCOMPLETO"}


def test_pairs_that_names_decide(spark):
    """Only the similarity of the names is left: almost equal, or different by so many percent."""
    def percent(x, y):
        best = max(SequenceMatcher(None, p, q).ratio() for p, q in ((x, y), (" ".join(sorted(x.split())), " ".join(sorted(y.split())))))
        return f"{int(best * 100 + 0.5)}%"

    rows = [(1, "a", "Roe", "Roe, Pat - Dispute"), (2, "b", "Roe", "Roe, Pat - Disputes"), (3, "a", "Roe", "Roe - Alpha Zebra"), (4, "b", "Roe", "Roe - Quill Mango"), (5, "a", "Roe", "Roe - 12 Alpha Grove"), (6, "b", "Roe", "Roe - 12 Alpha Grove, again")]
    df = identity.matter_features(spark.createDataFrame(rows, "k int, side string, client string, matter string"))
    cols = ["matter", "indexes", "files", "addresses", "markers", "people", "generic"]
    side = lambda s, p, k: df.filter(F.col("side") == s).select(k.alias("pair"), *[F.col(c).alias(p + c) for c in cols])
    got = {r["pair"]: (r["verdict"], r["reason"]) for r in identity.compare_matters(side("a", "a_", F.col("k")).join(side("b", "b_", F.col("k") - 1), "pair")).collect()}
    assert got == {
        1: ("DUPLICADO", f"nombres casi identicos ({percent('roe pat dispute', 'roe pat disputes')} de coincidencia)"),
        3: ("CASO DISTINTO", f"nombres diferentes ({percent('roe alpha zebra', 'roe quill mango')} de coincidencia)"),
        5: ("DUPLICADO", "misma direccion en los dos nombres"),
    }


def test_resolve_case_with_people(spark):
    cases = spark.createDataFrame([("Angertson, Pat - 600001 - 0", "Angertson, Pat", ""), ("Zimmer, Al - 600002 - 0", "Zimmer, Al", "")], "folder string, base string, index_number string")
    docs = spark.createDataFrame([(1, "nothing", [], []), (2, "nothing", [], [])], "doc_id long, text string, numbers array<string>, caption_numbers array<string>")
    people = spark.createDataFrame([(1, "Pat Angertsen")], "doc_id long, person string")
    got = {r["doc_id"]: r["folder"] for r in identity.resolve_case(docs, cases, people).collect()}
    assert got == {1: "Angertson, Pat - 600001 - 0", 2: None}


def test_journal_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1","was_read":true,"extracted_text":"x y"}\n\nnot json\n{"id":"2","was_read":false}\n')
    df = readers.read_journals(spark, str(tmp_path))
    assert readers.journal_records(df).count() == 2
    assert readers.corrupt_line_report(df).collect()[0]["corrupt_lines"] == 1


def test_id_list(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# head\n a \n\nb\n")
    assert [r["id"] for r in readers.read_id_list(spark, str(tmp_path)).collect()] == ["a", "b"]


def test_crm(spark, tmp_path):
    (tmp_path / "crm.csv").write_text('Record ID,Matter Name,Matter Stage,Case Type,Retainer Signed Date,Book Value,Associated Contact\n1, M  ,🚫 (RM Migration - Do Not Use),,2024-01-02,abc,"Ann (a@example.org);Bob (b@example.org)"\n')
    r = readers.read_crm_export(spark, str(tmp_path / "crm.csv"), "2024-01-12").first()
    assert (r["matter"], r["not_in_use"], r["case_type"], r["book_value"], r["client"], r["email"], r["days_since_signed"], r["month"]) == ("M", True, "(sin tipo)", None, "Ann", "a@example.org", 10, "2024-01")
    assert r["signed"].date() == date(2024, 1, 2)


def test_case_files(spark, tmp_path):
    records = spark.createDataFrame([("i1", "Doe, Jane - 600001 - 0", "b", "z.pdf", True), ("i2", "Doe, Jane - 600001 - 0", "a", "y.pdf", False)], "id string, caso string, subfolder string, file_name string, was_read boolean")
    totals = spark.createDataFrame([("Doe, Jane - 600001 - 0", 3)], "exp string, files long")
    sinks.write_case_jsonl(records, assemble.case_summary(records, totals), str(tmp_path / "out"))
    [file] = (tmp_path / "out" / "file=Claude-600001").glob("*.txt")
    lines = file.read_text().splitlines()
    assert '"files_described":2' in lines[0] and '"partial":true' in lines[0] and [("i2" in x) for x in lines[1:]] == [True, False]


def test_stream_equals_batch(spark, tmp_path):
    data = [(f"f{i % 5}", "a", None, i % 4 == 0, "HTTP 429", False, 4, i) for i in range(40)]
    df = spark.createDataFrame(data, JOURNAL)
    for part in range(4):
        df.filter(F.col("_seq") % 4 == part).write.parquet(str(tmp_path / "in" / f"p{part}"))
    table = journals.LatestTable(spark, str(tmp_path / "latest"), JOURNAL, ["_seq"])
    stream = spark.readStream.schema(JOURNAL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    journals.stream_latest_records(stream, table, str(tmp_path / "check")).awaitTermination()
    assert sorted(table.read().collect()) == sorted(journal.latest_records(df).collect())


def test_rebalance(spark):
    load = spark.createDataFrame([("a", i, 1.0) for i in range(6)] + [("b", 10, 1.0)], "team string, half_shard int, hours double")
    moves = staging.rebalance(load).collect()
    assert len(moves) == 2 and {(m["from_team"], m["to_team"]) for m in moves} == {("a", "b")}


def test_case_files_on_a_mounted_folder(spark, tmp_path):
    """Tasks place and read a case's file by plain calls: names as Spark would escape them, old files gone, none half written, and Spark reads the same."""
    from foliary.sources import sinks

    names = ["a", 'q/:%="x', "ü ñ", None]
    rows = [(n, 1, f"{n} {i}\r ") for n in names for i in range(300)]
    (tmp_path / "out" / "file=old").mkdir(parents=True)
    (tmp_path / "out" / "file=old" / "part-0.txt").write_text("old")
    records = spark.createDataFrame([(f"D, J - {600000 + i} - 210{i}-2019", f"i{i}", "n", "", "é") for i in range(9)], "caso string, id string, file_name string, subfolder string, text string")
    summary = records.select(records.caso.alias("matter"))
    sinks.write_case_jsonl(records, summary, f"file://{tmp_path}/out", generated="now")
    assert not list((tmp_path / "out").glob("*/_*")) and not (tmp_path / "out" / "file=old").exists() and (tmp_path / "out" / "_SUCCESS").exists()
    assert len(list((tmp_path / "out").glob("file=*/*.txt"))) == 9 and not list((tmp_path / "out").rglob("*.crc"))
    spark.createDataFrame(rows, "file string, kind int, value string").select("file", "value").coalesce(1).write.partitionBy("file").text(f"{tmp_path}/spark")
    (tmp_path / "own").mkdir()
    got = spark.createDataFrame(rows, "file string, kind int, value string").select("file", "value").coalesce(1).mapInArrow(sinks.place_files(str(tmp_path / "own")), "files long")
    assert got.first()["files"] == 4
    whole = lambda p: {r["file"]: r["value"] for r in spark.read.schema("value string, file string").text(f"{tmp_path}/{p}", wholetext=True).collect()}
    assert whole("own") == whole("spark") and {p.name for p in (tmp_path / "own").iterdir()} == {p.name for p in (tmp_path / "spark").iterdir() if p.is_dir()}
    read = spark.createDataFrame([(n,) for n in [*names, "none"]], "file string").mapInArrow(sinks.read_files(str(tmp_path / "own"), 1000), "value string, file string")
    assert {r["file"]: r["value"] for r in read.collect()} == whole("own")
