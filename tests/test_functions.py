"""Golden cases of the functions, with invented names."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from foliary.functions import names, text


def one(spark, make, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'int' if isinstance(v, int) else 'binary'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(make(*[F.col(k) for k in values]).alias("x")).first()["x"]


@pytest.mark.parametrize("value, numbers", [
    ("Sam Poe (Index# 712345/2023)", ["712345-2023"]),
    ("723456/18 and 723456-2018", ["723456-2018"]),
    ("534567_2020.pdf", ["534567-2020"]),
    ("Springfield, PA 19000-2000", []),
    ("5001-10,000", []),
    ("2024-12", []),
    ("0001-001 and 7000- 08.20.24", []),
    ("545678/2015, que grava", ["545678-2015"]),
    (None, []),
])
def test_state_indexes(spark, value, numbers):
    assert one(spark, names.extract_state_indexes, v=value) == numbers


@pytest.mark.parametrize("value, number", [("1:25-cv-01111", "1-25-cv-1111"), ("1-25-cv-1111", "1-25-cv-1111"), ("125-cv-1111", "1-25-cv-1111"), ("EF001234-2017", "EF1234-2017")])
def test_case_numbers(spark, value, number):
    assert number in one(spark, names.extract_case_numbers, v=value)


@pytest.mark.parametrize("name, parts", [
    ("Doe, Jane - Closed - 600123 - 556789-2026", ("Doe, Jane", "600123", "556789-2026", True)),
    ("Closed - Doe, Jane - 600123 - 556789-2026", ("Doe, Jane", "600123", "556789-2026", True)),
    ("10-22NB - Roe - 600124 - 567890-2021", ("10-22NB - Roe", "600124", "567890-2021", False)),
    ("Smith", ("Smith", "", "", False)),
])
def test_split_case_name(spark, name, parts):
    assert tuple(one(spark, names.split_case_name, v=name)) == parts


def test_compose_case_name(spark):
    made = one(spark, names.compose_case_name, b="Sample, Pat -", i="600125", n=None, s="Active Matters")
    assert made == "Sample, Pat - 600125 - 0"


def test_ssn(spark):
    assert one(spark, text.mask_ssn, v="is 123-45-6789.") == "is XXX-XX-6789."
    assert one(spark, text.contains_ssn, v=None) is False


def test_needs_ocr(spark):
    stamp = "FILED: KINGS COUNTY CLERK 01/02/2024 10:11 AM\nNYSCEF DOC. NO. 12\n"
    assert one(spark, text.needs_ocr, t=stamp * 14, p=14)["flag"]
    assert one(spark, text.needs_ocr, t="/0/1/2/3/1/4/3/2/5/6/i255" * 20, p=1)["flag"]
    assert one(spark, text.needs_ocr, t="  ", p=1)["reason"] == "the text layer came back empty"
    assert not one(spark, text.needs_ocr, t="plain words that mean something " * 10, p=1)["flag"]


def test_noise(spark):
    assert not one(spark, text.looks_like_noise, t="%12Ab3@c4dE")
    assert not one(spark, text.looks_like_noise, t="EXHIBIT A")
    assert one(spark, text.looks_like_noise, t="1 2 3 % " * 20)


def test_code(spark):
    assert one(spark, text.looks_like_code, t="function f(){ var x = this.y; return x===1; }\n" * 10)
    assert not one(spark, text.looks_like_code, t="A letter (with one bracket); nothing more. " * 20)


@pytest.mark.parametrize("data, kind", [
    (b"%PDF-1.7 ...", "pdf"), (b"\x89PNG\r\n\x1a\n", "png"), (b"\xff\xd8\xff\xe0abc", "jpg"), (b"GIF89a....", "gif"), (b"{\\rtf1 hello}", "rtf"),
    (b"<html><body>x</body></html>", "html"), (b"From: a@example.org\r\nSubject: b\r\n\r\nbody", "eml"), (b"plain text here", "txt"), (b"abc", None),
])
def test_sniff(spark, data, kind):
    df = spark.createDataFrame([(data, "download")], "d binary, e string")
    assert df.select(text.sniff_content(F.col("d"), F.col("e")).alias("x")).first()["x"] == kind


@pytest.mark.parametrize("given, kind", [("txt", "txt"), ("css", "css"), ("final version", "txt"), ("2019", "txt"), ("", "txt"), ("DAT", "txt"), ("toolongext", "txt")])
def test_sniff_heeds_extensions_that_say_something(spark, given, kind):
    df = spark.createDataFrame([(b"plain text here, and more", given)], "d binary, e string")
    assert df.select(text.sniff_content(F.col("d"), F.col("e")).alias("x")).first()["x"] == kind


@pytest.mark.parametrize("members, kind", [
    (["word/document.xml", "a.txt"], "docx"), (["xl/workbook.bin"], "xlsb"), (["xl/workbook.xml"], "xlsx"), (["ppt/presentation.xml"], "pptx"), (["notes/word/document.xml"], "zip"), (["word/document.xml.bak"], "zip"),
    (["mimetype:application/vnd.oasis.opendocument.text"], "odt"), (["mimetype:application/vnd.oasis.opendocument.spreadsheet", "content.xml"], "ods"), ([], "zip"),
])
def test_containers(spark, members, kind):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for m in members:
            name, _, body = m.partition(":")
            z.writestr(name, body or "x" * 50, zipfile.ZIP_STORED if body else zipfile.ZIP_DEFLATED)
    df = spark.createDataFrame([(out.getvalue(),), (out.getvalue()[:-len(out.getvalue()) // 2],)], "d binary")
    assert df.select(text.container_kind(F.col("d")).alias("x")).first()["x"] == kind


@pytest.mark.parametrize("data", [
    "plain é ñ 日本".encode(), "wide é 日本 😀".encode("utf-16"), b"\xfe\xff" + "big é 😀".encode("utf-16-be"), "café “quoted” …x".encode("cp1252"), "caf\xe9!".encode("latin-1"), b"odd \x81\x8d\xe9",
    b"\x3d\xd8\x00\xde\xe9\xe9", b"\x3d\xd8\xe9\xe9", b"\xe9\x00\x3d\xd8", b"\xe9\x00\x00\xde", b"", b" \n ", "\ufeffmark".encode(), b"\xff\xfe",
])
def test_decode_text(spark, data):
    for encoding in ("utf-8", "utf-16", "cp1252", "latin-1"):
        try:
            want = data.decode(encoding)
            break
        except UnicodeError:
            continue
    want = (want, "") if want.strip() else ("", "the text file is empty")
    got = spark.createDataFrame([(data,)], "d binary").select(text.decode_text(F.col("d")).alias("x")).first()["x"]
    assert tuple(got) == want
    assert tuple(spark.createDataFrame([(None,)], "d binary").select(text.decode_text(F.col("d")).alias("x")).first()["x"]) == ("", "the text file is empty")


def test_passwords(spark):
    assert one(spark, text.password_candidates, t="Password: Secret1. and pwd = Other99") == ["Secret1", "Other99"]
    assert one(spark, text.password_candidates, t="\n  OnlyLine \n") == ["OnlyLine"]
    assert one(spark, text.password_candidates, t="two\nlines") == []
    assert one(spark, text.is_password_file, t="the Passcode.txt")


def test_html(spark):
    page = lambda v: one(spark, text.html_to_text, v=v)
    assert page("<p>One &amp; two</p><script>no()</script><td>three</td>") == "One & two \n three \n"
    assert page("<!-- <p>no</p> --><STYLE type='a>b'>x{}</style ><a href=\"x>y\" title='>'> link </a>1 < 2 &lt;b&gt; &#233;&nbsp;") == "link 1 < 2 <b> é"
    assert page("a<br>b</br>\n\n\n\nc") == "a b \n c" and page("x\n\n\n\ny") == "x\n\ny"
    assert page("<script>never closed") == "" and page(None) == "" and page("") == ""


def test_similarity_and_neighbours(spark):
    assert one(spark, names.name_similarity, a="Poe, Sam", b="Sam Poe") == 1.0
    assert one(spark, names.one_char_apart, a="81234-2023", b="812345-2023")
    assert not one(spark, names.one_char_apart, a="12345", b="12345")


def test_json_line(spark):
    line = spark.createDataFrame([("a b\u0085é",)], "t string").select(text.json_line(F.struct("t")).alias("x")).first()["x"]
    assert line == '{"t":"a\\u2028b\\u0085é"}'


@pytest.mark.parametrize("html, shown, failure", [
    ("<p>One</p>", "One \n", ""), ("<script>x()</script> <p> </p>", "", "the HTML page has no text"), ("", "", "could not decode the HTML file"), (None, "", "could not decode the HTML file"), ("&nbsp;", "", "the HTML page has no text"),
])
def test_pages_without_text_say_why(spark, html, shown, failure):
    r = one(spark, text.read_html, v=html)
    assert (r["text"], r["failure"]) == (shown, failure)
