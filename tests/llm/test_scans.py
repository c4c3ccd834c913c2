"""Licence scans, fill-in-the-middle and lexical search against brute force, on small tables with every odd case."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foliary.llm import common, fill_middle, lexical_search, license_scan
from test_llm import SCHEMA, SF, clashing, none, odd, odd_rows, prose  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ 11
def brute_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = lambda phrases: [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    base, notices = places(license_scan.BASE), places(license_scan.NOTICES)
    at = [i for i, _ in base]
    joined = lambda found: ",".join(sorted({x for _, x in found}))
    return len(words), len(base), min(at, default=None), max(at, default=None), joined(base), joined(base + notices)


LICENCE_TEXTS = [
    "Released under the MIT License.", "under the mit licenses", "UNDER\nTHE\t(MIT)--license", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0 cc by nc by nc", "cc by nc", "cc by nc " * 3000,
    "under the under the mit license mit license", "apache license version 2 apache license version 2 0", "GNU General Public License, version 3", "ßcc by nc", "cc by ncé", "\x00cc\x00by\x00nc\x00", "All rights reserved", "cc_by_nc",
]


def test_licences_against_brute_force(spark, odd, none, clashing, tmp_path):  # noqa: F811
    rows = odd_rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(LICENCE_TEXTS)] + [(100, LICENCE_TEXTS[0], "en", "s", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = license_scan.op11_licenses(spark, f"file://{tmp_path}")
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    key = lambda r: tuple((x is not None, x) for x in r)
    want = sorted([(r[0], *brute_scan(r[1])) for r in rows], key=key)
    found = got.collect()
    assert sorted([tuple(r[c] for c in columns) for r in found], key=key) == want
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in found)
    assert license_scan.license_scan(none).count() == 0 and license_scan.license_scan(clashing).count() == 3
    # whole tables too
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(tuple(r[c] for c in columns[1:]) == brute_scan(texts[r["doc_id"]]) for r in license_scan.op11_licenses(spark, SF).collect())


@pytest.mark.parametrize(
    "line, text, labels, level",
    [
        ("MIT", "mit", ["mit"], "permissive"),
        ("(MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0 */", "(mit OR gpl-2.0-only WITH classpath-exception-2.0) AND apache-2.0", ["apache-2", "gpl-2.0-only", "mit"], "permissive"),
        ("GPL-2.0+ and see the file", "gpl-2.0+", ["gpl-2.0-or-later"], "strong copyleft"),
        ("mit or gpl-3.0-only and agpl-3.0", "mit OR gpl-3.0-only AND agpl-3.0", ["agpl-3.0", "gpl-3.0-only", "mit"], "permissive"),
        ("(mit or gpl-3.0-only) and agpl-3.0", "(mit OR gpl-3.0-only) AND agpl-3.0", ["agpl-3.0", "gpl-3.0-only", "mit"], "network copyleft"),
        ("GPL-3.0-only WITH GCC-exception-3.1 OR LicenseRef-own", "gpl-3.0-only WITH gcc-exception-3.1 OR licenseref-own", ["gpl-3.0-only", "licenseref-own"], "weak copyleft"),
        ("((MIT))", "((mit))", ["mit"], "permissive"),
        ("MIT AND (Apache-2.0 OR", "mit", ["mit"], "permissive"),
        ("(MIT OR Apache-2.0", None, [], None),
        ("and MIT", None, [], None),
        ("MIT)", "mit", ["mit"], "permissive"),
        ("MIT WITH GPL-2.0", "mit", ["mit"], "permissive"),
        ("some words", None, [], None),
        ("\nMIT", None, [], None),
    ],
)
def test_expressions(line, text, labels, level):
    scanner = license_scan.Scanner(license_scan.BASE, license_scan.NOTICES, license_scan.TAGS)
    found = scanner.scan(f"first é line\n# SPDX-License-Identifier: {line}")[3]
    assert found == ([(6, text, labels, level)] if text else [])


def test_expressions_by_brute_force():
    """Random trees, printed with as few parentheses as may be, come out with their own level."""
    names = ["mit", "gpl-3.0-only", "agpl-3.0", "mpl-2.0", "cc0-1.0", "gpl-2.0-only with classpath-exception-2.0"]
    levels = [1, 3, 4, 2, 0, 2]
    r = random.Random(5)

    def tree(depth):
        if depth == 0 or r.random() < 0.3:
            i = r.randrange(len(names))
            return names[i], levels[i], 3
        op = r.choice(["and", "or"])
        parts, rank = [tree(depth - 1) for _ in range(r.randint(2, 3))], 2 if op == "and" else 1
        text = f" {op} ".join(f"({t})" if p < rank or r.random() < 0.2 else t for t, _, p in parts)
        return text, (max if op == "and" else min)(x for _, x, _ in parts), rank

    for _ in range(300):
        text, level, _ = tree(4)
        got = license_scan.expression(text.encode(), 0)
        assert got[0].lower().replace(" ", "") == text.replace(" ", "") and got[2] == license_scan.LEVELS[level], text


def test_long_expressions_take_one_pass():
    text = b"mit or " * 200_000 + b"mit"
    assert license_scan.expression(text, 0)[1:] == (["mit"], "permissive")


# ------------------------------------------------------------------ 12
def brute_fim(doc, text, seed=7, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= percent:
        return n, "plain", text, None, None
    if h4 % 100 < spm:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_cuts_are_the_units():
    r = random.Random(1)
    for _ in range(2000):
        text = "".join(r.choice("ab\n é😀") for _ in range(r.randint(0, 40)))
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        blocks = fill_middle.Blocks(text, "\n", r.choice([1, 2, 3, 7, 64]))
        assert blocks.n == len(units) and [blocks.cut(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


@pytest.mark.parametrize("percent, spm", [(100, 50), (40, 0), (70, 100), (0, 50)])
def test_fill_in_middle(spark, none, clashing, percent, spm):  # noqa: F811
    lines = ["a\nb\nc", "\n", "\n\n\n", "one", "é\n日本\n😀 x", "has <P> inside\nx", "<M>", "ends <\n<S\n<", "x\r\ny\n", "\n".join(prose(i, 9) for i in range(3000)), "z" * 50_000 + "\n" + "y" * 9000]
    rows = odd_rows() + [(1000 + i, t, "en", "s", 1) for i, t in enumerate(lines * 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = fill_middle.fill_in_middle(docs, percent=percent, spm=spm).withColumn("again", fill_middle.restored(F.col("fim.output"), F.col("fim.form")))
    got = [(r["doc_id"], r["text"], *r["fim"], r["again"]) for r in found.collect()]
    want = [(r[0], r[1], *brute_fim(r[0], r[1], 7, percent, spm), r[1] or "") for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert fill_middle.fill_in_middle(none).count() == 0
    out = fill_middle.fill_in_middle(clashing.withColumn("fim", F.lit("mine")))
    assert out.columns == [*clashing.columns, "fim", "_fim"] and {r["fim"] for r in out.collect()} == {"mine"}


def test_sentinels_must_be_told_apart(spark, odd):  # noqa: F811
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "<P>x", "<M>"), ("<<P", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(odd, sentinels=bad)


# ------------------------------------------------------------------ 13
def brute_search(rows, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    docs = [(d, c) for d, t in rows if (c := Counter(terms(t)))]
    total, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, mine in wanted.items():
        scored = []
        for d, c in docs:
            m = 10 + 90 * sum(c.values()) * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in mine if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_best_first_is_exhaustive():
    r = np.random.default_rng(0)
    for _ in range(300):
        docs, terms = int(r.integers(1, 60)), int(r.integers(1, 8))
        doc, term = np.nonzero(r.random((docs, terms)) < r.choice([0.05, 0.4, 1.0]))
        impact = r.integers(1, r.choice([2, 6, 10**9]), len(doc))  # often equal
        postings = lexical_search.Postings(doc, term * 3, impact, docs)
        wanted = np.unique(r.choice(3 * terms + 2, 4))
        sums = np.bincount(doc, weights=np.where(np.isin(term * 3, wanted), impact, 0), minlength=docs).astype(int)
        for k in (1, 3, 10):
            best = [i for i in np.lexsort((np.arange(docs), -sums)) if sums[i] > 0][:k]
            found, scores = postings.best(wanted, k)
            assert found.tolist() == best and scores.tolist() == sums[best].tolist()


@pytest.mark.parametrize("options", [{}, {"per_group": 40, "block_terms": 5}, {"most_bytes": 0}, {"k": 3, "per_group": 7}])
def test_search_against_brute_force(spark, none, options):  # noqa: F811
    words = prose(3, 60).split()
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(words[: r.choice([5, 20, 60])]) for _ in range(r.randint(0, 40)))) for i in range(150)]
    rows += [(x[0], x[1]) for x in odd_rows()] + [(500 + i, "same words here") for i in range(20)] + [(7, "same words here"), (None, "same words here"), (None, "same words here")]
    items = [(i, " ".join(r.choice(words) for _ in range(12))) for i in range(8)]
    items += [(100, "Same-WORDS... here"), (101, None), (102, ""), (103, "nowhere"), (None, words[0]), (104, words[1]), (104, words[2] + " " + words[1]), (105, "日本語 é"), (106, prose(2, 60000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("x")).withColumn("n", F.lit("x")).withColumn("term", F.lit("x"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit("x"))
    got = [tuple(x) for x in lexical_search.search(docs, asked, **options).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_search(rows, items, options.get("k", 10))))


def test_search_nothing(spark, none):  # noqa: F811
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.search(none, some).count() == 0
    assert lexical_search.search(some.withColumnRenamed("item_id", "doc_id"), some.filter("false")).count() == 0


@pytest.mark.parametrize("name, query, sql", [("12", fill_middle.op12_fill_middle, fill_middle.OP12_SQL), ("13", lexical_search.op13_lexical_search, lexical_search.OP13_SQL)])
def test_sql(spark, name, query, sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(sql)
    columns = [d[0] for d in want.description]
    assert sorted(map(tuple, query(spark, SF).select(*columns).collect())) == sorted(want.fetchall())
    assert common.documents(spark, SF).count() > 0


def test_every_two_windows_of_a_list_may_meet(spark):
    """Near passages that hold a line of all texts: the exact way has every pair that comparing all with all has."""
    import random

    import numpy as np

    from foliary.llm import passages
    from foliary.llm.shingles import text_shingles

    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    line = [word() for _ in range(32)]
    tails = [[word() for _ in range(24)] for _ in range(6)]
    texts = []
    for i in range(36):
        tail = list(tails[i % 6])
        tail[r.randrange(24)] = word()
        texts.append(" ".join([word() for _ in range(30)] + line + tail + [word() for _ in range(30)]))
    sets = [(s & np.uint64(0xFFFFFFFF)).astype("<u4") for s in text_shingles(texts)]
    want = {(i, j) for i in range(36) for j in range(i) if passages.matches(sets[i], sets[j], 46, 75)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(x["doc_id"], x["match_id"]) for x in passages.passages(docs, pivots=None).select("doc_id", "match_id").collect()}
    assert len(want) > 36 and want <= got


def test_long_lists_are_dealt_and_every_two_windows_meet_once(spark):
    from foliary.llm import passages

    r = random.Random(5)
    rows = [(r.choice([1, 1, 1, 2, 3, 4 + i]), r.randrange(40), i, i) for i in range(300)] + [(9, 7, 1, 1), (9, 7, 2, 2)]
    windows = spark.createDataFrame(rows, "sig long, doc long, at int, until int")
    want = sorted((s, d, a, u, e, b) for s, d, a, u in rows for t, e, b, _ in rows if s == t and d > e)
    for most in (7, 10_000):
        met = passages.all_pairs(windows, most)
        assert sorted(tuple(x) for x in met.select("sig", "doc", "at", "until", "pivot", "pat").collect()) == want


def test_the_query_of_passages_leaves_no_pair_to_drawn_pivots(spark, monkeypatch):
    """Near passages around a line that all texts have, in families: drawn pivots leave pairs of a family unmet."""
    from foliary.llm import passages
    from foliary.llm.shingles import text_shingles

    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    line, tails, texts = [word() for _ in range(32)], [[word() for _ in range(24)] for _ in range(6)], []
    for i in range(36):
        tail = list(tails[i % 6])
        tail[r.randrange(24)] = word()
        texts.append(" ".join([word() for _ in range(30)] + line + tail + [word() for _ in range(30)]))
    sets = [(s & np.uint64(0xFFFFFFFF)).astype("<u4") for s in text_shingles(texts)]
    want = {(i, j) for i in range(36) for j in range(i) if passages.matches(sets[i], sets[j], 46, 75)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(common, "documents", lambda spark, sf: docs)
    pairs = lambda df: {(x["doc_id"], x["match_id"]) for x in df.select("doc_id", "match_id").collect()}
    assert want <= pairs(passages.op5_passages(spark, "")) and want - pairs(passages.passages(docs))
