"""Verdicts on matters against all pairs of their clients."""

import random

import pytest
from pyspark.sql import functions as F

from foliary.operators import duplicates, identity

SCHEMA = "matter_id long, client string, matter string, files array<string>"


def all_pairs(matters):
    """The verdicts by every pair of a client."""
    f = identity.matter_features(matters)
    side = lambda p: f.select("client", *[F.col(c).alias(p + c) for c in ["matter_id", *duplicates.FEATURES]])
    pairs = identity.compare_matters(side("a_").join(side("b_"), "client").filter("a_matter_id < b_matter_id")).collect()
    own = {}
    for r in pairs:
        for me, other in (("a_", "b_"), ("b_", "a_")):
            verdict, reason = r["verdict"], f"{r['reason']} (vs {r[other + 'matter'] or ''})"
            if verdict == "DUPLICADO SIN ESPECIFICAR":
                if r[me + "generic"]:
                    reason = f"no especifica el caso y el cliente si tiene otro matter especificado ({r[other + 'matter'] or ''})"
                else:
                    verdict, reason = "CASO DISTINTO", "esta especificado"
            level = ["DUPLICADO", "DUPLICADO SIN ESPECIFICAR", "CASO DISTINTO"].index(verdict)
            own.setdefault(r[me + "matter_id"], []).append((level, r[other + "matter_id"], verdict, reason))
    out = {}
    for r in f.select("matter_id", "generic").collect():
        best = min(own.get(r["matter_id"], [(3, 0, "INCOMPLETO" if r["generic"] else "CASO UNICO", None)]))
        out[r["matter_id"]] = best[2:]
    return out


def names(seed, n):
    """Names with and without numbers, addresses, markers and people, near copies of one another, and odd ones."""
    r = random.Random(seed)
    words = ["alpha", "grove", "quill", "mango", "zebra", "dispute", "disputes", "lender", "servicer", "harbor", "north"]
    people = ["Roe, Pat", "Roe, Sam", "Poe", "Doe, Kim"]
    out = []
    for _ in range(n):
        parts = [r.choice(people)] if r.random() < 0.7 else []
        parts += [" ".join(r.choice(words) for _ in range(r.randint(0, 4)))]
        parts += r.choice([[], [], ["Foreclosure"], ["Appeal"], ["ID Theft"], [f"Index# 7000{r.randint(0, 4):02}/2023"], [f"{r.randint(1, 3)}2 Alpha Grove"], ["x" * r.randint(0, 3)]])
        text = " - ".join(p for p in parts if p)
        if r.random() < 0.3 and text:
            i = r.randrange(len(text))
            text = text[:i] + r.choice(["", "q", " "]) + text[i + 1 :]
        out.append(r.choice([text, text, text, text.upper(), text.replace(" - ", "-"), r.choice(out)[0] if out else text, "", None]))
        out[-1] = (out[-1], r.choice([[], [], [], [f"F{r.randint(0, 5)}"]]))
    return out


@pytest.mark.parametrize("few, rounds", [(32, duplicates.ROUNDS), (0, duplicates.ROUNDS), (0, (1, 3, 2**31 - 1))])
def test_equal_to_all_pairs(spark, few, rounds):
    rows = [(i, client, n, files) for i, (client, (n, files)) in enumerate(zip(["A"] * 60 + ["B"] * 25 + [None] * 3 + ["C", "D", "D"], names(few + len(rounds), 91)))]
    random.Random(1).shuffle(rows)
    matters = spark.createDataFrame(rows, SCHEMA)
    want = all_pairs(matters)
    got = {r["matter_id"]: (r["verdict"], r["reason"]) for r in duplicates.classify_client_matters(matters, few, rounds).collect()}
    assert set(got) == set(want)
    for i, (verdict, reason) in want.items():
        assert got[i][0] == verdict and (reason is None or got[i][1] == reason), (i, got[i], want[i], rows)


def test_similarity_that_hangs_on_the_order(spark):
    """Pairs of names whose similarity is enough in one order only, each name on several matters with ids in between."""
    from difflib import SequenceMatcher

    r, found = random.Random(7), []
    ratio = lambda a, b: max(SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, " ".join(sorted(a.split())), " ".join(sorted(b.split()))).ratio())
    while len(found) < 3:
        a = "".join(r.choice("aaabbbcd") for _ in range(20))
        b = "".join(c for c in a if r.random() > 0.06)
        b = "".join(c + (r.choice("ab") if r.random() < 0.06 else "") for c in b)
        if (ratio(a, b) >= 0.9) != (ratio(b, a) >= 0.9):
            found.append((a, b))
    rows = []
    for k, (a, b) in enumerate(found):
        for i in range(12):
            # people's words differ, so names are one word that both sides share with no one: people must meet or be missing
            rows.append((100 * k + i, f"c{k}", (a, b)[r.random() < 0.5], []))
    matters = spark.createDataFrame(rows, SCHEMA)
    f = identity.matter_features(matters).withColumn("people", F.array().cast("array<string>"))
    f = f.withColumns({"id": F.col("matter_id"), "mark": F.lit(""), "name": F.col("matter"), **{c: F.lit(False) for c in ("has_index", "has_file", "has_address")}, "generic": F.lit(False)})
    got = {}
    for x in duplicates.alike(f, 0).collect():
        got[x["id"]] = min(got.get(x["id"], x["other"]), x["other"])
    for i, c, n, _ in rows:
        like = [j for j, d, m, _ in rows if c == d and i != j and ratio(*((n, m) if i < j else (m, n))) >= 0.9]
        assert got.get(i) == min(like, default=None)


def test_a_client_with_very_many_matters(spark):
    """What meets in lists grows with the matters, not with their square."""
    r, met = random.Random(2), []
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(4, 9))) for _ in range(20_000)]
    for n in (2_000, 8_000):
        rows = [(i, "Big", f"big {r.choice(words)} {r.choice(words)} {r.choice(words)}") for i in range(n)]
        f = spark.createDataFrame(rows, "id long, client string, name string")
        f = f.withColumns({"mark": F.lit(""), "people": F.array(F.lit("big")), **{c: F.lit(False) for c in ("has_index", "has_file", "has_address", "generic")}})
        lists = duplicates.list_keys(duplicates.profiles(f), 0.9, 32).groupBy("client", "mark", "key").agg(F.count(F.lit(1)).alias("n"))
        met.append(lists.agg(F.sum(F.expr("n * (n - 1) div 2"))).first()[0])
    assert met[1] < 8_000 * 25, met  # of 32 million pairs
