"""Literals that patterns need: whatever a pattern matches holds one of them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from foliary.functions.literals import candidates, may_match, required_literals
from foliary.operators import classify
from foliary.rules.doc_types import DOC_TYPES


@pytest.mark.parametrize(
    "pattern, found",
    [
        ("abc", ["abc"]), ("Abc|xY", ["abc", "xy"]), (r"\babc\b de", ["abc de"]), ("ab?c", ["a"]), ("(abc)+d", ["abc"]), ("(abc)*d", ["d"]), (r"\d+", None), ("abc|", None), ("a.{0,3}bcd", ["bcd"]),
        ("(ab|cde)fgh", ["fgh"]), ("(abcd|efgh)x", ["abcd", "efgh"]), ("[ab]cd", ["cd"]), ("é|abc", None), ("foo|foobar", ["foo"]), ("", None),
    ],
)
def test_required_literals(pattern, found):
    assert required_literals(pattern) == found


def sample(pattern, r):
    """A text that the pattern matches, by its own parse."""
    from re import _constants as kinds, _parser as parser

    def made(items):
        out = ""
        for op, v in items:
            if op is kinds.LITERAL:
                out += r.choice([chr(v), chr(v).upper()])
            elif op is kinds.SUBPATTERN:
                out += made(v[3])
            elif op is kinds.BRANCH:
                out += made(r.choice(v[1]))
            elif op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
                out += "".join(made(v[2]) for _ in range(r.randint(v[0], min(v[1], v[0] + 2))))
            elif op is kinds.ANY:
                out += r.choice("xyz ")
            elif op is kinds.IN:
                out += r.choice([c for c in "abcdefghijklmnopqrstuvwxyz0123456789 -_.()&:/\n" if re.match(parser_text(v), c)] or ["a"])
        return out

    def parser_text(v):
        parts = ""
        for op, x in v:
            parts += re.escape(chr(x)) if op is kinds.LITERAL else f"{re.escape(chr(x[0]))}-{re.escape(chr(x[1]))}" if op is kinds.RANGE else {kinds.CATEGORY_DIGIT: r"\d", kinds.CATEGORY_SPACE: r"\s", kinds.CATEGORY_WORD: r"\w"}.get(x, "") if op is kinds.CATEGORY else "^" if op is kinds.NEGATE else ""
        return f"[{parts}]"

    return made(parser.parse(pattern, re.I))


def test_what_rules_match_is_a_candidate(spark):
    """Texts made from each rule's own pattern, in any case, among other words."""
    r, rows = random.Random(4), []
    patterns = [x[1] for x in DOC_TYPES]
    for i, p in enumerate(patterns):
        for _ in range(12):
            rows.append((i, f"{r.choice(['', 'Words before. ', 'a\n'])}{sample(p, r)}{r.choice(['', ' and after', chr(10)])}"))
    df = spark.createDataFrame(rows, "rule int, text string").withColumn("may", candidates(F.col("text"), patterns))
    hits = df.withColumn("short", F.array_compact(F.array(*[F.when(may_match(F.lower("text"), p), F.lit(i)) for i, p in enumerate(patterns)]))).collect()
    matched = 0
    for x in hits:
        fits = [i for i, p in enumerate(patterns) if re.search(p, x["text"], re.I | re.M)]
        matched += x["rule"] in fits
        assert set(fits) <= set(x["may"]) and set(fits) <= set(x["short"]), x
    assert matched > 0.8 * len(rows)


def test_classes_are_those_of_all_patterns(spark):
    """With and without the look for literals, over windows, odd texts and long lines."""
    r, rows = random.Random(8), [(0, None), (1, ""), (2, " \n "), (3, "Dear " + "x" * 890 + " credit report"), (4, "y" * 5000 + " Affidavit of Service " + "z" * 5000)]
    for i in range(150):
        parts = [r.choice(["\n", " ", "filler words here " * r.randint(0, 60)]) + sample(r.choice(DOC_TYPES)[1], r) for _ in range(r.randint(1, 3))]
        rows.append((10 + i, " ".join(parts)))
    df = spark.createDataFrame(rows, "k int, text string")
    got = {x["k"]: (x["t"]["rank"], x["t"]["where"], x["e"]) for x in classify.evidence_line(classify.with_text_type(df, "text", "t").withColumn("rank", F.col("t.rank")), "text", "rank", "e").collect()}
    flags = re.I | re.M | re.A
    for k, text in rows:
        rank = where = None
        for window, rules, name in (((text or "")[:300], [x for x in enumerate(DOC_TYPES) if not x[1][6]], "titulo"), ((text or "")[:900], list(enumerate(DOC_TYPES)), "titulo"), (text or "", list(enumerate(DOC_TYPES)), "mencion")):
            rank = next((i for i, x in rules if re.search(x[1], window, flags)), None) if (text or "").strip() else None
            if rank is not None:
                where = name
                break
        assert got[k][:2] == (rank, where or ""), (k, text, got[k])
        if rank is not None:
            line = re.search(r"[^\n]*?(?:" + DOC_TYPES[rank][1] + r")[^\n]*", text, flags)[0]
            assert got[k][2] == re.sub(r"\s+", " ", line).strip()[:150], (k, line)
