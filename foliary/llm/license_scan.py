"""Licence scans: notice phrases and identifier tags of texts, and the licence expressions behind the tags.

Each text is reduced to its words with single spaces between (A-Z lower-cased). One Aho-Corasick automaton over
all phrases, each with a space before and behind, finds every place where a phrase's words stand consecutively, in one
pass and whatever stands between the words. Behind an identifier tag, the text itself is read to the end of the line: a
shunting-yard parser takes the longest well-formed prefix of licence identifiers joined by "and", "or" and "with" and
evaluates it to a level of obligations: "or" leaves the choice, so the lower level holds; "and" asks for both, so the
higher; "with" lowers a strong copyleft to a weak one.

Cases: a null or empty text has no words and no places, labels "" and score 0; rows that repeat an id are scanned each by
itself; places may overlap and all count; a tag without a well-formed expression gives none; very long texts are scanned
whole, and what is held of a place is two numbers; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# The phrases of the contract with their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notice phrases of well-known licences, as words, with the label each stands for.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license": "apache-2",
    "apache license version 2 0": "apache-2",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc0 1 0 universal": "cc0",
    "dedicated to the public domain": "public-domain",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}

#: Words that come before a licence expression.
TAGS = ("spdx license identifier", "spdx license expression", "license expression")

# Levels of obligations and the licence identifiers of each, by the public list of identifiers, lower-cased.
LEVELS = ("public domain", "permissive", "weak copyleft", "strong copyleft", "network copyleft", "restricted use", "unknown")
IDENTIFIERS = {
    "public domain": ["0bsd", "cc0-1.0", "unlicense", "wtfpl"],
    "permissive": ["afl-3.0", "apache-1.1", "apache-2.0", "artistic-2.0", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "bsl-1.0", "cc-by-3.0", "cc-by-4.0", "isc", "mit", "mit-0", "ncsa", "postgresql", "psf-2.0", "python-2.0", "x11", "zlib"],
    "weak copyleft": ["cddl-1.0", "cpl-1.0", "epl-1.0", "epl-2.0", "eupl-1.2", "lgpl-2.0", "lgpl-2.1", "lgpl-3.0", "mpl-1.1", "mpl-2.0"],
    "strong copyleft": ["cc-by-sa-3.0", "cc-by-sa-4.0", "gpl-1.0", "gpl-2.0", "gpl-3.0", "ofl-1.1"],
    "network copyleft": ["agpl-3.0", "osl-3.0", "sspl-1.0"],
    "restricted use": ["busl-1.1", "cc-by-nc-4.0", "cc-by-nc-nd-4.0", "cc-by-nc-sa-4.0", "cc-by-nd-4.0"],
}
LEVEL_OF = {name: LEVELS.index(level) for level, names in IDENTIFIERS.items() for name in names}
#: Labels that identifiers share with phrases; others are labels themselves.
SHARED = {"apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "cc-by-4.0": "cc-by", "cc-by-sa-4.0": "cc-by-sa", "cc0-1.0": "cc0"}
EXCEPTION = re.compile(rb"[a-z0-9.-]*exception(?:-[0-9.]+)?|llvm-exception")
TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9](?:[a-z0-9.+:-]*[a-z0-9+])?)")
SKIPPED = re.compile(rb"[ \t:=\"'>`*-]*")
PRECEDENCE = {b"or": 1, b"and": 2, b"with": 3}

#: How sure a find is that the text states a licence.
SURE_TAG, SURE_PHRASE = 0.95, 0.8

SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
TO_WORDS = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))
SCHEMA = (
    "doc_id long, n_words long, places array<struct<word: long, words: int, kind: string, label: string>>, "
    "expressions array<struct<word: long, text: string, labels: array<string>, level: string>>, score double"
)


def licence(token: bytes) -> tuple[str, int] | None:
    """Label and level of an identifier; None if it isn't one."""
    name = token.decode("ascii", "replace")
    if re.fullmatch(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+", name):
        return name, LEVELS.index("unknown")
    plain = name.removesuffix("+").removesuffix("-or-later").removesuffix("-only")
    level = LEVEL_OF.get(plain)
    if level is None:
        return None
    later = "-or-later" if name.endswith(("+", "-or-later")) else "-only" if name.endswith("-only") else ""
    return SHARED.get(plain + later, plain + later), level


def tokens_of(data: bytes, at: int) -> Iterator[bytes]:
    while found := TOKEN.match(data, at):
        yield found[1]
        at = found.end()


def well_formed(tokens: Iterator[bytes]) -> list[bytes]:
    """The longest prefix that is a whole expression."""
    taken: list[bytes] = []
    whole = depth = 0
    operand = True  # one is due
    for t in tokens:
        if operand:
            after_with = bool(taken) and taken[-1] == b"with"
            if t == b"(" and not after_with:
                depth += 1
            elif EXCEPTION.fullmatch(t) if after_with else licence(t):
                operand = False
            else:
                break
        elif t == b")" and depth:
            depth -= 1
        elif t in PRECEDENCE and (t != b"with" or taken[-1] != b")" and (len(taken) < 2 or taken[-2] != b"with")):
            operand = True
        else:
            break
        taken.append(t)
        if not operand and not depth:
            whole = len(taken)
    return taken[:whole]


def evaluated(tokens: list[bytes]) -> int:
    """Level of a well-formed expression, by two stacks."""
    values: list[int] = []
    pending: list[bytes] = []

    def apply() -> None:
        last, operator = values.pop(), pending.pop()
        first = values.pop()
        if operator == b"with":
            strong = first in (LEVELS.index("strong copyleft"), LEVELS.index("network copyleft"))
            values.append(LEVELS.index("weak copyleft") if strong else first)
        else:
            values.append(max(first, last) if operator == b"and" else min(first, last))

    for t in tokens:
        if t == b"(":
            pending.append(t)
        elif t == b")":
            while pending[-1] != b"(":
                apply()
            pending.pop()
        elif t in PRECEDENCE:
            while pending and PRECEDENCE.get(pending[-1], 0) >= PRECEDENCE[t]:
                apply()
            pending.append(t)
        else:
            found = licence(t)
            values.append(found[1] if found else 0)  # an exception has no level of its own
    while pending:
        apply()
    return values[0]


def expression(data: bytes, at: int) -> tuple[str, list[str], str] | None:
    """Text, labels and level of the expression at a place of a lower-cased text."""
    tokens = well_formed(tokens_of(data, SKIPPED.match(data, at).end()))
    if not tokens:
        return None
    text = b" ".join(t.upper() if t in PRECEDENCE else t for t in tokens).decode().replace("( ", "(").replace(" )", ")")
    labels = sorted({found[0] for t in tokens if (found := licence(t))})
    return text, labels, LEVELS[evaluated(tokens)]


class Scanner:
    def __init__(self, base: dict[str, str], notices: dict[str, str], tags: tuple[str, ...]):
        import ahocorasick

        kinds = {**{p: ("tag", "") for p in tags}, **{p: ("notice", x) for p, x in notices.items()}, **{p: ("base", x) for p, x in base.items()}}
        self.phrases = [(len(p.split()), kind, label) for p, (kind, label) in kinds.items()]
        self.find = ahocorasick.Automaton()
        for i, p in enumerate(kinds):
            self.find.add_word(f" {p} ", i)
        self.find.make_automaton()

    def scan(self, text: str | None) -> tuple[int, array, array, list[tuple]]:
        """Number of words; word and phrase of each place; expressions as (word, text, labels, level)."""
        lower = (text or "").encode("utf-8", "replace").lower()
        spaced = lower.translate(TO_WORDS)
        words = spaced.split()
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        at, which, found = array("q"), array("i"), []
        word = upto = 0
        tagged = array("q")
        for end, i in self.find.iter(line):
            word, upto = word + line.count(" ", upto, end), end  # words that end before this place does
            start = word - self.phrases[i][0]
            if self.phrases[i][1] == "tag":
                tagged.append(word)
            else:
                at.append(start)
                which.append(i)
        if tagged:
            space = np.frombuffer(b" " + spaced + b" ", dtype=np.uint8) == 32
            ends = np.flatnonzero(~space[:-1] & space[1:])  # in the text, just behind each word
            for w in dict.fromkeys(tagged):
                if e := expression(lower, int(ends[w - 1])):
                    found.append((w, *e))
        return len(words), at, which, found

    def batch(self, ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        scans = [self.scan(t) for t in texts]
        at = np.concatenate([np.frombuffer(s[1], dtype=np.int64) for s in scans]) if scans else np.zeros(0, dtype=np.int64)
        which = np.concatenate([np.frombuffer(s[2], dtype=np.int32) for s in scans]) if scans else np.zeros(0, dtype=np.int32)
        take = lambda k, kind: pa.array([p[k] for p in self.phrases], type=kind).take(pa.array(which))
        structs = pa.StructArray.from_arrays([pa.array(at), take(0, pa.int32()), take(1, pa.string()), take(2, pa.string())], names=["word", "words", "kind", "label"])
        places = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(s[1]) for s in scans)]), type=pa.int32()), structs)
        kind = pa.list_(pa.struct([("word", pa.int64()), ("text", pa.string()), ("labels", pa.list_(pa.string())), ("level", pa.string())]))
        expressions = pa.array([[dict(zip(("word", "text", "labels", "level"), e)) for e in s[3]] for s in scans], type=kind)
        scores = []
        for _, _, which, found in scans:
            phrases, tags = {self.phrases[i][2] for i in set(which)}, {x for e in found for x in e[2]}
            scores.append(1 - (1 - SURE_TAG) ** len(tags) * (1 - SURE_PHRASE) ** len(phrases - tags))
        columns = [ids, pa.array([s[0] for s in scans], type=pa.int64()), places, expressions, pa.array(scores, type=pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "places", "expressions", "score"])


def license_scan(
    docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, tags: tuple[str, ...] = TAGS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: n_words; places (word, words, kind base or notice, label) in the order in which they end; expressions behind
    tags (first word, text, labels, level); score, the chance that the text states a licence if finds of different labels are independent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, tags)
        for b in batches:
            for at in range(0, b.num_rows, 1000):  # bounded output
                part = b.slice(at, 1000)
                yield scanner.batch(part.column("doc_id"), part.column("text").to_pylist())

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(common.documents(spark, sf_dir))
    base = F.filter("places", lambda p: p["kind"] == "base")
    words = F.transform(base, lambda p: p["word"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    own = F.concat(F.transform("places", lambda p: p["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"])))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        joined(F.transform(base, lambda p: p["label"])).alias("base_labels"), joined(own).alias("labels"), "score", "expressions",
    )
