"""What a pattern can't match without: literals that a cheap look for text can find before a regular expression runs."""

from __future__ import annotations

from collections.abc import Iterator
from re import IGNORECASE, _constants as kinds, _parser as parser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _strength(found: list[str] | None) -> tuple[int, int]:
    """How well a set of literals tells: by its shortest one, then by how few there are."""
    return (0, 0) if found is None else (min(map(len, found)), -len(found))


def _required(items) -> list[str] | None:
    best, run = None, ""
    for op, value in [*items, (None, None)]:
        if op is kinds.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        if run and _strength([run]) > _strength(best):
            best = [run]
        if op is kinds.AT:  # a border takes no room, so a run goes on behind it
            continue
        run, inside = "", None
        if op is kinds.SUBPATTERN:
            inside = _required(value[3])
        elif op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[0] > 0:
            inside = _required(value[2])
        elif op is kinds.BRANCH:
            each = [_required(x) for x in value[1]]
            inside = None if None in each else sorted(set(sum(each, [])))
        if _strength(inside) > _strength(best):
            best = inside
    return best


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case literals of which every match of a pattern, in any case, holds one. None: there are no such literals."""
    found = _required(parser.parse(pattern, IGNORECASE))
    # of two literals, one inside the other, the shorter is found wherever the longer is
    return None if found is None else [x for x in found if not any(y in x for y in found if y != x)]


def may_match(lowered: Column, pattern: str) -> Column:
    """Whether a lower-cased text holds a literal that the pattern needs; true for all that a pattern without such literals could match."""
    found = required_literals(pattern)
    if found is None:
        return F.lit(True)
    out = F.contains(lowered, F.lit(found[0]))
    for x in found[1:]:
        out = out | F.contains(lowered, F.lit(x))
    return out


def candidates(text: Column, patterns: list[str], least: int = 3) -> Column:
    """Numbers of the patterns that a text may match, in order, by one pass over it: an automaton of all literals of `least` letters or more.
    Patterns with shorter ones, or none, are candidates of every text."""
    sets = [required_literals(p) for p in patterns]
    always = [i for i, found in enumerate(sets) if found is None or min(map(len, found)) < least]
    of: dict[str, list[int]] = {}
    for i, found in enumerate(sets):
        for x in found or [] if i not in always else []:
            of.setdefault(x, []).append(i)

    @F.pandas_udf("array<int>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for x, numbers in of.items():
            automaton.add_word(x, tuple(numbers))
        automaton.make_automaton()
        for texts in batches:
            hits = [{n for _, n in automaton.iter(t.lower())} if of and t else () for t in texts]
            yield pd.Series([sorted({*always, *(i for n in h for i in n)}) for h in hits])

    return find(text)
