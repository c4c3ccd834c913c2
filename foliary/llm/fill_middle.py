"""Fill-in-the-middle: each text is cut at two unit borders into prefix, middle and suffix, which are put in another order.

A unit is a run of text up to and with a mark (a line end); what follows the last mark is one more. A text is laid
out in blocks of a fixed number of code points. A Fenwick tree over the blocks holds how many units end in each and
how many code points each has; the block of a cut is found by a binary-lifting descent, the border itself by a walk
over the marks of that block alone. Draws come from a hash of seed and id, so a document's form and cuts are the same
in every run and whatever rows stand beside it.

Cases: a null text is empty; an empty text, or one that holds a sentinel, stays plain; a null id draws as the empty
string; rows that repeat an id share their draws but are cut each by its own text; a text of one unit may be cut only
at its ends; very long texts are cut as any other, whole; an empty table gives no rows. The user's columns all stay;
the struct of results takes a free name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Code points of a block.
BLOCK = 4096
SENTINELS = ("<P>", "<S>", "<M>")
RESULT = "n long, form string, output string, prefix_chars long, middle_chars long"


class Blocks:
    """Fenwick tree over a text's blocks: entry i sums the last i & -i blocks up to the i-th, in units ended and in code points."""

    def __init__(self, text: str, mark: str = "\n", block: int = BLOCK):
        self.text, self.mark = text, mark
        starts = range(0, len(text), block)
        self.units = [0, *(text.count(mark, at, at + block) for at in starts)]
        self.chars = [0, *(min(block, len(text) - at) for at in starts)]
        if text and not text.endswith(mark):
            self.units[-1] += 1  # the last unit ends with the text
        self.n = sum(self.units)
        for i in range(1, len(self.units)):
            above = i + (i & -i)
            if above < len(self.units):
                self.units[above] += self.units[i]
                self.chars[above] += self.chars[i]

    def descend(self, k: int) -> tuple[int, int]:
        """Units and code points before the block in which the k-th unit ends."""
        at = units = chars = 0
        step = 1 << len(self.units).bit_length()
        while step:
            if at + step < len(self.units) and units + self.units[at + step] < k:
                at += step
                units += self.units[at]
                chars += self.chars[at]
            step >>= 1
        return units, chars

    def cut(self, k: int) -> int:
        """Code points of the first k units."""
        if k == 0:
            return 0
        units, chars = self.descend(k)
        end = chars - 1
        for _ in range(k - units):
            end = self.text.find(self.mark, end + 1)
            if end < 0:
                return len(self.text)
        return end + 1


def transformed(text: str, draws: tuple[int, int, int, int], percent: int, spm: int, sentinels: tuple[str, str, str], mark: str, block: int) -> tuple:
    """n, form, output, prefix_chars and middle_chars of a text."""
    blocks = Blocks(text, mark, block)
    if not text or draws[2] % 100 >= percent or any(s in text for s in sentinels):
        return blocks.n, "plain", text, None, None
    first, last = sorted(blocks.cut(k % (blocks.n + 1)) for k in draws[:2])
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    p, s, m = sentinels
    if draws[3] % 100 < spm:
        return blocks.n, "spm", "".join((s, suffix, p, prefix, m, middle)), first, last - first
    return blocks.n, "psm", "".join((p, prefix, s, suffix, m, middle)), first, last - first


def fill_in_middle(
    docs: DataFrame, seed: int = 7, percent: int = 100, spm: int = 50, sentinels: tuple[str, str, str] = SENTINELS, mark: str = "\n",
    block: int = BLOCK, name: str = "fim", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents with a struct of n (units), form (plain, psm or spm), output, prefix_chars and middle_chars. `percent` of the
    documents are transformed, `spm` percent of them suffix first."""
    if len(mark) != 1 or len(set(sentinels)) != 3 or any(s.find(s[0], 1) >= 0 or t in s for s in sentinels for t in sentinels if t != s):
        raise ValueError("a mark is one character; sentinels differ, none holds another, and each has its first character once")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, *hashes in batches:
            rows = [transformed(t or "", h, percent, spm, sentinels, mark, block) for t, *h in zip(texts, *hashes)]
            out = pd.DataFrame(rows, columns=["n", "form", "output", "prefix_chars", "middle_chars"])
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return docs.withColumn(common.free_name(docs, name), run(F.col(text_col), *draws))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that was transformed, from output and form alone."""
    p, s, m = (F.lit(x) for x in sentinels)
    part = lambda text, mark, i: F.split_part(text, mark, F.lit(i))
    head, middle = part(output, m, 1), part(output, m, 2)
    psm = F.concat(part(part(head, s, 1), p, 2), middle, part(head, s, 2))
    spm = F.concat(part(head, p, 2), middle, part(part(head, p, 1), s, 2))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(common.documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "fim.*")
    again = restored(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256")
    )


OP12_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
draws AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM texts),
cuts AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM draws),
parts AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(units[b + 1:n], ''), '') AS s
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
