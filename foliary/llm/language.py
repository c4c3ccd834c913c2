"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its byte 2-, 3- and 4-grams (hashed into a table), as read
with ASCII letters lower-cased; a linear layer and a softmax give the languages. Embeddings and layer
are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows. With few languages,
prediction folds mean and layer, both linear, into one small table: a score per n-gram and language. A
temperature fitted on rows the training did not see calibrates the softmax. A document is rejected if its
calibrated confidence lies below what all but `reject` of those rows reach, taken alone and as texts in two
languages, word by word in turn: mixed texts are texts too, while junk and languages never seen lie below them.

Cases: a null text, or one without a letter, is `und` with score 0 and rejected; rows with a null
language are predicted but not learned from; with nothing to learn from, every row is `und`; with one or two
languages only, junk is as likely as a mixed text and stays; ties go to the language first by code point; every row
is predicted, repeated ones and very long texts too, from all their bytes; a null id counts as an empty one; the
prediction is one column with a name that the table doesn't have, so no column of the input is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ORDERS = (2, 3, 4)
FACTORS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917), np.uint32(668265263))
#: Bytes of text that one pass over the arrays takes.
SLICE = 1 << 19
LOWER = np.arange(256, dtype=np.uint32)
LOWER[65:91] += 32
LOWER[9:14] = 32


def grams(data: bytes, bits: int) -> list[np.ndarray]:
    """Hashed n-grams of each order, one for each byte that has enough bytes behind it."""
    x = LOWER[np.frombuffer(data, dtype=np.uint8)]
    out, h = [], x * FACTORS[0]
    for k in range(1, max(ORDERS)):
        h = h[:-1] ^ (x[k:] * FACTORS[k]) if len(h) else h
        h = (h << np.uint32(13)) | (h >> np.uint32(19))
        if k + 1 in ORDERS:
            out.append((h * FACTORS[0]) >> np.uint32(32 - bits))
    return out


def counted(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and their shares."""
    data = b" " + text.encode("utf-8", "replace") + b" "
    total = np.zeros(1 << bits, dtype=np.int64)
    for lo in range(0, len(data), SLICE):
        for g in grams(data[max(0, lo - max(ORDERS) + 1) : lo + SLICE] if lo else data[:SLICE], bits):
            total += np.bincount(g, minlength=1 << bits)
    at = np.flatnonzero(total).astype(np.int32)
    return at, (total[at] / max(1, total.sum())).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, classes: int, bits: int = 15, dim: int = 16, epochs: int = 6, rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings of n-grams and linear layer after stochastic gradient descent."""
    random = np.random.default_rng(seed)
    size = 1 << bits
    table = (random.random((size, dim), dtype=np.float32) - 0.5) / dim
    layer = np.zeros((dim, classes), dtype=np.float32)
    rows = [counted(t, bits) for t in texts]
    weight = len(labels) / np.maximum(1, np.bincount(labels, minlength=classes)) / classes
    steps, total = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in random.permutation(len(rows)).tolist():
            at, share = rows[i]
            if not len(at):
                continue
            step = rate * (1 - steps / total)
            steps += 1
            mean = share @ table[at]
            z = mean @ layer
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            p *= np.float32(min(3.0, weight[labels[i]]) * step)
            down = layer @ p
            layer -= np.outer(mean, p)
            table[at] -= np.outer(share * len(at) ** 0.5, down)
    return table, layer


def log_shares(scores: np.ndarray, temperature: float) -> np.ndarray:
    z = scores / temperature
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def calibrate(scores: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss. Labels count as wrong once in n + 2 rows (Laplace), so separable rows don't make it certain."""
    n, classes = scores.shape
    if n == 0 or classes < 2:
        return 1.0
    wrong = 1.0 / (n + 2)
    aim = np.full((n, classes), wrong / (classes - 1))
    aim[np.arange(n), labels] = 1 - wrong
    return float(min(np.geomspace(0.02, 5, 60), key=lambda t: -(aim * log_shares(scores, t)).sum()))


def in_turn(texts: list[str], labels: np.ndarray, seed: int = 11) -> list[str]:
    """Each text with another of a different language, word by word in turn."""
    other, out = np.random.default_rng(seed).permutation(len(texts)), []
    for i, j in enumerate(other.tolist()):
        if labels[i] != labels[j]:
            out.append(" ".join(w for two in zip(texts[i].split(), texts[j].split()) for w in two))
    return out


class Model:
    """Languages, embeddings, layer, the temperature and the bound below which a text is rejected."""

    def __init__(self, languages: list[str], table: np.ndarray, bits: int, layer: np.ndarray | None = None, temperature: float = 1.0, bound: float = 0.0):
        if layer is not None and layer.shape[1] <= layer.shape[0]:  # scores are not more than embeddings
            table, layer = table @ layer, None
        self.languages, self.table, self.layer, self.bits = languages, table.astype(np.float32), layer, bits
        self.temperature, self.bound = temperature, bound

    def scores(self, texts: list[str]) -> np.ndarray:
        """Mean score of every whole text, many short texts at a time."""
        out = np.zeros((len(texts), self.table.shape[1]))
        n = np.zeros(len(texts))
        group, at, size = [], [], 0

        def flush() -> None:
            nonlocal group, at, size
            if not group:
                return
            data = b"".join(group)
            starts = np.cumsum([0, *map(len, group)])
            for order, g in zip(ORDERS, grams(data, self.bits)):
                value = self.table[g]
                # the n-grams that lie in one part, none across two
                sums = np.zeros((len(g) + 1, value.shape[1]))
                np.cumsum(value, axis=0, out=sums[1:])
                lo = np.minimum(starts[:-1], len(g))
                hi = np.maximum(np.minimum(starts[1:] - order + 1, len(g)), lo)
                np.add.at(out, at, sums[hi] - sums[lo])
                np.add.at(n, at, hi - lo)
            group, at, size = [], [], 0

        for i, t in enumerate(texts):
            data = b" " + t.encode("utf-8", "replace") + b" "
            for lo in range(0, len(data), SLICE):
                part = data[max(0, lo - max(ORDERS) + 1) : lo + SLICE] if lo else data[:SLICE]
                group.append(part)
                at.append(i)
                size += len(part)
                if size >= SLICE:
                    flush()
        flush()
        out /= np.maximum(n, 1)[:, None]
        return out if self.layer is None else out @ self.layer

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        import regex

        letter = regex.compile(r"\p{L}").search
        some = np.array([isinstance(t, str) and letter(t) is not None for t in texts], dtype=bool)
        label = np.full(len(texts), "und", dtype=object)
        top = np.zeros(len(texts))
        if some.any() and self.languages:
            p = np.exp(log_shares(self.scores([t for t, s in zip(texts, some) if s]), self.temperature))
            label[some] = np.array(self.languages, dtype=object)[p.argmax(axis=1)]
            top[some] = p.max(axis=1)
        return pd.DataFrame({"lang_pred": label, "score": top, "rejected": (label == "und") | (top < self.bound)})


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(
    docs: DataFrame, most_rows: int = 500, most_bytes: int = 32 << 20, bits: int = 15, reject: float = 0.001,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
) -> Model:
    """Fit on at most `most_rows` rows of each label and about 2 * `most_bytes` of text in all, drawn by a hash of the id; a
    fifth of them only calibrates. This bounded sample is all that the driver sees of the rows, and a text longer than
    its label's share of the bytes isn't in it."""
    size = F.octet_length(text_col)
    rows = docs.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    counts = common.written(rows.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")), "labels")
    labels = counts.count()
    if not labels:
        return Model([], np.zeros((1 << bits, 1)), bits)
    share = most_bytes // labels
    # twice the rows wanted are drawn by rate, then cut to the bound, so no label's rows meet in one task
    rate = F.least(F.lit(1.0), 2 * most_rows / F.col("n"), 2 * share / F.greatest("bytes", F.lit(1)))
    rates = counts.select("label", (rate * (1 << 40)).cast("long").alias("rate"))
    rates = F.broadcast(rates) if labels <= 10_000 else rates
    drawn = rows.select(F.col(label_col).alias("label"), F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(1 << 40)).alias("draw"), F.col(text_col).alias("text"))
    drawn = drawn.filter(F.octet_length("text") <= share).join(rates, "label").filter("draw < rate").drop("rate")
    sample = drawn.orderBy("draw", "text").limit(2 * most_rows * labels).toPandas()
    sample = sample.groupby("label", sort=True).head(most_rows).reset_index(drop=True)
    languages = sorted(sample["label"].unique())
    label = sample["label"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=np.int64)
    apart = np.asarray((sample.index % 5 == 0) & (len(sample) > 20))
    table, layer = train(list(sample["text"][~apart]), label[~apart], len(languages), bits)
    model = Model(languages, table, bits, layer)
    texts = list(sample["text"][apart])
    if texts:
        scores = model.scores(texts)
        model.temperature = calibrate(scores, label[apart])
        scores = np.r_[scores, model.scores(in_turn(texts, label[apart]))]
        model.bound = float(np.quantile(np.exp(log_shares(scores, model.temperature)).max(axis=1), reject))
    return model


def identified(docs: DataFrame, model: Model, name: str = "found", text_col: str = "text") -> DataFrame:
    """The documents with a column of lang_pred, score and rejected, named `name` or, if they have such a column, with underscores before."""
    # the model is a small broadcast: 2**bits embeddings, and a row of the layer per language
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield sent.value.predict(texts)

    return docs.withColumn(common.free_name(docs, name), predict(F.col(text_col)))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    found = identified(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.*")
