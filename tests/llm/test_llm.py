"""The corpus operators against brute force, on small tables with every odd case."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer
from pyspark.sql import functions as F

import corpus_pipeline
from foliary.llm import (
    common, components, exact_dedup, fingerprints, language, mixing, ngram_join, packing, passages, sharding, shingles, token_counts, token_files, tokens,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioubcdfgst") for _ in range(r.randint(2, 9))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, a very long text, equal texts, near copies, repeated rows."""
    base = prose(1, 200)
    near = base.replace(base.split()[100], "changed", 1)
    texts = [None, "", " \n\t ", "one two", "one two", "ONE TWO", base, base, near, base + " tail end", prose(2, 60000), "日本語 テスト é ß", "a b c", "Nd, " * 300]
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, "no id", "en", "s1", 5)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(spark):
    """Columns with the names that the operators use inside."""
    extra = ["size", "n", "taken", "target", "shard", "slot", "piece", "start", "bin", "part", "file", "place", "digest", "score", "kept", "lang_pred", "_bucket", "_h", "_place", "component_id", "token", "i", "id", "label"]
    df = spark.createDataFrame([(1, "some text here", "en", "a", 1), (2, "some text here", "de", "b", 1), (3, "other words", "de", "b", 1)], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in extra})


# ------------------------------------------------------------------ tokens
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_librarys(name):
    e = tokens.ChunkEncoder(tokens.public_path(name), most_cached=50)
    plain = Tokenizer.from_file(tokens.public_path(name))
    ids = lambda t: np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
    strange = ["it's IT'LL 's", "a\n\n b\r\n\tc  ", "x y z", "Σας ΣΑΣ İ", "é é", "<|endoftext|> <|startoftext|>", "1234 5.6,7!!..", "\x1c\x00", "ﬁ ª", "😀", " lead", "trail ", "ofanountan, ofanountan. (ofanountan)"]
    strange += ["a <|endoftext|> b", "x<|ENDOFTEXT|>", "<|startoftext|>a\nb", "two\nlines, here.\n\nand  more \n so", "\nlead", "end\n", "ein\nübel größe.\nÉté ñ", "a", "\n", " ", "x" * 300 + " y"]
    texts = [x[1] for x in odd_rows() if x[1]] + strange
    for t in texts:
        assert e.ids(t) == ids(t), t
    assert e.many([None, "", *texts]) == [b"", b"", *map(ids, texts)]
    assert [x for _, b in e.batches(texts) for x in b] == list(map(ids, texts))


# ------------------------------------------------------------------ 1
def test_marks_behind_words_are_the_librarys():
    """Plain words and words with marks behind, of all kinds, whatever is cached."""
    path = tokens.public_path("byte_bpe_50k.json")
    real, e = Tokenizer.from_file(path), tokens.ChunkEncoder(path, most_cached=50)
    words = ["the", "erst", "Été", "日本語", "ß", "x1", "don't", "it's", "we'", "", "a" * 70, "É" * 40, "²", "ª", "e\u0301", "\ud800"]
    marks = ["", ".", ",", "...", ".%%%", "'", "!'s", "'.", "-", "--", "\\", "\"]", "“", "§", "_x", "<|", "(", "$1"]
    texts = [f"{m}{w}{n} {w}{n}" for w in words for m in ("", "(", ".") for n in marks] + [" ".join(w + n for w in words for n in marks)]
    for text, got in zip(texts, e.many(texts)):
        assert np.frombuffer(got, dtype="<u4").tolist() == real.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids, text


def test_workers_cache_a_bounded_number_of_words_once(monkeypatch):
    """Executors have several workers, and each has a cache: a plain word is in it once, and fewer words fit."""
    sizes, turn = [], tokens.Cache.turn
    monkeypatch.setattr(tokens.Cache, "turn", lambda self: turn(self) or sizes.append(len(self) + len(self.older)))
    monkeypatch.setattr(tokens, "BATCH", 1)
    tokens.encoder.cache_clear()
    e = tokens.encoder(tokens.public_path("byte_bpe_50k.json"))
    for at in range(0, 700_000, 100_000):
        e.many([" ".join(f"{a}{b}{c}" for k in range(at, at + 100_000) for a, b, c in [(chr(97 + k % 26), chr(97 + k // 26 % 26), "".join(chr(97 + int(x)) for x in str(k)))])])
    tokens.encoder.cache_clear()
    assert max(sizes[::2]) <= 400_000 and max(sizes[1::2]) <= 1_000, sizes


def test_token_counts(spark, odd, none, tmp_path):
    book = token_counts.Rollup(spark, f"file://{tmp_path}/book")
    counts = token_counts.counted(odd, {"words": common.words_of}, carry=("doc_id",))
    assert book.commit(1, token_counts.signed(counts))
    assert not book.commit(1, token_counts.signed(counts))  # a replay
    gone = counts.filter("doc_id = 7")
    assert book.commit(2, token_counts.signed(gone, -1))
    assert book.commit(3, token_counts.signed(counts.filter("false")))
    want = {}
    for doc, text, lang, source, _ in odd_rows():
        if doc != 7:
            k = (source, lang, "words")
            d, t = want.get(k, (0, 0))
            want[k] = (d + 1, t + len(re.findall(common.WORD, text or "")))
    read = lambda: {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in book.totals().collect()}
    assert read() == want
    book.compact()
    assert read() == want and not book.commit(2, token_counts.signed(gone, -1))
    # a write that broke off has no marker and doesn't count
    broken = tmp_path / "book" / "deltas" / "batch=9"
    broken.mkdir()
    assert read() == want and token_counts.Rollup(spark, f"file://{tmp_path}/none").totals().count() == 0
    old = counts.filter("doc_id = 10")
    book.commit(10, token_counts.revised(old, old.withColumn("tokens", F.lit(7).cast("long"))))
    assert sum(t for _, t in read().values()) == sum(t for _, t in want.values()) - 60000 + 7


def test_late_batches_count_once(spark, odd, tmp_path):
    """Commits 1 and 3, a fold, then 2: late, but in; replays of folded batches change nothing; a fold that broke off doesn't count."""
    book = token_counts.Rollup(spark, f"file://{tmp_path}/late")
    counts = token_counts.counted(odd, {"words": common.words_of}, carry=("doc_id",))
    part = lambda k: token_counts.signed(counts.filter(F.coalesce(F.col("doc_id"), F.lit(0)) % 3 == k))
    assert book.commit(1, part(1)) and book.commit(3, part(0))
    book.compact()
    assert not book.commit(3, part(0)) and book.commit(2, part(2)) and not book.commit(2, part(2))
    whole = {tuple(r[:3]): tuple(r[3:]) for r in token_counts.signed(counts).groupBy(*token_counts.KEYS).agg(F.sum("docs"), F.sum("tokens")).collect()}
    read = lambda: {tuple(r[:3]): tuple(r[3:]) for r in book.totals().collect()}
    assert read() == whole
    (tmp_path / "late" / "base" / "fold=1" / "batches").mkdir(parents=True)
    assert read() == whole
    book.compact()
    assert read() == whole and book.folded() == {1, 2, 3} and not book.commit(2, part(2))
    with pytest.raises(ValueError):
        book.totals(upto=2)


def test_op1(spark, odd, clashing, tmp_path):
    e = tokens.ChunkEncoder(tokens.public_path("byte_bpe_50k.json"))
    for name, df in (("given", spark.read.parquet(f"{SF}/documents.parquet")), ("odd", odd), ("clashing", clashing)):
        df.write.parquet(f"file://{tmp_path}/{name}/documents.parquet")
        want, best = {}, {}

        def add(batch, source, lang, version, docs, n):
            d, t = want.get((batch, source, lang, version), (0, 0))
            want[(batch, source, lang, version)] = (d + docs, t + n)

        sizes = lambda t: {"words-1": len(re.findall(common.WORD, t or "")), "byte-bpe-1": len(e.ids(t)) // 4, "chars-1": len(t or "")}
        # nulls are the smallest of a struct's values
        rank = lambda x: [(v is not None, v) for v in (x["doc_id"], x["source"], x["lang"])]
        for r in df.select("doc_id", "text", "source", "lang").collect():
            for version in ("words-1", "byte-bpe-1"):
                add(1, r["source"], r["lang"], version, 1, sizes(r["text"])[version])
            key = r["text"] or ""
            best[key] = r if key not in best or rank(r) > rank(best[key]) else best[key]
        for r in best.values():
            for batch, versions in ((2, ("words-1", "byte-bpe-1")), (3, ("chars-1", "byte-bpe-1"))):
                for version in versions:
                    add(batch, r["source"], r["lang"], version, 1, sizes(r["text"])[version])
        got = token_counts.op1_token_counts(spark, f"file://{tmp_path}/{name}").collect()
        assert {(r["batch"], r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in got} == want


# ------------------------------------------------------------------ 2
@pytest.mark.parametrize("capacity", [8, 4096])
def test_packing(spark, odd, capacity):
    path = tokens.public_path("word_bpe_49k.json")
    got = packing.pack(odd.repartition(5), path, capacity, 1).collect()
    e = tokens.ChunkEncoder(path)
    want = []
    for doc, text, *_ in odd_rows():
        ids = e.ids(text) + np.array([1], "<u4").tobytes()
        want += [(doc or -1, k // (4 * capacity), k // 4, len(ids[k : k + 4 * capacity]) // 4, zlib.crc32(ids[k : k + 4 * capacity])) for k in range(0, len(ids), 4 * capacity)]
    assert sorted((r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in got)
    assert len(bins) <= total / capacity * 1.3 + 2


@pytest.mark.parametrize("most_items", [8, 100_000])
def test_no_two_open_bins_fit(spark, most_items):
    """However small the groups: every bin is in one place, none overlaps, and no two could be one."""
    r = random.Random(most_items)
    sizes = [r.choice([3, 30, 51, 55, 60, 70, 85]) for _ in range(900)]
    got = packing.merged(spark.createDataFrame(list(enumerate(sizes)), "bin long, bin_length long"), 100, most_items).collect()
    assert sorted(x["bin"] for x in got) == list(range(900))
    bins = {}
    for x in got:
        bins.setdefault(x["into"], []).append((x["shift"], sizes[x["bin"]], x["bin_length"]))
    for b in bins.values():
        assert all(s == sum(n for _, n, _ in sorted(b)[:i]) for i, (s, _, _) in enumerate(sorted(b)))
        assert {w for _, _, w in b} == {sum(n for _, n, _ in b)} and b[0][2] <= 100
    two = sorted(b[0][2] for b in bins.values())[:2]
    assert sum(two) > 100


def test_what_can_still_merge():
    assert packing.longest_to_merge({60: 5}, 100, 10, False) == 0 and packing.longest_to_merge({30: 1}, 100, 10, False) == 0
    assert packing.longest_to_merge({30: 1, 60: 5, 80: 9}, 100, 10, False) == 70
    assert packing.longest_to_merge({30: 2, 55: 1, 60: 5, 65: 50}, 100, 10, True) == 60


def test_packing_nothing(spark, none):
    assert packing.pack(none, tokens.public_path("word_bpe_49k.json")).count() == 0


def test_packing_keeps_large_ids_beside_a_null(spark):
    """A null id in a batch must not turn the others into doubles."""
    rows = [(2**53 + 1, "one"), (None, "two"), (2**62 + 3, "three")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), tokens.public_path("word_bpe_49k.json")).collect()
    assert {r["doc_id"] for r in got} == {d for d, _ in rows}


def test_packing_encodes_words_that_return_once(monkeypatch):
    """Words of some MB of text are still known when others came between."""
    seen, chunk = [], tokens.ChunkEncoder.chunk
    monkeypatch.setattr(tokens.ChunkEncoder, "chunk", lambda self, raw: seen.append(raw) or chunk(self, raw))
    monkeypatch.setattr(tokens, "BATCH", 1)
    tokens.encoder.cache_clear()
    sets = [" ".join(f"w{k}" for k in range(i * 60_000, (i + 1) * 60_000)) for i in range(2)]
    list(packing.cut([*sets, *sets], [1, 2, 3, 4], tokens.public_path("word_bpe_49k.json"), 4096, 1))
    tokens.encoder.cache_clear()
    assert len(seen) == 120_000


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]


# ------------------------------------------------------------------ 3
def test_language(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    got = language.identified(docs, model).select("*", "found.*").withColumn("held", language.held_out(F.col("doc_id"))).filter("held").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)
    found = {r["text"]: r for r in language.identified(odd, model).select("text", "found.*").collect()}
    assert all(found[t]["lang_pred"] == "und" and found[t]["rejected"] for t in (None, "", " \n\t "))
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert language.identified(none, model).count() == 0
    nothing = language.fit(none)
    assert {r["lang_pred"] for r in language.identified(odd, nothing).select("found.*").collect()} == {"und"}


def test_junk_is_rejected_and_mixed_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    r, rows = random.Random(5), docs.filter("length(text) > 300").select("lang", "text").collect()
    junk = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400)) for _ in range(40)] + ["zxqj vkwq pqzx jjkq " * 20, "x" * 500, "a 0123 4567 8910", "Привет, мир, как дела сегодня", "日本語のテキスト"]
    mixed = []
    for _ in range(100):
        a, b = r.choice(rows), r.choice(rows)
        if a["lang"] != b["lang"]:
            mixed.append(a["text"][:1500] + " " + b["text"][:1500])
    rejected = lambda texts: np.mean(model.predict(pd.Series(texts))["rejected"])
    assert rejected(junk) >= 0.9 and rejected(mixed) <= 0.05 and rejected([x["text"] for x in rows]) <= 0.01


def test_many_languages_need_no_table_for_each(spark):
    """More labels than dimensions: the layer stays apart; none is left out."""
    rows = [(40 * k + i, prose(1000 + k, 12) + " " + prose(1000 + k, 12), f"l{k:02}", "s", 1) for k in range(25) for i in range(12)]
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    assert len(model.languages) == 25 and model.layer is not None and model.scores(["ab", rows[0][1]]).shape == (2, 25)


def test_scores_of_long_texts_are_those_of_one_pass():
    random_ = np.random.default_rng(1)
    model = language.Model(["a", "b"], random_.normal(size=(1 << 10, 2)), 10)
    text = prose(3, 150000)
    at, share = language.counted(text, 10)
    assert np.allclose(model.scores([text, "ab", text])[0], share @ model.table[at], atol=1e-3)


# ------------------------------------------------------------------ 4
@pytest.mark.parametrize("block", [3, 256])
def test_mixing(spark, odd, block):
    got = mixing.mix(odd, block=block)
    rows = got.collect()
    size = lambda t: len(re.findall(common.WORD, t or ""))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"]) for r in rows) == sorted((r[0] if r[0] is not None else -1, size(r[1])) for r in odd_rows())
    by = {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        t = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        t[0] += r["taken"]
        t[1] += r["size"]
    assert all(n == s and abs(taken - target) <= 1 for taken, n, target, s in by.values())
    key = lambda r: (r["doc_id"] or -1, r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, mixing.mix(odd.repartition(7), block=block).collect()))


def shared_out(sizes, most=3.0):
    """Targets by the rule as it stands: share by weight, stop what is above, share the rest anew."""
    weight, out, free, left = [float(i % 3 + 1) for i in range(len(sizes))], [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        whole = sum(weight[i] for i in free)
        over = {i for i in free if left * weight[i] > most * sizes[i] * whole}
        for i in over or free:
            out[i] = most * sizes[i] if over else left * weight[i] / whole
        left -= sum(out[i] for i in over)
        free -= over or free
    return out


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 10, 10], [0, 5], [0, 0], [7], [], [3, 900, 2, 50, 1, 1, 40, 300, 9, 9], list(range(60))])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i:03}" if i < len(sizes) - 1 else None, n) for i, n in enumerate(sizes)], "source string, source_size long")
    plan = mixing.planned(df, 16, mixing.cycle_weights, 3.0).orderBy("i").collect()
    assert np.allclose([r["target"] for r in plan], shared_out(sizes))
    assert [r["source"] for r in plan] == [f"s{i:03}" if i < len(sizes) - 1 else None for i in range(len(sizes))]
    assert all(a["high"] == b["low"] for a, b in zip(plan, plan[1:])) and (not sum(sizes) or plan[-1]["high"] == 2**32)
    for r in plan:
        full, cut = max(0, r["need"] - 1), r["last_take"] if r["need"] else 0
        ends = sum(min(16, r["source_size"] - 16 * (k % r["blocks"])) for k in range(full)) + cut
        assert ends == round(r["target"]) or r["need"] and r["last_take"] == 16 and r["need"] % r["blocks"] == 0


@pytest.mark.parametrize("few_sources", [10_000, 3])
def test_the_mix_is_even_all_along(spark, few_sources):
    """Slots of many sources, with and without a broadcast: shares of every stretch are near the targets, words are those counted."""
    rows = [(i, prose(i, 40 + i % 23), "en", f"s{i % 12:02}", 1) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixed_sequence(df, block=16, few_sources=few_sources).orderBy("slot", "source", "rank", "first_word").collect()
    taken = {r["doc_id"]: r for r in mixing.mix(df, block=16, few_sources=few_sources).collect()}
    words, of, target = {}, {}, {r["source"]: r["target"] for r in taken.values()}
    total, so_far = sum(target.values()), 0
    for r in got:
        n = r["last_word"] - r["first_word"]
        assert 0 <= r["first_word"] < r["last_word"] <= taken[r["doc_id"]]["size"]
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + n
        of[r["source"]] = of.get(r["source"], 0) + n
        so_far += n
        assert all(abs(of.get(s, 0) - so_far * t / total) <= 6 * 16 for s, t in target.items())
    assert words == {d: r["taken"] for d, r in taken.items() if r["taken"]}


def test_sources_smaller_than_a_block(spark):
    """300 sources of one slot a pass: no stretch of the mix, and not its end, belongs to some of them."""
    rows = [(i, prose(i, 20 + i % 7), "en", f"s{i % 300:03}", 1) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixed_sequence(df).orderBy("slot", "source", "rank", "first_word").collect()
    target = {r["source"]: r["target"] for r in mixing.mix(df).collect()}
    slots = [r["slot"] for r in got]
    assert len(set(slots)) == max(slots) + 1  # all are filled, none is appended
    total = sum(target.values())
    for group in ([f"s{i:03}" for i in range(j, 300, 10)] for j in range(10)):
        share, so_far, own = sum(target[s] for s in group) / total, 0, 0
        for r in got:
            n = r["last_word"] - r["first_word"]
            so_far, own = so_far + n, own + n * (r["source"] in group)
            assert abs(own - so_far * share) <= 0.03 * total
    for parts in range(5, 301, 59):  # neighbours too
        share = sum(t for s, t in target.items() if s < f"s{parts:03}") / total
        for k in range(1, 11):
            upto = [r for r in got if r["slot"] < k * (max(slots) + 1) / 10]
            words = lambda rows: sum(r["last_word"] - r["first_word"] for r in rows)
            assert abs(words([r for r in upto if r["source"] < f"s{parts:03}"]) - share * words(upto)) <= 0.03 * total


def test_mixing_nothing(spark, none, odd):
    assert mixing.mix(none).count() == 0
    blank = odd.filter("doc_id < 3")
    assert {r["taken"] for r in mixing.mix(blank).collect()} == {0}


# ------------------------------------------------------------------ 5
def test_passages(spark, odd, none):
    shared, other = prose(11, 70), prose(12, 70).split()
    edited = other[:]
    edited[35] = "changed"
    texts = [prose(20, 90) + " " + shared + " " + prose(21, 40), shared + " " + prose(22, 300), prose(23, 500), prose(24, 40) + " " + " ".join(other), " ".join(edited) + " " + prose(25, 80), None, "", "short"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, sig string")
    got = {(r["doc_id"], r["match_id"]): r for r in passages.passages(df).collect()}
    assert set(got) == {(1, 0), (4, 3)}
    r = got[(1, 0)]
    assert (r["start_word"], r["match_start"], r["similarity"]) == (0, 90, 1.0) and 70 <= r["n_words"] <= 71
    assert passages.passages(none).count() == 0
    pairs = {(r["doc_id"], r["match_id"]) for r in passages.passages(odd).collect()}
    assert {(7, 6), (8, 6), (9, 6)} <= pairs


def test_all_passages_of_a_pair(spark):
    one, two = prose(40, 60), prose(41, 60)
    broken = one.split()
    broken[::6] = prose(42, 10).split()
    rows = [(0, one + " " + prose(43, 25) + " " + two), (1, one + " " + prose(44, 25) + " " + two)]  # the gap leaves one region
    rows += [(2, " ".join(broken) + " " + prose(45, 30) + " " + prose(46, 60)), (3, prose(46, 60))]
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["match_id"], r["start_word"], r["n_words"], r["match_start"]) for r in got) == [(1, 0, 0, 60, 0), (1, 0, 85, 60, 85), (3, 2, 0, 60, 90)]
    a, b = (shingles.text_shingles([t])[0] for t in (one, " ".join(broken) + " " + prose(47, 90) + " " + one))
    assert passages.matches(a, b, 46, 75) == [(0, 55, 150, 205, 1.0)]  # not the first place of each shingle


def test_one_replaced_word_at_any_place(spark):
    """A passage of 50 words with one word replaced, alone in its two texts, is found whatever the place."""
    rows = []
    for at in range(24, 36):
        for k in range(12):
            words = prose(1000 * at + k, 50).split()
            other = [*words[:at], "replaced", *words[at + 1 :]]
            rows.append((2 * (100 * at + k), " ".join([prose(7 * at + k, 30), *words, prose(5 * at + k + 10**6, 30)]), "en", "s", 1))
            rows.append((2 * (100 * at + k) + 1, " ".join([prose(3 * at + k + 10**7, 40), *other, prose(2 * at + k + 10**8, 20)]), "en", "s", 1))
    got = {(r["match_id"], r["doc_id"]) for r in passages.passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {(r[0], r[0] + 1) for r in rows if r[0] % 2 == 0}
    assert got == want


def led_passage(seed, line=25):
    """50 words in whose first `line` lie the minima of all functions, so that whoever has those leads its lists."""
    for k in itertools.count(seed):
        s = shingles.text_shingles([prose(k, 50)])[0]
        if all(shingles.mixed(s ^ shingles.mixed(np.uint64([f + 1]))).argmin() <= line - shingles.WIDTH for f in range(4)):
            return prose(k, 50)


def test_a_matched_template_keeps_other_passages_of_the_pair(spark):
    template, other = prose(50, 60), led_passage(1000)
    line = " ".join(other.split()[:25])
    texts = [template + " " + prose(51, 60) + " " + line + " " + prose(52, 60), prose(53, 60) + " " + other + " " + prose(54, 60), template + " " + prose(55, 60) + " " + other + " " + prose(56, 60)]
    got = passages.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["match_id"], r["start_word"], r["n_words"]) for r in got) == [(2, 0, 0, 60), (2, 1, 120, 50)]


def test_repeats_are_found_whoever_leads_the_lists(spark):
    other = led_passage(1000)
    line = " ".join(other.split()[:25])
    texts = [prose(60 + k, 60) + " " + line + " " + prose(80 + k, 60) for k in range(6)]  # more than there are rounds
    texts += [prose(100 + k, 60 + k) + " " + other + " " + prose(110 + k, 60) for k in range(3)]
    got = passages.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["match_id"], r["start_word"], r["n_words"], r["match_start"], r["similarity"]) for r in got) == [(7, 6, 61, 50, 60, 1.0), (8, 6, 62, 50, 60, 1.0)]


def test_compact_windows_are_those_of_the_definition():
    r = np.random.default_rng(5)
    s, doc, width = r.integers(0, 2**63, 120, dtype=np.uint64), np.repeat([0, 1, 2], [70, 5, 45]), 8
    sig, c, l, rr = passages.compact_windows(s, doc, width, 3)
    h = shingles.mixed(s ^ shingles.mixed(np.uint64([4])))
    want = set()
    for lo, hi in ((0, 70), (70, 75), (75, 120)):
        for m in range(lo, hi):
            a = b = m
            while a > lo and h[a - 1] > h[m]:
                a -= 1
            while b < hi - 1 and h[b + 1] > h[m]:
                b += 1
            if b - a + 1 >= width:
                want.add((m, a, b))
    assert set(zip(c.tolist(), l.tolist(), rr.tolist())) == want


def test_joint_windows_are_runs_with_the_same_minima():
    r = np.random.default_rng(6)
    s, doc, run = r.integers(0, 40, 120, dtype=np.uint64), np.repeat([0, 1, 2], [70, 5, 45]), 8
    sig, starts = passages.joint_windows(s, doc, run)
    h = [shingles.mixed(s ^ shingles.mixed(np.uint64([k + 1]))) for k in range(passages.HASHES)]
    minima = {i: tuple(int(x[i : i + run].min()) for x in h) for lo, hi in ((0, 70), (75, 120)) for i in range(lo, hi - run + 1)}
    of = {}
    for i in minima:
        of.setdefault(minima[i], set()).add(int(sig[np.searchsorted(starts, i, side="right") - 1]))
    assert all(len(x) == 1 for x in of.values()) and len(set.union(*of.values())) == len(of)


def test_one_shift_matches_as_the_general_way_does(monkeypatch):
    r = np.random.default_rng(9)
    pairs = []
    for _ in range(60):
        b = r.permutation(4000)[: r.integers(46, 200)].astype("<u4")
        lo, shift = int(r.integers(0, len(b) - 20)), int(r.integers(0, 60))
        a = np.r_[5000 + np.arange(shift), b[lo : lo + int(r.integers(20, 150))], 6000 + np.arange(int(r.integers(0, 60)))].astype("<u4")
        a[r.integers(0, len(a), int(r.integers(0, 7)))] += 10000
        pairs.append((a, b))
    fast = [passages.matches(a, b, 46, 75) for a, b in pairs]
    assert 10 < sum(map(bool, fast)) < 60
    fits = passages.could_match([a.tobytes() for a, _ in pairs], [b.tobytes() for _, b in pairs], 46, 75)
    assert all(f or not m for f, m in zip(fits, fast))
    monkeypatch.setattr(passages, "along_one_shift", lambda *x: 1 / 0)
    plain = lambda a, b: passages.matches(np.r_[a, [7, 7]].astype("<u4"), b, 46, 75)  # noqa: E731  a repeated shingle that b lacks
    assert [[x[:4] for x in f] for f in fast] == [[x[:4] for x in plain(a, b)] for a, b in pairs]
    assert np.allclose([x[4] for f in fast for x in f], [x[4] for a, b in pairs for x in plain(a, b)])


def brute_passages(rows, width=46, percent=75):
    """Pairs of rows that have similar windows of `width` shingles, and those that have equal ones."""
    sets, like, same = [shingles.text_shingles([t])[0] for _, t in rows], set(), set()
    for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2):
        bs = [set(b[k : k + width].tolist()) for k in range(len(b) - width + 1)]
        for k in range(len(a) - width + 1):
            w = set(a[k : k + width].tolist())
            if len(w & set(b.tolist())) * (100 + percent) >= 2 * percent * len(w):
                best = max((len(w & x) / len(w | x) for x in bs), default=0)
                if 100 * best >= percent:
                    like.add((rows[j][0], rows[i][0]))
                if best == 1:
                    same.add((rows[j][0], rows[i][0]))
    return like, same


def linked(pairs):
    """Representative of each document that pairs connect."""
    of = {}
    find = lambda x: x if of.setdefault(x, x) == x else find(of[x])
    for a, b in pairs:
        of[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in list(of)}


@pytest.mark.parametrize("line,own", [(30, 25), (40, 20), (40, 12)])
def test_passages_against_brute_force(spark, line, own):
    """Pairs that repeat a passage, most of which all pairs have in common; every other pair has a word changed."""
    common_line, rows = prose(300 + line, line), []
    for k in range(16):
        passage = (common_line + " " + prose(400 + k, own)).split()
        for side in range(2):
            if side and k % 2:
                passage[line + own // 2] = "changed"
            rows.append((2 * k + side, prose(500 + 2 * k + side, 30 + k) + " " + " ".join(passage) + " " + prose(700 + 2 * k + side, 25)))
    like, same = brute_passages(rows)
    got = {(r["doc_id"], r["match_id"]) for r in passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= like
    want, found = linked(like), linked(got)
    assert len(same) >= 8 and all(found.get(a) == found.get(b) is not None for a, b in same)
    assert sum(found.get(a, a) == found.get(b, b) for a, b in like) >= 0.9 * len(like)
    assert set(found) <= set(want)


def test_rows_of_passages_have_identities_of_their_own(spark):
    shared = prose(61, 70)
    rows = [(7, prose(62, 30) + " " + shared), (7, shared + " " + prose(63, 30)), (None, prose(64, 20) + " " + shared), (None, shared), (None, shared), (9, None)]
    got = sorted(((r["doc_id"] or 0, r["match_id"] or 0) for r in passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert len(got) == 3 and {x for p in got for x in p} == {0, 7}


# ------------------------------------------------------------------ 6
def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_sharding(spark, odd, none):
    rows = sharding.sharded(odd, 8).collect()
    assert len(rows) == len(odd_rows()) and sharding.sharded(none, 8).count() == 0
    for r in rows:
        assert r["shard"] == plain_jump(r["doc_id"] or 0, 8) and r["grown_shard"] in (r["shard"], 8)
    for s in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    texts = {r[0]: r[1] or "" for r in odd_rows()}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    keys = np.arange(-3000, 3000)
    assert sharding.jump(keys.view(np.uint64), 11).tolist() == [plain_jump(int(k) % 2**64, 11) for k in keys]


def test_written_shards(spark, odd, tmp_path):
    sharding.write_shards(odd, f"file://{tmp_path}/s", 4, files_per_shard=2)
    assert spark.read.parquet(f"file://{tmp_path}/s").count() == len(odd_rows())


# ------------------------------------------------------------------ 7
def test_written_shards_leave_a_column_of_their_name_alone(spark, clashing, tmp_path):
    sharding.write_shards(clashing, f"file://{tmp_path}/c", 4)
    got = spark.read.parquet(f"file://{tmp_path}/c")
    assert {r["shard"] for r in got.collect()} == {"x"} and "_shard" in got.columns and got.count() == 3


def test_fingerprints(spark, odd, none):
    rows = fingerprints.fingerprinted(odd).collect()
    assert len(rows) == len(odd_rows()) and fingerprints.fingerprinted(none).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id", ascending=False)
    texts, got = docs.text.tolist(), {r["doc_id"]: r for r in fingerprints.op7_fingerprints(spark, SF).collect()}
    same = {}
    for i, (doc, t) in enumerate(zip(docs.doc_id, texts)):
        nxt, m = texts[(i + 1) % len(texts)], len(t) // 3
        edited = t[: len(t) - m] + nxt[:m]
        r = got[doc]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, n = (set(fingerprints.paragraph_digests(x.encode()).tolist()) for x in (t, edited, nxt))
        assert abs(r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1)) < 1e-9 and abs(r["near_next"] - (len(a & n) / len(a | n) if a | n else 1)) < 1e-9
        same.setdefault(t, set()).add(r["fingerprint"])
    assert all(len(f) == 1 for f in same.values())


def test_sketches_recover_what_differs():
    r = np.random.default_rng(2)
    a = [np.unique(r.integers(0, 2**63, n, dtype=np.uint64)) for n in (0, 0, 1, 5, 400, 3000)]
    b = [np.unique(np.r_[x[len(x) // 4 :], r.integers(0, 2**63, 1 + len(x) // 9, dtype=np.uint64)]) for x in a]
    b[0] = a[0]
    first, second = fingerprints.differences(a, b)
    assert first.tolist() == [len(np.setdiff1d(x, y)) for x, y in zip(a, b)] and second.tolist() == [len(np.setdiff1d(y, x)) for x, y in zip(a, b)]


# ------------------------------------------------------------------ 8
def brute_classes(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)))
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((root(i), root(j)), key=lambda k: rows[k][0])
            label[b] = a
    return [(rows[i][0], len(sets[i]), rows[root(i)][0]) for i in range(len(rows))]


@pytest.mark.parametrize("rounds", [0, 2])
def test_ngram_join(spark, rounds):
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] is not None][:14]
    r = random.Random(9)
    base = prose(30, 80).split()
    for k in range(60):  # chains of near copies, some linked only through others
        words = base[:]
        for _ in range(k % 7):
            words[r.randrange(80)] = prose(100 + k, 1)
        rows.append((100 + k, " ".join(words)))
    for k in range(20):  # a passage that many have, and texts of their own
        rows.append((300 + k, prose(31, 40) + " " + prose(400 + k, 30)))
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(x) for x in ngram_join.ngram_join(df, rounds=rounds).collect())
    assert got == sorted(brute_classes(rows))


def long_copies(many, changed, words=700, seed=50):
    """Copies of one long text with words replaced, so that two copies are near the similarity, above or below it."""
    r, base = random.Random(seed), prose(seed, words).split()
    rows = []
    for k in range(many):
        copy = base[:]
        for i in r.sample(range(words), changed[k % len(changed)]):
            copy[i] = f"new{k}x{i}"
        rows.append((1000 + k, " ".join(copy)))
    return rows


@pytest.mark.parametrize("block", [8, 64])
@pytest.mark.parametrize("rounds", [0, 2])
def test_ngram_join_long_copies(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = long_copies(40, [9, 10, 11, 12, 13, 16]) + [(2000 + k, t) for k, (_, t) in enumerate(long_copies(12, [3, 14], seed=51))]
    rows += [(3000 + k, rows[k][1] + " tail") for k in range(5)] + [(4000 + k, prose(60 + k, 300)) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(x) for x in ngram_join.ngram_join(df, rounds=rounds).collect())
    assert got == sorted(brute_classes(rows))
    assert len({c for _, _, c in got}) > 10


def test_long_copies_below_the_similarity_go_by_blocks(spark, monkeypatch):
    """Sets that travel to be compared: about 2 / BLOCK of the pairs' number, not two a pair."""
    moved, pairs = [], []
    cells, plain = ngram_join.cells_verified, ngram_join.verified

    def count_cells(met, members, *rest):
        blocks = met.select(F.explode(F.array("x", "y")).alias("block"), "x", "y").distinct()
        moved.append(blocks.join(members, "block").count())
        return cells(met, members, *rest)

    def count_pairs(met, *rest):
        pairs.append(met.count())
        return plain(met, *rest)

    monkeypatch.setattr(ngram_join, "cells_verified", count_cells)
    monkeypatch.setattr(ngram_join, "verified", count_pairs)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    many = 64
    df = spark.createDataFrame(long_copies(many, [14], words=750), "doc_id long, text string")
    assert ngram_join.ngram_join(df).filter("doc_id <> component_id").count() <= 2
    assert sum(pairs) < 4 * many and 0 < sum(moved) < many * (many // 16 + 3) * 2


def test_plans_of_the_ngram_join_are_small(spark, monkeypatch):
    """The driver plans a step again at each of its stages, so its memory follows the largest plan."""
    joins, plain = {}, common.written

    def count(df, name):
        joins[name] = max(joins.get(name, 0), df._jdf.queryExecution().executedPlan().toString().count("Join "))
        return plain(df, name)

    monkeypatch.setattr(common, "written", count)
    rows = long_copies(20, [3, 14]) + [(k, prose(k, 30)) for k in range(10)] + [(100 + k, prose(k, 30) + " tail") for k in range(10)]
    ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert len(joins) > 8 and max(joins.values()) <= 6, joins


def test_steps_of_the_ngram_join_are_few(spark, monkeypatch):
    """The driver plans each write and each look at a table, so its memory follows their number: a round of components is one write
    that tells whether it changed anything, and members of a group need no components."""
    frame, taken = type(spark.range(0)), []
    written, empty = common.written, frame.isEmpty
    monkeypatch.setattr(common, "written", lambda df, name: taken.append(name) or written(df, name))
    monkeypatch.setattr(frame, "isEmpty", lambda self: taken.append("isEmpty") or empty(self))
    chain = [(i, i + 1) for i in range(1, 40)]
    assert components.components(spark.createDataFrame(chain, "a long, b long")).filter("label = 1").count() == 40
    assert taken.count("isEmpty") == 1 and taken.count("links") == 1
    taken.clear()
    rows = [(k, prose(k, 30)) for k in range(10)] + [(100 + k, prose(k, 30) + " tail") for k in range(10)] + [(200 + k, prose(k, 30)) for k in range(10)]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.filter("component_id = doc_id % 100").count() == 30
    assert len(taken) <= 22, taken


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_ngram_join_odd(spark, odd, none):
    assert ngram_join.ngram_join(none).count() == 0
    assert ngram_join.ngram_join(odd).count() == len(odd_rows())


def test_packed_keys():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**40, 500, dtype=np.uint64))
    assert (ngram_join.unpack_sorted(ngram_join.pack_sorted(keys)) == keys).all()
    assert ngram_join.unpack_small(ngram_join.pack_small(np.array([0, 5, 2**32 - 1]))).tolist() == [0, 5, 2**32 - 1]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["id"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}


# ------------------------------------------------------------------ 9
def test_token_files(spark, odd, none, tmp_path):
    path = f"file://{tmp_path}/t"
    token_files.write_tokens(odd, path, tokens.public_path("byte_bpe_50k.json"), 2, stride=1000)
    got = sorted(token_files.token_index(spark, path).collect(), key=lambda r: r["start"])
    e = tokens.ChunkEncoder(tokens.public_path("byte_bpe_50k.json"))
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    at = 0
    for r, (doc, text, *_) in zip(got, rows):
        ids = e.ids(text) + np.array([2], "<u4").tobytes()
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    assert token_files.read_tokens(spark, path).filter("doc_id = 10").count() == 1
    token_files.write_tokens(none, path + "0", tokens.public_path("byte_bpe_50k.json"), 2)
    assert token_files.token_index(spark, path + "0").count() == 0


def test_files_are_read_in_the_order_of_their_numbers(spark, tmp_path):
    """Spark numbers part files with five digits; the sixth must not put part-100000 before part-99999."""
    path = tmp_path / "many"
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    token_files.write_tokens(docs, f"file://{path}", tokens.public_path("byte_bpe_50k.json"), 2)
    files = sorted(p for p in path.iterdir() if p.name.startswith("part-"))
    assert len(files) > 2
    for p in path.iterdir():
        if p.name.endswith(".crc"):
            p.unlink()
    for i, p in enumerate(files):
        p.rename(path / f"part-{99_998 + i}-{p.name.split('-', 2)[2]}")
    got = token_files.token_index(spark, f"file://{path}").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == list(range(40)) and got[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))


# ------------------------------------------------------------------ 10
def test_exact_dedup(spark, odd, none):
    got = exact_dedup.exact_dedup(odd).collect()
    groups = {}
    for doc, text, *_ in odd_rows():
        groups.setdefault(text or "", []).append(doc)
    assert len(got) == len(odd_rows()) and sum(r["kept"] for r in got) == len(groups)
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = [d for d in groups[text] if d is not None]
        assert r["group_size"] == len(groups[text]) and r["keep_id"] == (max(ids) if ids else None)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.deduplicated(odd).count() == len(groups)


def test_dedup_stream_remembers(spark, tmp_path):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    two = spark.createDataFrame([(5, "a"), (4, "c")], "doc_id long, text string")
    feed, check, out = (f"file://{tmp_path}/{x}" for x in ("feed", "check", "out"))
    for batch in (one, two):
        exact_dedup.digests(exact_dedup.located(batch)).write.mode("append").parquet(feed)
        exact_dedup.run_stream(spark, feed, check, out)
    state = {r["best"]["doc_id"]: r["n"] for r in exact_dedup.latest_state(spark, out).collect()}
    assert state == {5: 2, 2: 1, 4: 1}


def test_bytes_settle_equal_digests(spark, odd, monkeypatch):
    monkeypatch.setattr(F, "sha2", lambda c, n: F.lit("00" * 32))  # every text has one digest
    got = exact_dedup.exact_dedup(odd.filter("doc_id in (3, 4, 6, 7, 10)")).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [(3, 4, 4)] * 3 + [(4, 4, 4), (6, 7, 2), (7, 7, 2), (10, 10, 1)]


# ------------------------------------------------------------------ common and pipeline
def test_clashing_columns(spark, clashing):
    model = language.fit(clashing)
    path = tokens.public_path("word_bpe_49k.json")
    assert language.identified(clashing, model).count() == 3
    assert exact_dedup.deduplicated(clashing).columns == clashing.columns
    for df in (exact_dedup.exact_dedup(clashing), sharding.sharded(clashing), mixing.mix(clashing), packing.pack(clashing, path), ngram_join.ngram_join(clashing), fingerprints.fingerprinted(clashing)):
        assert df.count() == 3
    assert passages.passages(clashing).count() == 0
    docs = clashing
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == clashing.columns
    # values of the user's columns come out as they went in
    extra = [c for c in clashing.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    assert all(r[c] == "x" for r in docs.collect() for c in extra)
    assert token_counts.counted(clashing, {"words": common.words_of}).count() == 3
    path = common.new_folder(spark, "clashing")
    token_files.write_tokens(clashing, path, tokens.public_path("byte_bpe_50k.json"), 2)
    assert token_files.token_index(spark, path).count() == 3


def test_words(spark, odd):
    got = odd.select("text", common.words_of(F.col("text")).alias("n")).collect()
    assert all(r["n"] == len(re.findall(common.WORD, r["text"] or "")) for r in got)


def test_borders(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    borders = common.borders_of(df, "k", 13)
    got = df.select("k", common.place_among(borders, F.col("k")).alias("p")).collect()
    assert all(r["p"] == sum(b <= r["k"] for b in borders) for r in got)


def test_pipeline(spark, odd, none):
    assert [s[0] for s in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "mixing", "packing"]
    for start in (odd, none):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = common.written(stage(spark, docs, SF), "stage")
            if name != "packing":
                assert docs.columns == start.columns
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    kept = common.written(corpus_pipeline.language_id(spark, docs, SF), "kept")
    assert kept.count() == language.identified(docs, model).filter("not found.rejected").count() >= 0.98 * docs.count()
    rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    best = {}
    for d, t in rows.items():
        best[t] = max(best.get(t, -1), d)
    exact = common.written(corpus_pipeline.exact(spark, kept, SF), "exact")
    assert {r["doc_id"] for r in exact.collect()} == set(best.values())
    left = sorted((d, rows[d]) for d in best.values())
    near = common.written(corpus_pipeline.near_duplicates(spark, exact, SF), "near")
    assert {r["doc_id"] for r in near.collect()} == {d for d, _, c in brute_classes(left) if d == c}
    # mixing: how often each document stands in the mix that brute force makes
    texts = {r["doc_id"]: (r["text"], r["source"]) for r in near.collect()}
    hashes = {r["doc_id"]: r["h"] for r in near.select("doc_id", F.xxhash64("doc_id", F.lit(4)).alias("h")).collect()}
    taken = brute_mix([(d, len(re.findall(common.WORD, t or "")), s, hashes[d]) for d, (t, s) in texts.items()], 256)
    size = {d: len(re.findall(common.WORD, t or "")) for d, (t, _) in texts.items()}
    want = sorted(d for d, n in taken.items() for _ in range(int(n / size[d] + 0.5)))
    mixed = common.written(corpus_pipeline.mixed_sources(spark, near, SF), "mixed")
    assert sorted(r["doc_id"] for r in mixed.collect()) == want
    # packing: the pieces are those of the texts, and as few sequences as the bound allows, nearly
    e, pieces = tokens.ChunkEncoder(tokens.public_path("word_bpe_49k.json")), []
    for d in want:
        n = len(e.ids(texts[d][0])) // 4 + 1
        pieces += [(d, k, min(4096, n - 4096 * k)) for k in range(-(-n // 4096))]
    packed = corpus_pipeline.packed(spark, mixed, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in packed) == sorted(pieces)
    assert len({r["sequence_id"] for r in packed}) <= sum(n for _, _, n in pieces) / 4096 * 1.02 + 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in got) == sorted(pieces)


def brute_mix(docs, block):
    """Words that the mix takes of each of (doc_id, size, source, hash), slot by slot."""
    sources = sorted({s for _, _, s, _ in docs}, key=lambda s: (s is None, s or ""))
    of = {s: sorted((h, d, n) for d, n, x, h in docs if x == s and n) for s in sources}
    sizes = [sum(n for _, _, n in of[s]) for s in sources]
    target = shared_out(sizes)
    high = [round(h * 2**32) for h in np.cumsum(target) / sum(target)]
    stream = {s: np.repeat([d for _, d, _ in of[s]], [n for _, _, n in of[s]]) for s in sources}
    need, taken = [], {d: 0 for d, n, _, _ in docs if n}
    for s, t in zip(sizes, target):
        passes, rest = divmod(round(t), s) if s else (0, 0)
        need.append((passes * -(-s // block) + -(-rest // block), rest - (-(-rest // block) - 1) * block if rest else block))
    ranks = [0] * len(sources)
    slots = [next(i for i, h in enumerate(high) if k * mixing.PHI32 % 2**32 < h) for k in range(-(-sum(sizes) // block))]
    for i in [*slots, *(i for i in range(len(sources)) for _ in range(need[i][0]))]:
        if ranks[i] < need[i][0]:
            at = ranks[i] % -(-sizes[i] // block) * block
            n = need[i][1] if ranks[i] == need[i][0] - 1 else block
            for d in stream[sources[i]][at : at + n].tolist():
                taken[d] += 1
            ranks[i] += 1
    return taken


def test_rows_that_share_an_id_in_the_pipeline(spark):
    """Ids that repeat or are null: each row goes or stays by its own text."""
    base = prose(70, 60)
    near = base.replace(base.split()[30], "changed", 1)
    rows = [(1, base, "en", "a", 1), (2, near, "en", "a", 1), (2, prose(71, 60), "en", "a", 1), (None, prose(72, 60), "en", "a", 1), (None, near.replace("changed", "other"), "en", "a", 1)]
    docs = common.written(spark.createDataFrame(rows, SCHEMA), "docs")
    kept = common.written(corpus_pipeline.near_duplicates(spark, docs, SF), "kept")
    texts = [r["text"] for r in kept.collect()]
    assert len(texts) == 3 and {prose(71, 60), prose(72, 60)} < set(texts)
    assert sorted(r["text"] for r in corpus_pipeline.mixed_sources(spark, kept, SF).collect()) == sorted(texts)
