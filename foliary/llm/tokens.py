"""Exact token ids of whole texts by the tokenizers library, with a cache of chunks per worker.

Byte-pair models never merge across pre-token borders, so a text can be cut at white space, each
distinct chunk encoded once by the library's model and the ids put together again. Chunks with
anything outside a safe alphabet go through the library's whole pipeline, and texts with
white space other than ASCII, or with one of the model's added tokens, are encoded in one piece, so that
the ids are always those of `Tokenizer.encode(text, add_special_tokens=False)`.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chars of text that are encoded together.
BATCH = 1 << 21
#: Words that a worker's cache holds, and rows whose texts a task has in Python at once.
CACHED, ROWS = 300_000, 2_000

#: White space that Unicode has besides ASCII, and the separators that libraries see differently.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‍    ⁠　﻿]")
#: Letters whose normal form and lower case have one char and no context.
SAFE = re.compile("[\x20-\x7e\t\n\rÀ-ą]*")
#: Bytes that any such character begins with or is, and white space that is more than one space or line end.
ODD_LEADS = [b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2", b"\xe1", b"\xe2", b"\xe3", b"\xef"]
ODD_RUNS = [b"\t", b"\x0b", b"\x0c", b"\r", b"  ", b"\n\n", b" \n", b"\n "]
SPACED = re.compile(rb" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: ASCII marks that byte-level models take as one piece behind a word; an apostrophe may begin a piece with letters.
MARKS = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level models: itself if printable, else the next free from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ChunkEncoder:
    """many(texts) gives little-endian unsigned 32-bit ids of each text as bytes."""

    def __init__(self, path: str, most_cached: int = CACHED):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.lowers = "Lowercase" in json.dumps(spec["normalizer"])
        if self.lowers:
            parts = spec["pre_tokenizer"]["pretokenizers"]
            pattern = next(p["pattern"]["Regex"] for p in parts if p["type"] == "Split")
        else:
            pattern = BYTE_LEVEL
        self.added = [t["content"].lower().encode() for t in spec["added_tokens"]]
        self.pieces = regex.compile(pattern).findall
        self.chars = byte_chars()
        self.lead = self.chars[32]
        self.words = Cache(self.chunk if self.lowers else self.word, most_cached)
        self.cores = Cache(self.core, most_cached // 2)
        self.ends = {b"": b""}
        self.ends |= {c.encode(): self.piece(c) for c in ".,"}
        self.line_end = b"" if self.lowers else self.whole("\n")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def core(self, mapped: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def mapped(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.chars)

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token."""
        mapped = piece if piece.isalnum() and piece.isascii() else self.mapped(piece)
        return self.cores[mapped] if len(mapped) < 64 else self.core(mapped)

    def chunk(self, raw: bytes) -> bytes:
        """Ids of a part of a text that can be cut out of it."""
        # most are a plain word, or one with a full stop or comma behind
        if raw.isalpha() and len(raw) < 64:
            return self.cores[raw.decode()]
        word, end = (raw[:-1], raw[-1:]) if raw[-1:] in self.ends else (raw, b"")
        bare = word[1:] if word[:1] == b" " else word
        if bare.isalpha() and len(bare) < 64:
            return self.cores[self.lead * (len(word) - len(bare)) + bare.decode()] + self.ends[end]
        text = word.decode("utf-8", "replace")
        if bare and text[len(word) - len(bare) :].isalpha() and (SAFE.fullmatch(text) or not self.lowers):
            return self.piece(text.lower() if self.lowers else text) + self.ends[end]
        text = raw.decode("utf-8", "replace")
        if SAFE.fullmatch(text):
            if self.lowers:
                text = text.lower()
            return b"".join(map(self.piece, self.pieces(text)))
        return self.whole(text)

    def word(self, word: bytes) -> bytes:
        """Ids of what stands between two spaces, a line end before it included."""
        if not word:
            return self.chunk(word)
        # a plain word is cached here alone, and one with marks behind takes its ids and those of the marks, a piece of their own
        if word.isalpha():
            return self.core(self.lead + word.decode())
        bare = word.rstrip(MARKS)
        if bare.isalpha() or bare and not bare.isascii() and bare.decode("utf-8", "replace").isalpha():
            if len(bare) < len(word):
                return self.words[bare] + self.piece(word[len(bare) :].decode())
            return self.core(self.lead + self.mapped(word.decode("utf-8", "replace")))
        return self.line_end + (self.chunk(word[1:]) if word[1:] else b"") if word[:1] == b"\n" else self.chunk(b" " + word)

    def odd(self, text: str, raw: bytes) -> bytes | None:
        """Ids of a text that can't be cut at single spaces and line ends; None for one that can."""
        low = raw.lower()
        if any(t in low for t in self.added) or any(b in raw for b in ODD_LEADS) and ODD_SPACE.search(text):
            return self.whole(text)
        if self.lowers or not any(b in raw for b in ODD_RUNS) and raw.strip() == raw:
            return None
        return b"".join(map(self.chunk, SPACED.findall(raw)))

    def many(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain, raws = [], []
        for i, text in enumerate(texts):
            raw = (text or "").encode("utf-8", "replace")
            got = self.odd(text, raw) if raw else b""
            if got is None:
                plain.append(i)
                # as if every text had a line end before it, whose id is left out below
                raws.append(raw if self.lowers else b"\n" + raw)
            else:
                out[i] = got
        if plain:
            lead = len(self.line_end) // 4
            for i, (flat, lo, hi) in zip(plain, self.joined(pa.array(raws, type=pa.binary()))):
                out[i] = flat[lo + lead : hi].tobytes()
        return out

    def joined(self, raws: pa.Array) -> Iterator[tuple[np.ndarray, int, int]]:
        """Each distinct word is looked up once; ids of all texts in a row, and each text's first and last place."""
        texts = raws.cast(pa.string())
        if self.lowers:
            lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        else:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        coded = lists.values.cast(pa.binary()).dictionary_encode()
        blobs = [self.words[w] for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        for cache in (self.words, self.cores):
            cache.turn()
        code = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // 4
        pool, starts = np.frombuffer(b"".join(blobs), dtype="<u4"), np.cumsum(sizes) - sizes
        size = sizes[code]
        ends = np.r_[0, np.cumsum(size)]
        flat = pool[np.repeat(starts[code] - ends[:-1], size) + np.arange(ends[-1])]
        at = ends[lists.offsets.to_numpy()].tolist()
        return ((flat, lo, hi) for lo, hi in zip(at[:-1], at[1:]))

    def ids(self, text: str | None) -> bytes:
        return self.many([text])[0]

    def batches(self, texts: Sequence[str | None]) -> Iterator[tuple[int, list[bytes]]]:
        """First place and ids of some texts at a time, so that memory follows `BATCH` or the longest text."""
        at = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= BATCH or i == len(texts) - 1:
                yield at, self.many(texts[at : i + 1])
                at, size = i + 1, 0


class Cache(dict):
    """Ids of what was seen; what is new is encoded when it is first asked for. When half of the bound is
    reached, the older half goes, but for what was asked for since."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.half, self.older = encode, max(1, most // 2), {}

    def __missing__(self, key):
        got = self.older.get(key)
        if got is None:
            got = self.encode(key)
        self[key] = got
        return got

    def turn(self) -> None:
        if len(self) > self.half:
            self.older = dict(self)
            self.clear()


@lru_cache(maxsize=4)
def encoder(path: str, most_cached: int = CACHED) -> ChunkEncoder:
    """One encoder for each worker process and file; workers live on between jobs, and so do their caches."""
    return ChunkEncoder(path, most_cached)


def public_path(name: str) -> str:
    """Where a public vocabulary file is; jobs take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)
