"""N-gram Jaccard self-join by grouped prefixes, and the classes of documents that it links.

Shingles are ordered by document frequency, then by hash. Of two sets of n shingles that reach
the similarity, the first n - ceil(t * n) + 1 of each in that order share one. A shingle that only
one document has can link nothing, so its document needs no posting for it, and most documents,
with enough such shingles, need none at all.

1. Frequencies. Each unit (some MB of texts) sends its distinct hashes to buckets as packed arrays,
   one entry per unit for a hash that the unit has more than once, so a shingle of every third
   document is still a small load. Buckets answer each unit with the hashes that more than one
   document has, and the unit lists each document's shared shingles in order.
2. Grouped prefix join. Documents with equal sets form a class. Classes with identical prefixes and
   sizes collapse into one group; groups are posted under their prefix's shingles and pairs
   are filtered by size and position. Not all pairs of a list are made: in each of `rounds` rounds a
   group meets a pivot of its lists, and lists whose members are connected already rest. Then
   the pairs of documents not connected yet are made, all that can link: each set has a signature of
   `SIGNATURE` bits, one per shingle by its hash, and the bits that one has and the other lacks bound the overlap
   from above, exactly and inside the join, so near copies that are too far from each other make no pairs.
   Signatures tell little of long sets. Groups of these that share most of their lists' first member are dealt to blocks
   of at most about `BLOCK`, which are posted as one; blocks that could link meet in a cell.
3. Verification. Group pairs are expanded to their members, and the overlap counted on whole sets; in a cell, of all sets at
   once by a product of their incidence matrix, so a set travels once a block it meets and not once a pair.

Hashes have 40 bits inside a bucket beside the bucket's own: for two unrelated texts of a thousand
shingles each, the chance that one seems shared is below one in a million.

Cases: a null or blank text has an empty set and is linked with nothing; texts of fewer than five
words have one shingle, the whole; a text of any length is taken whole; equal texts are linked; rows
that repeat an id are linked by their texts alone, and each is returned; a null id never is the
smallest of a class that has another; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .components import both_ways, components_of
from .shingles import text_shingles

KEY_BITS = 40
UNIT_BYTES = 6 << 20
#: Chars of text that send their hashes to one bucket.
BUCKET_CHARS = 8 << 20
#: Bits of a set's signature.
SIGNATURE = 512
#: Groups of a block, and shared shingles of a block's sets.
BLOCK = 64
BLOCK_SHARED = 1 << 17
#: Shingles whose column a cell's matrix has at once.
COLUMNS = 1 << 13
#: of a unit's rows: bucket rows go to buckets, the note goes to the unit's own end
SENT = "bucket int, unit long, note boolean, keys binary, docs binary, counts binary"
ANSWER = "unit long, bucket int, note boolean, keys binary, docs binary, counts binary"
SETS = "doc_id long, n_shingles long, digest binary, alone long, take long, tokens array<long>, sig array<long>"


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 40-bit keys as differences, by byte planes, so that the high planes compress."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(5, -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :5] = planes.T
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values by byte planes."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_small(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


def batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)


SENT_NAMES = ["bucket", "unit", "note", "keys", "docs", "counts"]
SENT_TYPES = [pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
ANSWER_NAMES = ["unit", "bucket", "note", "keys", "docs", "counts"]
ANSWER_TYPES = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]


def unit_rows(unit: int, ids: list[int], texts: list[str | None], bits: int) -> list[tuple]:
    """A unit's rows for the buckets and its note: per document id, set size and digest, and the hashes
    that several of its documents have."""
    sets = [np.unique(s) for s in text_shingles(texts)]
    sizes = np.array([len(s) for s in sets], dtype="<i8")
    digests = b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
    hashes = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    hashes = hashes >> np.uint64(64 - KEY_BITS - bits)
    docs = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0)
    counts = np.diff(np.append(first, len(hashes)))
    many = np.repeat(counts > 1, counts)
    heads = hashes[first]
    # a document index, or all ones where the note says which
    heads_docs = np.where(counts > 1, 0xFFFFFFFF, docs[first])
    buckets = (heads >> np.uint64(KEY_BITS)).astype(np.int64)
    edges = np.searchsorted(buckets, np.arange((1 << bits) + 1))
    keys = heads & np.uint64((1 << KEY_BITS) - 1)
    out = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        i, j = edges[b], edges[b + 1]
        several = counts[i:j][counts[i:j] > 1]
        out.append((b, unit, False, pack_sorted(keys[i:j]), pack_small(heads_docs[i:j]), pack_small(several)))
    note = np.array(ids, dtype="<i8").tobytes() + sizes.tobytes() + digests
    shared = hashes[many].astype("<u8").tobytes()
    out.append((unit % (1 << bits), unit, True, note, shared, docs[many].astype("<u4").tobytes()))
    return out


def send(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids.append(doc)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= UNIT_BYTES:
                    yield batch(unit_rows((part << 24) + n, ids, texts, bits), SENT_NAMES, SENT_TYPES)
                    ids, texts, size, n = [], [], 0, n + 1
        if ids:
            yield batch(unit_rows((part << 24) + n, ids, texts, bits), SENT_NAMES, SENT_TYPES)

    return run


def answer(group: pa.Table) -> pa.Table:
    """One bucket: which hashes do several documents have, and how many."""
    rows = [r for r in group.to_pylist()]
    told = [(r["unit"], r["bucket"], True, r["keys"], r["docs"], r["counts"]) for r in rows if r["note"]]
    rows = [r for r in rows if not r["note"]]
    if rows:
        keys = [unpack_sorted(r["keys"]) for r in rows]
        docs = [unpack_small(r["docs"]) for r in rows]
        counts = []
        for r, d in zip(rows, docs):
            c = np.ones(len(d), dtype=np.int64)
            c[d == 0xFFFFFFFF] = unpack_small(r["counts"])
            counts.append(c)
        flat, number = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        first = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]) != 0)
        total = np.add.reduceat(number[order], first)
        frequency = np.empty(len(flat), dtype=np.int64)
        frequency[order] = np.repeat(total, np.diff(np.append(first, len(flat))))
        at = 0
        for r, k, d in zip(rows, keys, docs):
            f = frequency[at : at + len(k)]
            at += len(k)
            keep = f > 1
            if keep.any():
                told.append((r["unit"], r["bucket"], False, pack_sorted(k[keep]), pack_small(d[keep]), pack_small(f[keep])))
    return pa.Table.from_batches([batch(told, ANSWER_NAMES, ANSWER_TYPES)])


def settle(percent: int):
    """One unit: each document's shared shingles in order, how many of its own come before them, and how
    many of them its prefix takes. Documents that can link nothing are left without tokens."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        note = next(r for r in rows if r["note"])
        n = len(note["keys"]) // 32
        ids, sizes = np.frombuffer(note["keys"], "<i8", n), np.frombuffer(note["keys"], "<i8", n, 8 * n)
        digests = [note["keys"][16 * n + 16 * i : 16 * n + 16 * i + 16] for i in range(n)]
        shared, owners = np.frombuffer(note["docs"], "<u8").astype(np.uint64), np.frombuffer(note["counts"], "<u4").astype(np.int64)
        hashes, docs, frequency = [], [], []
        for r in rows:
            if not r["note"]:
                hashes.append(unpack_sorted(r["keys"]) | (np.uint64(r["bucket"]) << np.uint64(KEY_BITS)))
                docs.append(unpack_small(r["docs"]))
                frequency.append(unpack_small(r["counts"]))
        h, d, f = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((hashes, np.uint64), (docs, np.int64), (frequency, np.int64)))
        several = d == 0xFFFFFFFF
        known, order = h[several], np.argsort(h[several], kind="stable")
        place = order[np.searchsorted(known[order], shared)] if len(shared) else np.zeros(0, np.int64)
        h, d, f = np.r_[h[~several], shared], np.r_[d[~several], owners], np.r_[f[~several], f[several][place]]
        order = np.lexsort((h, f, d))
        h, d = h[order], d[order]
        ends = np.searchsorted(d, np.arange(n + 1))
        alone = sizes - np.diff(ends)
        prefix = np.where(sizes > 0, sizes + (-percent * sizes // 100) + 1, 0)
        take = np.maximum(prefix - alone, 0)
        alive = np.repeat(take > 0, np.diff(ends))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(take > 0, np.diff(ends), 0))], type=pa.int32()), pa.array(h[alive].astype(np.int64)))
        words = SIGNATURE // 64
        signs = np.zeros(n * words, dtype=np.uint64)
        np.bitwise_or.at(signs, d * words + (h >> np.uint64(6)).astype(np.int64) % words, np.uint64(1) << (h & np.uint64(63)))
        signs = pa.FixedSizeListArray.from_arrays(pa.array(signs.view(np.int64)), words).cast(pa.list_(pa.int64()))
        return pa.Table.from_arrays(
            [pa.array(ids), pa.array(sizes), pa.array(digests, type=pa.binary()), pa.array(alone), pa.array(take), lists, signs],
            names=["doc_id", "n_shingles", "digest", "alone", "take", "tokens", "sig"],
        )

    return run


def shared_sets(docs: DataFrame, percent: int, bits: int) -> DataFrame:
    sent = docs.mapInArrow(send(bits), SENT)
    answers = sent.groupBy("bucket").applyInArrow(answer, ANSWER)
    return common.written(answers.groupBy("unit").applyInArrow(settle(percent), SETS), "shared-shingles")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), with their labels la and lb, the labels (a, b) of those whose sets are similar enough."""
    a = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb")).cast("long")
    found = pairs.join(a, "a").join(b, "b")
    return found.filter(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select(F.col("la").alias("a"), F.col("lb").alias("b"))


def cell_links(percent: int):
    """Links of one cell: labels (a, b) for each set b that links join, through sets of the cell, to a, the smallest of its kind."""

    def run(cell: pa.Table) -> pa.Table:
        ids, n = cell.column("id").to_numpy(), cell.column("n").to_numpy()
        tokens = cell.column("tokens").combine_chunks()
        owner = np.repeat(np.arange(len(ids)), tokens.value_lengths().to_numpy())
        _, column, times = np.unique(tokens.flatten().to_numpy(), return_inverse=True, return_counts=True)
        order = np.argsort(column, kind="stable")
        order = order[times[column[order]] > 1]
        column, owner = column[order], owner[order]
        both = np.zeros((len(ids), len(ids)))
        edges = np.searchsorted(column, np.arange(0, len(times) + COLUMNS, COLUMNS))
        for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
            if i < j:
                has = np.zeros((len(ids), COLUMNS), dtype=np.float32)
                has[owner[i:j], column[i:j] - k * COLUMNS] = 1
                both += has @ has.T
        linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        label, known = ids, cell.column("label").to_numpy()
        while True:
            near = np.where(linked, label[None, :], label[:, None]).min(axis=1)
            if (near == label).all():
                break
            label = near
        moved = label != ids
        order = np.argsort(ids, kind="stable")
        lead = order[np.searchsorted(ids[order], label[moved])]
        return pa.table({"a": pa.array(known[lead], type=pa.int64()), "b": pa.array(known[moved], type=pa.int64())})

    return run


def cells_verified(cells: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links found in cells (x, y) of blocks. `members` has block, id and label; blocks of many members come in parts."""
    sized = members.join(sets.select("id", "n", F.size("tokens").cast("long").alias("_shared"), "tokens"), "id")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / (4 * BLOCK)), F.ceil(F.sum("_shared") / (4 * BLOCK_SHARED)))
    parts = common.written(sized.groupBy("block").agg(parts.cast("int").alias("parts")), "parts")
    dealt = sized.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = dealt.select("block", "part", "id", "label", "n", "tokens")
    px, py = (parts.select(F.col("block").alias(c), F.col("parts").alias(f"{c}parts")) for c in "xy")
    cells = cells.join(px, "x").join(py, "y")
    cells = cells.withColumn("xpart", F.explode(F.sequence(F.lit(0), F.col("xparts") - 1)))
    cells = cells.withColumn("ypart", F.explode(F.sequence(F.lit(0), F.col("yparts") - 1))).select("x", "y", "xpart", "ypart")
    cells = cells.filter("x <> y or xpart <= ypart")
    places = cells.select("*", F.col("x").alias("block"), F.col("xpart").alias("part")).union(cells.select("*", F.col("y").alias("block"), F.col("ypart").alias("part")))
    places = common.written(places.distinct(), "places")
    inside = places.join(dealt, ["block", "part"]).select("x", "y", "xpart", "ypart", "id", "label", "n", "tokens")
    return inside.groupBy("x", "y", "xpart", "ypart").applyInArrow(cell_links(percent), "a long, b long").distinct()


def could_link(percent: int, most: str = "n"):
    """Size and position filters of two postings x and y, which count only where a run of shared shingles starts. Of a
    block's posting n is its smallest size and `most` names its largest."""
    small, large = F.least(f"x.{most}", f"y.{most}"), F.greatest("x.n", "y.n")
    anew = ~F.coalesce(F.col("x.prev") == F.col("y.prev"), F.lit(False))
    room = 1 + F.least(F.col("x.n") - F.col("x.place") - 1, F.col("y.n") - F.col("y.place") - 1)
    return anew & (100 * small >= percent * large) & ((100 + percent) * room >= percent * (F.col("x.n") + F.col("y.n")))


def could_overlap(percent: int, every: str, some: str):
    """Can a set of x and a set of y share enough? `every` is the signature of what all sets of a side have, `some` of what
    any has: each bit of x's `every` that y's `some` lacks is a shingle of x, at least, that no set of y has."""

    def lacks(a: str, b: str):
        bits = [F.bit_count(F.col(f"{a}.{every}")[i].bitwiseAND(F.bitwise_not(F.col(f"{b}.{some}")[i]))) for i in range(SIGNATURE // 64)]
        return functools.reduce(lambda p, q: p + q, bits)

    most = F.least(F.col("x.shared") - lacks("x", "y"), F.col("y.shared") - lacks("y", "x"))
    return (100 + percent) * most >= percent * (F.col("x.n") + F.col("y.n"))


def of_groups(labels: DataFrame) -> DataFrame:
    """group, lo, hi (labels of its members), shared (shingles that a member shares with any document), every and some (signatures)."""
    words = range(SIGNATURE // 64)
    both = [f(F.col("sig")[i]).alias(f"{name}{i}") for name, f in (("every", F.bit_and), ("some", F.bit_or)) for i in words]
    found = labels.groupBy("group").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("shared").alias("shared"), *both)
    return found.select("group", "lo", "hi", "shared", *(F.array(*[F.col(f"{name}{i}") for i in words]).alias(name) for name in ("every", "some")))


def long_groups(labels: DataFrame) -> DataFrame:
    """group, load (shared shingles) of groups of few, long sets."""
    long = labels.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.sum("shared").alias("load"), F.min("shared").alias("least"))
    return long.filter((F.col("members") <= 4) & (F.col("least") >= SIGNATURE // 2) & (F.col("load") <= BLOCK_SHARED // 2)).select("group", "load")


def blocks(posts: DataFrame, long: DataFrame) -> DataFrame:
    """group, block (its smallest group) of long groups, by the first member (`lead`) that most of their lists have."""
    votes = posts.groupBy("group", "lead").agg(F.count(F.lit(1)).alias("votes"))
    leads = votes.groupBy("group").agg(F.max_by("lead", F.struct("votes", "lead")).alias("lead"))
    long = common.written(long.join(leads, "group").select("group", "lead", "load"), "long")
    chunks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("load") / BLOCK_SHARED))
    chunks = long.groupBy("lead").agg(chunks.alias("chunks"))
    long = long.join(chunks, "lead").select("group", "lead", F.pmod(F.xxhash64("group"), F.col("chunks")).alias("chunk"))
    names = long.groupBy("lead", "chunk").agg(F.min("group").alias("block"), F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    return common.written(long.join(names, ["lead", "chunk"]).select("group", "block"), "blocks")


def blocked(posts: DataFrame, deal: DataFrame) -> DataFrame:
    """Postings with those of a block's groups as one, that of any set which the block could have."""
    found = posts.join(deal, "group", "left")
    alone = found.filter("block is null").select("token", "group", "n", F.col("n").alias("n_most"), "place", "prev", "lo", "hi", "shared", "every", "some", F.lit(False).alias("block"))
    words = range(SIGNATURE // 64)
    signs = [f(F.col(name)[i]).alias(f"{name}{i}") for name, f in (("every", F.bit_and), ("some", F.bit_or)) for i in words]
    most = [F.min("n").alias("n"), F.max("n").alias("n_most"), (F.min("n") - F.max(F.col("n") - F.col("place"))).alias("place")]
    one = found.filter("block is not null").groupBy("token", "block").agg(*most, F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("shared").alias("shared"), *signs)
    arrays = [F.array(*[F.col(f"{name}{i}") for i in words]).alias(name) for name in ("every", "some")]
    one = one.select("token", F.col("block").alias("group"), "n", "n_most", "place", F.lit(None).cast("long").alias("prev"), "lo", "hi", "shared", *arrays, F.lit(True).alias("block"))
    return alone.union(one)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (id, group, label and what is known of the set) after new links (a, b) of labels. Only the labels that links
    join are worked on, so each link is used once and what is connected already stays contracted to one node.

    Links are written first: what finds them is a plan by itself, and the driver's memory follows its plans' size and number."""
    both = both_ways(links.filter("a <> b"))
    if both.isEmpty():
        return labels
    found = components_of(both).select(F.col("id").alias("label"), F.col("label").alias("new"))
    out = labels.join(found, "label", "left").select("id", "group", F.coalesce("new", "label").alias("label"), "n", "shared", "sig")
    return common.written(out, "labelled")


def ngram_join(docs: DataFrame, percent: int = 75, rounds: int = 2, bits: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id (the smallest id it reaches by links)."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(common.NO_ID)).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if bits is None:  # buckets follow the corpus
        chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
        bits = min(64 - KEY_BITS, max(4, (chars // BUCKET_CHARS).bit_length()))
    every = shared_sets(rows, percent, bits)
    live = every.filter("take > 0")

    # classes of equal sets, and groups of classes with identical prefixes and sizes
    classes = live.groupBy("digest").agg(F.min("doc_id").alias("id"))
    first = live.select("doc_id", "digest", F.col("n_shingles").alias("n"), "alone", "take", "tokens", "sig")
    first = first.join(classes, (first["doc_id"] == classes["id"]) & (first["digest"] == classes["digest"])).drop(classes["digest"])
    first = first.dropDuplicates(["id", "digest"]).select(F.col("id").alias("doc"), "digest", "n", "alone", "take", "tokens", "sig")
    # rows that repeat an id with different texts have different sets: a set is named by its row here
    sets = common.written(first.withColumn("id", F.monotonically_increasing_id()), "sets")
    prefix = F.sha2(F.concat_ws(",", F.transform(F.slice("tokens", 1, F.col("take").cast("int")), lambda t: t.cast("string")), F.col("n"), F.col("alone")), 256)
    named = sets.select("id", "n", (F.col("n") - F.col("alone")).alias("shared"), "sig", prefix.alias("prefix"))
    members = named.join(named.groupBy("prefix").agg(F.min("id").alias("group")), "prefix").select("id", "group", F.col("id").alias("label"), "n", "shared", "sig")
    members = common.written(members, "groups")
    heads = members.filter("id = group").select("group")
    # each posting also has the shingle before it in its prefix: two sets that share it met there already
    mine = F.slice("tokens", 1, F.col("take").cast("int"))
    shifted = F.concat(F.array(F.lit(None).cast("long")), F.slice("tokens", 1, (F.col("take") - 1).cast("int")))
    posts = sets.join(heads, F.col("id") == F.col("group")).select("group", "n", "alone", F.posexplode(F.arrays_zip(mine.alias("token"), shifted.alias("prev"))).alias("k", "t"))
    posts = posts.select("t.token", "group", "n", (F.col("alone") + F.col("k")).alias("place"), "t.prev").filter("token is not null")
    lists = posts.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi").select("token")
    posts = common.written(posts.join(lists, "token"), "postings")

    # within groups: members meet the group's head, the smallest of them, so those that it links have its label at once
    near = members.filter("id <> group").select(*[F.col(c).alias(x) for c, x in (("group", "a"), ("id", "b"), ("group", "la"), ("id", "lb"))])
    near = verified(near, sets, percent).select(F.col("b").alias("id"), F.col("a").alias("head"))
    labels = members.join(near, "id", "left").select("id", "group", F.coalesce("head", "label").alias("label"), "n", "shared", "sig")
    labels = common.written(labels, "labelled")
    by_token = Window.partitionBy("token")

    def unfinished(posts: DataFrame, labels: DataFrame) -> DataFrame:
        """Postings of lists whose members are not all connected, with what is known of their groups."""
        marked = posts.select("token", "group", "n", "place", "prev").join(of_groups(labels), "group")
        spread = marked.withColumn("_l", F.min("lo").over(by_token)).withColumn("_h", F.max("hi").over(by_token))
        return spread.filter("_l < _h").drop("_l", "_h")

    def expanded(groups: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of pairs of groups (x, y) that are not connected and could link, with their labels."""
        x, y = labels.alias("x"), labels.alias("y")
        met = groups.alias("g").join(x, F.col("g.x") == F.col("x.group")).join(y, F.col("g.y") == F.col("y.group"))
        met = met.filter((F.col("x.label") != F.col("y.label")) & could_overlap(percent, "sig", "sig"))
        return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.label").alias("la"), F.col("y.label").alias("lb"))

    apart = ~((F.col("x.lo") == F.col("x.hi")) & (F.col("x.hi") == F.col("y.lo")) & (F.col("y.lo") == F.col("y.hi")))
    possible = could_link(percent) & apart & could_overlap(percent, "every", "some")
    # rounds only connect cheaply: a group meets one pivot, the one that most of its lists have. The first is the
    # one with the least of its own, which most of its copies are near to; the others are drawn
    for i in range(rounds):
        posts = unfinished(posts, labels)
        own = (F.col("n") - F.col("shared")) / F.col("n") if i == 0 else F.lit(0.0)
        one = F.struct(*posts.columns)
        first = F.min(F.struct(own.alias("own"), F.xxhash64("group", F.lit(i)).alias("draw"), *posts.drop("token").columns)).over(by_token)
        posts = common.written(posts.select("token", "group", "n", "place", "prev", one.alias("x"), first.alias("y")), "unfinished")
        met = posts.filter((F.col("x.group") != F.col("y.group")) & possible)
        votes = met.groupBy(F.col("x.group").alias("x"), F.col("y.group").alias("y")).agg(F.count(F.lit(1)).alias("votes"))
        groups = common.written(votes.groupBy("x").agg(F.max_by("y", F.struct("votes", "y")).alias("y")), "partners")
        labels = merged(labels, verified(expanded(groups, labels), sets, percent))

    # the rest: all pairs that are not connected yet and could link. Groups of long sets go by blocks. In each list, those of
    # the commonest label meet only the others, so a large connected group makes no pairs with itself.
    lead = F.min(F.struct(F.xxhash64("group", F.lit(rounds)), "group")).over(by_token)["group"]
    posts = unfinished(posts, labels)
    long = long_groups(labels)
    dealt = not long.isEmpty()
    if dealt:
        posts = common.written(posts.withColumn("lead", lead), "unfinished")
        deal = blocks(posts, long)
        posts = blocked(posts.drop("lead"), deal)
    else:
        posts = posts.withColumns({"n_most": F.col("n"), "block": F.lit(False)})
    posts = posts.withColumn("c", F.count(F.when(F.col("lo") == F.col("hi"), 1)).over(Window.partitionBy("token", "lo")))
    top = F.max(F.when(F.col("lo") == F.col("hi"), F.struct("c", "lo"))).over(by_token)
    posts = common.written(posts.withColumn("top", top["lo"]).drop("c"), "unfinished")
    of_top = (F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("top"))
    few = posts.filter(~F.coalesce(of_top, F.lit(False))).alias("x")
    all_ = posts.withColumn("is_top", F.coalesce(of_top, F.lit(False))).alias("y")
    once = F.col("y.is_top") | (F.col("x.group") < F.col("y.group"))
    possible = could_link(percent, "n_most") & apart & could_overlap(percent, "every", "some")
    met = few.join(all_, F.col("x.token") == F.col("y.token")).filter(once & possible)
    met = met.select(F.col("x.group").alias("x"), F.col("y.group").alias("y"), (F.col("x.block") | F.col("y.block")).alias("block")).distinct()
    mixed = labels.groupBy("group").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l < h").select("group")
    met = common.written(met, "met")
    if dealt:
        mixed = mixed.join(deal, "group", "left_anti")
    mixed = mixed.select(F.col("group").alias("x"), F.col("group").alias("y"))
    links = common.written(verified(expanded(met.filter("not block").select("x", "y").union(mixed), labels), sets, percent), "rest")
    if dealt:
        own = labels.join(deal, "group").groupBy("block").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l < h")
        own = own.select(F.col("block").alias("x"), F.col("block").alias("y"))
        inside = labels.join(deal, "group", "left").select(F.coalesce("block", "group").alias("block"), "id", "label")
        cells = common.written(met.filter("block").select("x", "y").union(own), "cells")
        inside = inside.join(cells.select(F.explode(F.array("x", "y")).alias("block")).distinct(), "block", "left_semi")
        links = links.union(cells_verified(cells, inside, sets, percent))
    labels = merged(labels, links)

    # labels back to documents: the class's smallest id, then the component's
    names = sets.select("id", "digest", "doc")
    label = labels.select("id", "label").join(names, "id")
    smallest = label.groupBy("label").agg(F.min("doc").alias("component"))
    label = label.join(smallest, "label").select("digest", "component")
    out = every.join(label, "digest", "left")
    own = F.when(F.col("take") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    named = lambda c: F.nullif(c, F.lit(common.NO_ID))
    return out.select(named(F.col("doc_id")).alias("doc_id"), "n_shingles", named(own).alias("component_id"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(common.documents(spark, sf_dir))

