"""Near copies by order MinHash, verified by banded alignment.

A text is its words, without case and punctuation. Each of SKETCHES hash functions picks the two
five-word shingles with the smallest hashes (a shingle that comes again is another one) and keeps
them in the order of the text, so that a sketch agrees where shingles and their order agree. Texts
with an equal sketch share a bucket. In each bucket the text that shares most buckets is the centre
and all others are aligned with it, not with one another; what is linked forms components; texts of
different components that still agree in enough sketches are found blockwise and aligned as well,
all of them until their components are joined.

Two texts are linked if their word edit distance is at most a fifth of the longer one. Texts whose
shingle similarity is 0.8 meet with a probability above 1 - 1e-17, at 0.4 it is 0.999.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.components import connected
from quillsift.llm.staging import boxed, full_text, staged, unboxed

SHINGLE = 5
SKETCHES = 40
SIMILARITY = 0.8
#: A pair of shingle similarity 0.8 agrees in 25.6 of 40 sketches on average, and in fewer than 8
#: with a probability of 2e-9; that counts only for pairs without a link to a common centre.
MIN_AGREEING = 8
BLOCK = 1_024
#: Words of a block's texts, which are compared where they meet.
BLOCK_WORDS = 1_000_000
CHUNK = 16_384
WORDS_KEPT = 300_000
STEP = 32

_WORD = re.compile(r"\w+")
_MIX = np.random.Generator(np.random.PCG64(20240501)).integers(
    1, 1 << 63, size=(2, SKETCHES), dtype=np.uint64
) | np.uint64(1)
_PLACES = np.random.Generator(np.random.PCG64(77)).integers(
    1, 1 << 63, size=SHINGLE + 2, dtype=np.uint64
) | np.uint64(1)
_LAST = np.uint64(np.iinfo(np.uint64).max)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        self[word] = value
        return value


_HASHES = _WordHashes()


def word_hashes(text: str) -> np.ndarray:
    words = _WORD.findall(text.lower())
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _PLACES[SHINGLE]
    return x ^ (x >> np.uint64(29))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles, the second and later ones of a kind told apart; fewer
    words than five are one shingle."""
    width = min(SHINGLE, len(words))
    if not width:
        return np.zeros(0, dtype=np.uint64)
    n = len(words) - width + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out += words[i : i + n] * _PLACES[i]
    out = _mixed(out)
    order = np.argsort(out, kind="stable")
    same = out[order][1:] == out[order][:-1]
    if same.any():
        fresh = np.r_[True, ~same]
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        often = np.empty(n, dtype=np.uint64)
        often[order] = (np.arange(n) - first).astype(np.uint64)
        out = np.where(often > 0, _mixed(out + often * _PLACES[SHINGLE + 1]), out)
    return out


def sketch(marks: np.ndarray) -> np.ndarray:
    """For each hash function a number made of its two smallest shingles in text order."""
    best = np.full((SKETCHES, 2), _LAST, dtype=np.uint64)
    at = np.zeros((SKETCHES, 2), dtype=np.int64)
    rows = np.arange(SKETCHES)
    for first in range(0, len(marks), CHUNK):
        part = marks[first : first + CHUNK]
        values = (part[None, :] ^ _MIX[0][:, None]) * _MIX[1][:, None]
        values ^= values >> np.uint64(32)
        for _ in range(min(2, len(part))):
            i = values.argmin(axis=1)
            v = values[rows, i]
            better = v < best[:, 1]
            best[better, 1], at[better, 1] = v[better], i[better] + first
            swap = best[:, 1] < best[:, 0]
            best[swap], at[swap] = best[swap, ::-1], at[swap, ::-1]
            values[rows, i] = _LAST
    if len(marks) == 1:
        at[:, 1] = 0
    low, high = marks[at.min(axis=1)], marks[at.max(axis=1)]
    return _mixed(low * _PLACES[0] + high * _PLACES[1] + rows.astype(np.uint64) * _PLACES[2])


SIGNED = "doc_id LONG, text_key BINARY, words_key BINARY, n_words INT, sketch ARRAY<LONG>"


def _words_key(text: str, words: np.ndarray) -> bytes:
    """Equal for texts of the same words; without words, for texts of the same other signs."""
    signs = b"" if len(words) else "".join(text.split()).encode("utf-8", "surrogatepass")
    person = b"no words" if signs else b""
    return hashlib.blake2b(signs or words.tobytes(), digest_size=16, person=person).digest()


def _signature_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 1_000):
            part = batch.slice(first, 1_000)
            keys, sizes, sketches = [], [], []
            for text in part.column(2).to_pylist():
                words = word_hashes(text)
                keys.append(_words_key(text, words))
                sizes.append(len(words))
                sketches.append(sketch(shingles(words)).view(np.int64) if len(words) else None)
            yield pa.record_batch(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "words_key", "n_words", "sketch"],
            )


def distance_within(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether the edit distance of two sequences is at most ``limit``.

    Furthest-reaching points on the diagonals of the band, all diagonals in step.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return False
    if not n or not m:
        return max(n, m) <= limit
    if max(n, m) - _shared(a, b) > limit:
        return False
    goal = m - n
    pad = STEP + 1
    a = np.concatenate([a, np.full(pad + limit + m, 1, dtype=np.uint64)])
    b = np.concatenate([b, np.full(pad + limit + n, 2, dtype=np.uint64)])
    steps = np.arange(STEP)
    # reach[d + limit + 1]: how many words of a are used on diagonal d (words of b less those of a)
    reach = np.full(2 * limit + 3, -(1 << 30), dtype=np.int64)
    for edits in range(limit + 1):
        d = np.arange(-edits, edits + 1)
        d = d[(d >= -n) & (d <= m)]
        k = d + limit + 1
        if edits == 0:
            x = np.zeros(1, dtype=np.int64)
        else:
            x = np.maximum(np.maximum(reach[k] + 1, reach[k + 1] + 1), reach[k - 1])
        x = np.minimum(np.minimum(x, n), m - d)
        going = np.flatnonzero((x >= 0) & (x + d >= 0))
        while len(going):
            at = x[going][:, None] + steps
            same = a[at] == b[at + d[going][:, None]]
            run = np.where(same.all(axis=1), STEP, same.argmin(axis=1))
            x[going] += run
            going = going[run == STEP]
        reach[k] = x
        if reach[goal + limit + 1] >= n:
            return True
    return False


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Words in common, counted as often as both have them."""
    u, n = np.unique(a, return_counts=True)
    v, m = np.unique(b, return_counts=True)
    both, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    return distance_within(a, b, int(_limit(max(len(a), len(b)))))


def _limit(size: np.ndarray | int) -> np.ndarray:
    """Edits that two texts may differ in, of which the longer one has ``size`` words."""
    return np.floor((1 - SIMILARITY) * np.asarray(size) + 1e-9).astype(np.int64)


def _aligned_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text_a, text_b) that are alike."""
    known: tuple[int, np.ndarray] = (-1, np.zeros(0, dtype=np.uint64))
    for batch in batches:
        left, right = [], []
        for a, b, text_a, text_b in zip(*(batch.column(i) for i in range(4)), strict=True):
            a, b = a.as_py(), b.as_py()
            if known[0] != a:
                known = (a, word_hashes(text_a.as_py()))
            if alike(known[1], word_hashes(text_b.as_py())):
                left.append(a)
                right.append(b)
        yield pa.record_batch(
            [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
        )


def _verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """Links among candidate ``pairs`` (a, b) of nodes."""
    pairs = staged(spark, pairs.distinct(), "near-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = texts.join(nodes, "node").select("node", "doc_id", "text_key")
    bodies = docs.select("doc_id", _text_key().alias("text_key"), full_text().alias("text"))
    found = named.join(
        bodies,
        named.doc_id.eqNullSafe(bodies.doc_id) & (named.text_key == bodies.text_key),
    ).select("node", "text")
    found = staged(spark, found, "near-texts")
    right = found.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    left = found.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    links = both.mapInArrow(_aligned_rows, "a LONG, b LONG").distinct()
    return staged(spark, links, "near-links")


def _text_key():
    return F.unhex(F.md5(F.encode(full_text(), "UTF-8")))


def _word_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 1_000):
            part = batch.slice(first, 1_000)
            words = [word_hashes(t).tobytes() for t in part.column(1).to_pylist()]
            yield pa.record_batch(
                [part.column(0), pa.array(words, pa.binary())], names=["node", "words"]
            )


class _Bags:
    """How many words texts have in common, for one text and many others at a time."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        flat = np.concatenate(texts)
        self.sizes = np.array([len(t) for t in texts])
        self.ends = np.cumsum(self.sizes)
        kinds, self.ids = np.unique(flat, return_inverse=True)
        # Which time in its text a word comes: the first is 0.
        owner = np.repeat(np.arange(len(texts)), self.sizes)
        order = np.lexsort((self.ids, owner))
        ids, owner = self.ids[order], owner[order]
        fresh = np.r_[True, (ids[1:] != ids[:-1]) | (owner[1:] != owner[:-1])]
        at = np.arange(len(flat))
        self.times = np.empty(len(flat), dtype=np.int64)
        self.times[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
        self.have = np.zeros(len(kinds), dtype=np.int64)

    def shared(self, i: int, others: np.ndarray) -> np.ndarray:
        own = self.ids[self.ends[i] - self.sizes[i] : self.ends[i]]
        np.add.at(self.have, own, 1)
        sizes = self.sizes[others]
        starts = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.ends[others] - sizes - starts, sizes)
        hits = self.times[at] < self.have[self.ids[at]]
        self.have[own] = 0
        return np.add.reduceat(hits.astype(np.int64), starts)


def _linked(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Of two blocks of a bucket: links between components, enough to join all that any pair of
    texts joins which agrees in MIN_AGREEING sketches and is alike.

    Every such pair is tried until its components are joined; bounds on the distance spare the
    alignment of pairs that cannot be alike.
    """
    bucket, left, right = (k.as_py() for k in key)
    block = rows["block"].to_numpy()
    nodes = rows["node"].to_numpy()
    kinds, comps = np.unique(rows["component"].to_numpy(), return_inverse=True)
    root = np.arange(len(kinds))
    flat = rows["sketch"].combine_chunks().flatten().to_numpy()
    sketches = flat.reshape(-1, SKETCHES)
    words = [np.frombuffer(w, dtype=np.uint64) for w in rows["words"].to_pylist()]
    bags = _Bags(words)
    places = np.arange(SKETCHES)
    theirs = np.flatnonzero(block == right)
    a, b = [], []
    for i in np.flatnonzero(block == left).tolist():
        j = theirs[root[comps[theirs]] != root[comps[i]]]
        if left == right:
            j = j[nodes[j] > nodes[i]]
        limits = _limit(np.maximum(bags.sizes[j], bags.sizes[i]))
        j = j[np.abs(bags.sizes[j] - bags.sizes[i]) <= limits]
        same = sketches[j] == sketches[i]
        agree = same.sum(axis=1)
        enough = agree >= MIN_AGREEING
        j, same, agree = j[enough], same[enough], agree[enough]
        # Two texts share many buckets; they are compared in one of them, which depends on both.
        turn = (nodes[j] ^ nodes[i]) % SKETCHES
        chosen = np.where(same, (places - turn[:, None]) % SKETCHES, SKETCHES).argmin(axis=1)
        own = chosen == (sketches[i] == bucket).argmax()
        j, agree = j[own], agree[own]
        if not len(j):
            continue
        longer = np.maximum(bags.sizes[j], bags.sizes[i])
        near = longer - bags.shared(i, j) <= _limit(longer)
        j, agree = j[near], agree[near]
        for k in j[np.argsort(-agree, kind="stable")].tolist():
            here, there = root[comps[i]], root[comps[k]]
            if here != there and alike(words[i], words[k]):
                a.append(int(nodes[i]))
                b.append(int(nodes[k]))
                root[root == there] = here
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _mixed_keys(placed: DataFrame) -> DataFrame:
    """The keys of ``placed`` (key, node, component, n_words) whose texts are in more than one
    component, and into how many blocks their texts are dealt."""
    size = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_words") / BLOCK_WORDS)
    return (
        placed.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.ceil(size).cast("int").alias("blocks"),
        )
        .where("low <> high")
        .select("key", "blocks")
    )


def _rest_links(
    spark: SparkSession, buckets: DataFrame, texts: DataFrame, parts: DataFrame, docs: DataFrame
) -> DataFrame:
    """Links (a, b) across components among texts that agree in MIN_AGREEING sketches or more."""
    placed = (
        buckets.join(parts, "node", "left")
        .join(texts.select("node", "n_words"), "node")
        .select("key", "node", F.coalesce("component", "node").alias("component"), "n_words")
    )
    # A key whose texts are all in one component has nothing left to compare, and a text in fewer
    # than MIN_AGREEING other keys agrees with no text of another component in so many.
    members = placed.join(_mixed_keys(placed).select("key"), "key")
    busy = members.groupBy("node").agg(F.count(F.lit(1)).alias("keys"))
    busy = busy.where(F.col("keys") >= MIN_AGREEING).select("node")
    members = staged(spark, members.join(busy, "node"), "near-mixed")

    named = texts.join(members.select("node").distinct(), "node")
    bodies = docs.select("doc_id", _text_key().alias("text_key"), full_text().alias("text"))
    words = named.select("node", "doc_id", "text_key").join(
        bodies,
        named.doc_id.eqNullSafe(bodies.doc_id) & (named.text_key == bodies.text_key),
    )
    words = words.select("node", "text").mapInArrow(_word_rows, "node LONG, words BINARY")
    words = words.dropDuplicates(["node"]).join(named.select("node", "sketch"), "node")
    words = staged(spark, words, "near-words")

    dealt = members.join(_mixed_keys(members), "key").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    sides = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(
            F.least(o, F.col("block")).alias("left"), F.greatest(o, F.col("block")).alias("right")
        ),
    )
    spread = dealt.withColumn("side", F.explode(sides)).join(words, "node")
    return (
        spread.select(
            "key", "side.left", "side.right", "node", "component", "block", "sketch", "words"
        )
        .groupBy("key", "left", "right")
        .applyInArrow(_linked, "a LONG, b LONG")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )


def near_classes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with class_id, the smallest doc_id of its class, and
    ``kept``, true for the rows with that id and the class's first text.

    Texts of the same words are one class whatever their case and punctuation; texts without words
    are one class if they are equal but for white space, null and blank ones among them. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = docs.select("doc_id", _text_key().alias("text_key"), full_text().alias("text"))
    signed = staged(spark, signed.mapInArrow(_signature_rows, SIGNED), "signatures")
    texts = signed.groupBy("words_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("at"),
        F.first("n_words").alias("n_words"),
        F.first("sketch").alias("sketch"),
    )
    texts = texts.select(
        F.monotonically_increasing_id().alias("node"),
        "words_key",
        "at.doc_id",
        "at.text_key",
        "n_words",
        "sketch",
    )
    texts = staged(spark, texts, "texts")

    buckets = texts.where("n_words > 0").select("node", F.explode("sketch").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = staged(spark, buckets.join(shared, "key"), "buckets")
    weights = buckets.groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = buckets.join(weights, "node")
    centres = weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("c"))
    stars = (
        weighed.join(centres.select("key", F.col("c.node").alias("a")), "key")
        .where("node <> a")
        .select("a", F.col("node").alias("b"))
    )
    links = _verified(spark, stars, texts, docs)
    parts = staged(spark, connected(spark, links), "near-parts")
    more = staged(spark, _rest_links(spark, buckets, texts, parts, docs).distinct(), "near-rest")
    if more.count():
        parts = staged(spark, connected(spark, links.unionByName(more)), "near-parts")

    members = texts.join(parts, "node", "left").select(
        "words_key", "doc_id", "text_key", F.coalesce("component", "node").alias("component")
    )
    heads = members.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("head")
    )
    classes = members.select("words_key", "component").join(heads, "component")
    rows = signed.select("doc_id", "text_key", "words_key").join(classes, "words_key")
    return rows.select(
        "doc_id",
        F.col("head.doc_id").alias("class_id"),
        (
            F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
            & (F.col("text_key") == F.col("head.text_key"))
        ).alias("kept"),
        "text_key",
    )


def _row_key():
    """One key for the id and the whole text of a row."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex("text_key")))


def drop_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each class of near copies of ``docs``, in its own columns, whatever their names."""
    kept = near_classes(spark, docs).where("kept").select(_row_key().alias("row_key")).distinct()
    rows = boxed(docs).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("text_key", _text_key()).select("row", _row_key().alias("row_key"))
    # Rows with the same id and text are one document that came twice.
    return unboxed(rows.join(kept, "row_key").dropDuplicates(["row_key"]), docs.columns)
