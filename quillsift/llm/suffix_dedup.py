"""Repeated byte strings found with suffix arrays and removed.

A string of ``span`` bytes that starts at two places is covered by the same anchor at both: the
smallest of the short-gram hashes inside it. So texts are cut into segments, one per anchor, that
hold all windows of ``span`` bytes of the anchor; only anchors that occur twice can hold repeats, and equal segments
are all repeats. Different segments of an anchor meet in a shard, which sorts their suffixes by
Larsson-Sadakane refinement and measures neighbours' common prefixes by Kasai's method. The segments
of a very frequent anchor are spread over many shards, which are merged by a binary search over the
places of its windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.staging import boxed, full_text, staged, with_new_text
from quillsift.operators.joins import splittable

#: Bytes of a repeat, unless a caller says otherwise; a span must be longer than a gram.
SPAN = 400
#: What the corpus pipeline cuts: shorter than any 50 words of prose, whose mean word has four
#: letters or more, so that a repeated passage of over 50 words is found wherever it begins.
PASSAGE = 256
GRAM = 32
#: Bytes of segments per shard, and segments of one anchor from which it gets shards of its own.
SHARD_BYTES = 2_000_000
ANCHOR_SEGMENTS = 2_048
#: Texts are hashed in stretches of so many windows, which keeps the arrays small.
STRETCH = 1 << 19
PLACE_BITS = 20
PLACES = np.uint64((1 << PLACE_BITS) - 1)
#: Never part of UTF-8, so that no repeat crosses from one segment to the next.
SEPARATOR = b"\xff"

_ODD = [
    np.uint64(x)
    for x in (
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0xD6E8FEB86659FD93,
        0xA0761D6478BD642F,
    )
]


def words_at(data: bytes) -> np.ndarray:
    """The eight bytes from each place on as a little-endian number, zeros after the end."""
    padded = data + bytes(16)
    out = np.empty(len(data) + 8, dtype="<u8")
    for shift in range(8):
        part = out[shift::8]
        part[:] = np.frombuffer(padded, dtype="<u8", count=len(part), offset=shift)
    return out[: len(data)]


def gram_hashes(words: np.ndarray) -> np.ndarray:
    n = len(words) - GRAM + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(4):
        h += words[8 * i : 8 * i + n] * _ODD[i]
        h ^= h >> np.uint64(31)
    h *= _ODD[4]
    h ^= h >> np.uint64(29)
    return h


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each ``width`` neighbours, from cumulated minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: bytes, span: int = SPAN) -> list[tuple[int, int, int, int]]:
    """(hash, first window, last window, place) for each anchor of a text of ``span`` bytes or more.

    The anchor of a window is the last of its least gram hashes, which depends on its bytes alone.
    """
    found: list[tuple[int, int, int, int]] = []
    last, width = len(data) - span, span - GRAM + 1
    for first in range(0, last + 1, STRETCH):
        windows = min(STRETCH, last + 1 - first)
        hashes = gram_hashes(words_at(data[first : first + windows - 1 + span]))
        place = PLACES - np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_least((hashes & ~PLACES) | place, width)
        at = (PLACES - (least & PLACES)).astype(np.int64)
        starts = np.r_[0, np.flatnonzero(np.diff(at)) + 1]
        ends = np.r_[starts[1:], windows] - 1
        values = hashes[at[starts]].view(np.int64)
        columns = (values, starts + first, ends + first, at[starts] + first)
        found += zip(*(c.tolist() for c in columns), strict=True)
    return found


def _segment_rows(span: int):
    names = ["text_key", "anchor", "segment", "first", "last", "place"]
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                columns: list[list] = [[] for _ in names]
                part = batch.slice(at, 256)
                for key, text in zip(part.column(0), part.column(1), strict=True):
                    data, key = text.as_py(), key.as_py()
                    for value, first, last, place in anchors(data, span):
                        body = data[first : last + span]
                        digest = hashlib.blake2b(body, digest_size=16).digest()
                        row = (key, value, digest, first, last, place)
                        for column, x in zip(columns, row, strict=True):
                            column.append(x)
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    return run


def suffix_array(words: np.ndarray) -> np.ndarray:
    """All suffixes of a text in order.

    Larsson-Sadakane: suffixes sorted by h bytes are sorted by 2 h bytes through the ranks of the
    suffixes h places on; groups of one are settled and not touched again.
    """
    n = len(words)
    keys = words.byteswap()
    order = np.argsort(keys, kind="stable").astype(np.int64)
    ranks = _group_ranks(keys[order], np.arange(n, dtype=np.int64))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = ranks
    slots = _unsettled(ranks, np.arange(n, dtype=np.int64))
    h = 8
    while len(slots):
        members = order[slots]
        ahead = members + h
        next_rank = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        keys = (rank[members] << np.int64(31)) | next_rank
        turn = np.argsort(keys, kind="stable")
        members = members[turn]
        order[slots] = members
        ranks = _group_ranks(keys[turn], slots)
        rank[members] = ranks
        slots = _unsettled(ranks, slots)
        h *= 2
    return order


def _group_ranks(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For sorted keys in these slots: the slot of the first of each run of equal keys."""
    fresh = np.r_[True, keys[1:] != keys[:-1]]
    return slots[np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))]


def _unsettled(ranks: np.ndarray, slots: np.ndarray) -> np.ndarray:
    if len(ranks) < 2:
        return slots[:0]
    same = ranks[1:] == ranks[:-1]
    return slots[np.r_[same, False] | np.r_[False, same]]


def common_prefixes(
    words: np.ndarray, order: np.ndarray, starts: np.ndarray, counts: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each place in runs of ``counts`` places from ``starts``: the suffix before it in the
    order, and the common prefix with it, up to ``depth``.

    Kasai's method, all runs in step: from one place to the next the prefix loses one byte at most,
    so comparison goes on where it ended.
    """
    n = len(words)
    slot = np.empty(n, dtype=np.int64)
    slot[order] = np.arange(n)
    before = np.full(n, -1, dtype=np.int64)
    length = np.zeros(n, dtype=np.int64)
    padded = np.concatenate([words, np.zeros(depth + 8, dtype=words.dtype)])
    carried = np.zeros(len(starts), dtype=np.int64)
    for step in range(int(counts.max(initial=0))):
        runs = np.flatnonzero(counts > step)
        here = starts[runs] + step
        there = np.where(slot[here] > 0, order[slot[here] - 1], -1)
        known = np.maximum(carried[runs] - 1, 0)
        known[there < 0] = 0
        going = np.flatnonzero((there >= 0) & (known < depth))
        while len(going):
            a, b = here[going] + known[going], there[going] + known[going]
            unlike = padded[a] ^ padded[b]
            same = unlike == 0
            known[going[same]] += 8
            low = unlike[~same]
            low = (low & (~low + np.uint64(1))).astype(np.float64)
            known[going[~same]] += (np.log2(low).astype(np.int64)) // 8
            going = going[same]
            going = going[known[going] < depth]
        known = np.minimum(known, depth)
        before[here], length[here], carried[runs] = there, known, known
    return before, length


class SegmentShard:
    """The segments of a shard: which of their windows occur twice in it."""

    def __init__(self, segments: list[bytes], span: int = SPAN):
        self.span = span
        sizes = np.array([len(s) for s in segments], dtype=np.int64)
        self.counts = sizes - span + 1
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.text = SEPARATOR.join(segments) + SEPARATOR
        words = words_at(self.text)
        order = suffix_array(words)
        before, length = common_prefixes(words, order, self.starts, self.counts, span)
        twice = np.flatnonzero(length >= span)
        self.repeated = np.zeros(len(words), dtype=bool)
        self.repeated[twice] = True
        self.repeated[before[twice]] = True

    def windows(self, k: int) -> slice:
        return slice(int(self.starts[k]), int(self.starts[k] + self.counts[k]))


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


FOUND = "anchor LONG, segment BINARY, a INT, b INT"


def _search_shard(span: int):
    def run(rows: pa.Table) -> pa.Table:
        """Repeated runs of windows of each segment of a shard."""
        # A segment may have come by several ways; it must not meet itself.
        rows = rows.group_by(["anchor", "segment"]).aggregate([("body", "min")])
        rows = rows.sort_by([("anchor", "ascending"), ("segment", "ascending")])
        shard = SegmentShard(rows["body_min"].to_pylist(), span)
        columns: list[list] = [[], [], [], []]
        keys = zip(rows["anchor"].to_pylist(), rows["segment"].to_pylist(), strict=True)
        for k, (anchor, segment) in enumerate(keys):
            for found in runs_of(shard.repeated[shard.windows(k)]):
                for column, x in zip(columns, (anchor, segment, *found), strict=True):
                    column.append(x)
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        return pa.table(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["anchor", "segment", "a", "b"],
        )

    return run


def _text_key() -> Column:
    return F.unhex(F.md5("body"))


def repeated_spans(spark: SparkSession, docs: DataFrame, span: int = SPAN) -> DataFrame:
    """The repeated byte ranges of each different text of ``docs``: text_key, spans (from, to)."""
    if span <= GRAM:
        raise ValueError(f"a span needs more than {GRAM} bytes")
    bodies = docs.select(F.encode(full_text(), "UTF-8").alias("body"))
    bodies = bodies.where(F.octet_length("body") >= span).select(
        _text_key().alias("text_key"), "body"
    )
    rows = staged(
        spark,
        bodies.mapInArrow(
            _segment_rows(span),
            "text_key BINARY, anchor LONG, segment BINARY, first INT, last INT, place INT",
        ),
        "segments",
    )
    often = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often = splittable(often.select("anchor"))
    rows = staged(spark, rows.join(often, "anchor"), "repeated-anchors")

    kinds = rows.groupBy("anchor", "segment").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("text_key", "first", "last", "place")).alias("at"),
    )
    kinds = staged(spark, kinds, "segment-kinds")
    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    searched = kinds.join(splittable(mixed), "anchor").select("anchor", "segment", "kinds", "at.*")
    found = _searched(spark, searched, bodies, span)

    whole = kinds.where("copies > 1").select(
        "anchor",
        "segment",
        F.lit(0).alias("a"),
        (F.col("at.last") - F.col("at.first")).alias("b"),
    )
    windows = whole.unionByName(found)
    # One row for each different text and segment: copies of a text share their spans.
    placed = rows.select("text_key", "anchor", "segment", "first").distinct()
    return (
        placed.join(windows, ["anchor", "segment"])
        .groupBy("text_key")
        .agg(
            F.collect_set(
                F.struct(
                    (F.col("first") + F.col("a")).alias("a"),
                    (F.col("first") + F.col("b") + span).alias("b"),
                )
            ).alias("spans")
        )
    )


def _searched(
    spark: SparkSession, searched: DataFrame, bodies: DataFrame, span: int
) -> DataFrame:
    """Repeated runs of windows of segments whose anchor has several different segments."""
    width = F.col("last") - F.col("first")
    cuts = searched.join(bodies, "text_key").select(
        "anchor",
        "segment",
        "kinds",
        F.substring(F.col("body"), F.col("first") + 1, width + span).alias("body"),
        (F.col("place") - F.col("first")).alias("at"),
        width.alias("width"),
    )
    # A text that came several times gives each of its segments several times.
    cuts = staged(spark, cuts.dropDuplicates(["anchor", "segment"]), "segment-texts")
    sizes = cuts.groupBy((F.col("kinds") > ANCHOR_SEGMENTS).alias("hot")).agg(
        F.sum("width").alias("width"), F.count(F.lit(1)).alias("n")
    )
    size = {r.hot: r.width + r.n * (span + 1) for r in sizes.collect()}
    cold = cuts.where(F.col("kinds") <= ANCHOR_SEGMENTS).select(
        "anchor", "segment", "body", _shard(F.xxhash64("anchor"), size.get(False, 0)).alias("shard")
    )
    if True not in size:
        return cold.groupBy("shard").applyInArrow(_search_shard(span), FOUND)
    hot = cuts.where(F.col("kinds") > ANCHOR_SEGMENTS)
    groups, known = _bisected(spark, hot, span)
    dealt = groups.join(hot.select("anchor", "segment", "body"), ["anchor", "segment"]).select(
        "anchor",
        "segment",
        "body",
        (-1 - _shard(F.xxhash64("core"), 2 * size[True])).alias("shard"),
    )
    found = cold.unionByName(dealt).groupBy("shard").applyInArrow(_search_shard(span), FOUND)
    return found.unionByName(known)


def _shard(value: Column, size: int) -> Column:
    return F.pmod(value, F.lit(max(1, -(-int(size) // SHARD_BYTES))))


def _bisected(spark: SparkSession, hot: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """Groups of segments of very frequent anchors that may share windows, and runs known to.

    Shards of such an anchor are merged by binary search over the places of its windows. Segments
    that share a window of a range of places share the bytes common to all windows of the range
    (its core). Ranges start whole; a group that shares a core and is still too large is halved.
    Before that, segments that agree in all windows of the range are repeats as a whole, and one of
    them stands for all. So each step costs a row or two per segment, not one per window.
    """
    state = hot.select("anchor", "segment", F.lit(0).alias("lo"), F.lit(span - GRAM).alias("hi"))
    groups, known = [], []
    low = F.greatest("lo", F.col("at") - F.col("width"))
    high = F.least("hi", "at")
    for _ in range((span - GRAM).bit_length() + 1):
        rows = state.join(hot.drop("kinds"), ["anchor", "segment"])
        rows = rows.withColumns({"from": low, "to": high}).where(F.col("from") <= F.col("to"))
        rows = rows.select(
            "anchor",
            "segment",
            "lo",
            "hi",
            (F.col("at") - F.col("to")).alias("a"),
            (F.col("at") - F.col("from")).alias("b"),
            _piece(
                "lo", "hi", F.col("at") - F.col("lo"), F.col("at") - F.col("hi"), span
            ).alias("core"),
            _piece(
                "from", "to", F.col("at") - F.col("to"), F.col("at") - F.col("from"), span
            ).alias("hull"),
        )
        rows = staged(spark, rows, "bisected")
        own = ["anchor", "lo", "hi", "core"]
        sizes = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sized = rows.join(splittable(sizes), own)
        groups.append(sized.where(F.col("n") <= ANCHOR_SEGMENTS).select(*own[:1], "segment", "core"))
        large = sized.where(F.col("n") > ANCHOR_SEGMENTS)
        alike = large.groupBy(*own, "hull").agg(
            F.count(F.lit(1)).alias("same"), F.min("segment").alias("one")
        )
        large = staged(spark, large.join(splittable(alike), [*own, "hull"]), "bisected-large")
        if not large.head(1):
            break
        known.append(large.where("same > 1").select("anchor", "segment", "a", "b"))
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(
            F.struct(F.col("lo").alias("lo"), middle.alias("hi")),
            F.struct((middle + 1).alias("lo"), F.col("hi").alias("hi")),
        )
        state = (
            large.where((F.col("segment") == F.col("one")) & (F.col("lo") < F.col("hi")))
            .select("anchor", "segment", F.explode(halves).alias("half"))
            .select("anchor", "segment", "half.*")
        )
    empty = hot.select("anchor", "segment", F.col("at").alias("a"), F.col("at").alias("b")).limit(0)
    return _union(groups), _union([empty, *known])


def _piece(low: str, high: str, start: Column, end: Column, span: int) -> Column:
    """A digest of ``body`` from window ``start`` to the end of window ``end``."""
    body = F.substring(F.col("body"), start + 1, end - start + span)
    return F.unhex(F.md5(F.concat(F.encode(F.concat_ws("|", low, high, F.lit("")), "UTF-8"), body)))


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _cut(data: bytes, spans) -> tuple[list[bytes], int, int]:
    """What is left of ``data``, removed bytes, and removed runs after joining what touches."""
    kept, at, removed, runs = [], 0, 0, 0
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if runs and a <= at:
            removed += max(0, b - at)
            at = max(at, b)
            continue
        kept.append(data[at:a])
        removed, runs, at = removed + b - a, runs + 1, b
    kept.append(data[at:])
    return kept, removed, runs


def _remove(bodies: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for data, found in zip(bodies, spans, strict=True):
        if found is None or not len(found):
            rows.append((data, None, 0, 0))
            continue
        kept, removed, runs = _cut(data, found)
        # Characters of which a byte is gone are dropped from the text.
        text = "".join(part.decode("utf-8", "ignore") for part in kept)
        rows.append((b"".join(kept), text, removed, runs))
    return pd.DataFrame(rows, columns=["kept", "text", "removed", "runs"])


def with_rest(spark: SparkSession, docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Each row of ``docs`` as a struct ``row``, its text as bytes in ``body``, and ``rest``, a
    struct of kept BINARY, text (null if nothing was removed), removed LONG and runs LONG.

    Null texts count as empty. Texts shorter than ``span`` lose nothing. All copies of a repeated
    string are removed, and repeated rows count as places of their own. An empty table gives no
    rows. Further columns of ``docs`` travel in ``row``, whatever their names.
    """
    spans = repeated_spans(spark, docs, span)
    keyed = boxed(docs).select("row", F.encode(full_text(), "UTF-8").alias("body"))
    keyed = keyed.withColumn("text_key", _text_key())
    remove = F.pandas_udf(_remove, "kept BINARY, text STRING, removed LONG, runs LONG")
    # Copies of one text may be very many, so its spans must not be tied to its hash.
    joined = keyed.join(splittable(spans), "text_key", "left")
    return joined.select("row", "body", remove("body", "spans").alias("rest"))


def dedup_bytes(spark: SparkSession, docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with what is left of it, as counts, digest and text."""
    rows = with_rest(spark, docs.select("doc_id", "text"), span)
    changed = F.col("rest.removed") > 0
    return rows.select(
        "row.doc_id",
        F.octet_length("body").cast("long").alias("n_bytes"),
        F.col("rest.removed").alias("n_removed"),
        F.col("rest.runs").alias("n_spans"),
        F.sha2(F.col("rest.kept"), 256).alias("kept_sha256"),
        F.when(changed, F.col("rest.text")).otherwise(F.col("row.text")).alias("text"),
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with repeated strings of ``span`` bytes cut from their texts, in their own columns.

    All rows stay, texts that are repeated as a whole become empty; n_chars follows the text.
    """
    rows = with_rest(spark, docs, span)
    changed = F.col("rest.removed") > 0
    return with_new_text(rows, docs.columns, F.col("rest.text"), changed)
