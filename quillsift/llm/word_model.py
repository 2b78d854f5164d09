"""Modified Kneser-Ney over pairs of words, counted from all texts; a text is scored without itself.

Texts are put together in blocks. A block sends its different word pairs, as hashes, to the
partitions of the pair table; these count them over all blocks and answer. Of the pairs that a block
is the first to hold, it then knows by which words they are preceded and followed; these numbers are
added up in the partitions of the word table, which answer as well. With both answers a block
scores its texts. The model grows with the texts, lies in hash partitions, and no part of it comes
to the driver or is sent to every executor. A text's own counts are taken away before it is scored:
else a word that only this text holds would foretell the next one with certainty.

Letters are most of what is shuffled. Words that are frequent in a sample, and pairs of them, are
written by rank instead of by hash, which is shorter; what is counted does not depend on the sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that make a block, and the bits of a hash. Two of 4e9 different pairs share one in 0.4%.
BLOCK, KEY_BITS = 2_200_000, 40
#: Texts of a block are scored together up to so many words; a longer one is on its own.
SLICE = 1 << 18
#: Ids of blocks lie above those of partitions; so many blocks at most come from one task.
HOMES, PER_TASK = 1 << 32, 1 << 20
#: Fewer than 1 << RANK_BITS words have ranks, from about so many texts, of each the first characters.
RANK_BITS, SAMPLE, SAMPLE_CHARS = 18, 12_000, 1 << 14
#: How hard letters are pressed, and the least discount.
LEVEL, LEAST = 9, 0.05
MAIL = "dest LONG, source LONG, stats ARRAY<LONG>, packed BINARY, rows BINARY"
_FIELDS = pa.schema(
    [
        ("dest", pa.int64()),
        ("source", pa.int64()),
        ("stats", pa.list_(pa.int64())),
        ("packed", pa.binary()),
        ("rows", pa.binary()),
    ]
)


def mail(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_FIELDS)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], _FIELDS)


def pack(*columns: np.ndarray) -> bytes:
    """Whole numbers of equal length, their bytes by place, so that empty places cost nothing."""
    planes = np.concatenate(columns).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def unpack(data: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").reshape(columns, -1)


def gaps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=0)


class Common:
    """Frequent words, most frequent first, which have the ranks 1, 2 and so on.

    Written words are sorted numbers: places among the frequent ones in the order of their keys, or
    keys that lie above all places.
    """

    def __init__(self, words: np.ndarray):
        order = np.argsort(words)
        self.words, self.order = words[order], order + 1

    def _places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.words):
            return np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=bool)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return at, self.words[at] == words

    def ranks(self, words: np.ndarray) -> np.ndarray:
        """The rank of each word, 0 for words that are not frequent."""
        at, found = self._places(words)
        return np.where(found, self.order[at] if len(self.words) else 0, 0)

    def written(self, words: np.ndarray) -> np.ndarray:
        at, found = self._places(words)
        return gaps(np.sort(np.where(found, at, words + len(self.words))))

    def letter(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order in which numbers about words are written, frequent words first so that like
        numbers meet, and the written words."""
        ranks = self.ranks(words)
        ranks[ranks == 0] = 1 << RANK_BITS
        return ordered(ranks)[0], self.written(words)

    def read(self, steps: np.ndarray) -> np.ndarray:
        found, size = np.cumsum(steps), len(self.words)
        few = int(np.searchsorted(found, size))
        return np.sort(np.concatenate([self.words[found[:few]], found[few:] - size]))


NONE = Common(np.zeros(0, dtype=np.int64))

# Pairs of words with ranks are in classes by the sum of the bits of both ranks: a class has so many
# combinations of bits, and its pairs are about equally likely. Classes lie after one another, then hashes.
_TOP = 2 * RANK_BITS - 1
_KINDS = np.minimum(np.arange(_TOP) + 1, _TOP - np.arange(_TOP))
_FIRST = np.cumsum(np.r_[0, _KINDS << np.arange(_TOP)])
_LOG = np.frexp(np.arange(1 << RANK_BITS))[1].astype(np.int64) - 1
#: A pair's key: its place in its class or its hash, as a share of KEY_BITS; the lowest bit tells which.
PAIR_BITS = KEY_BITS + 1
_CLASS = (1 << 6) - 1


def _ranked_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Keys of pairs of ranks. The lowest bits of a place hold the class, which has no more pairs
    than fit above them, so that no two pairs share a key."""
    high, low = _LOG[left], _LOG[right]
    bits = high + low
    mask = (np.int64(1) << bits) - 1
    inner = ((left - (np.int64(1) << high)) << low) | (right - (np.int64(1) << low))
    inner = (inner * 0x9E3779B1) & mask
    place = inner * _KINDS[bits] + high - np.maximum(0, bits - RANK_BITS + 1)
    share = (place << (KEY_BITS - bits)) // _KINDS[bits]
    return ((share & ~_CLASS) | bits) << 1


def pair_letter(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys of pairs by their places, class by class, and hashes after them; and the
    steps from place to place."""
    share, hashed = keys >> 1, (keys & 1).astype(bool)
    bits = np.where(hashed, 0, share & _CLASS)
    place = -((-(share & ~_CLASS) * _KINDS[bits]) >> (KEY_BITS - bits))
    order, places = ordered(np.where(hashed, share + _FIRST[-1], place + _FIRST[bits]))
    return order, gaps(places)


def read_pairs(steps: np.ndarray) -> np.ndarray:
    """The keys in the order in which they were written."""
    found = np.cumsum(steps)
    few = int(np.searchsorted(found, _FIRST[-1]))
    bits = np.searchsorted(_FIRST, found[:few], side="right") - 1
    share = ((found[:few] - _FIRST[bits]) << (KEY_BITS - bits)) // _KINDS[bits]
    hashes = ((found[few:] - _FIRST[-1]) << 1) | 1
    return np.concatenate([((share & ~_CLASS) | bits) << 1, hashes])


_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_BYTES = np.random.default_rng(9).integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_BASE = 0xD1342543DE82EF95


def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.full(size, base, dtype=np.uint64), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def word_keys(text: bytes) -> np.ndarray:
    """The hashes of the words of a text: polynomials over their bytes, from running sums."""
    codes = np.frombuffer(text, dtype=np.uint8)
    blank = np.ones(len(codes) + 2, dtype=bool)
    blank[1:-1] = _BLANK[codes]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[codes] * _powers(_BASE, len(codes)), out=sums[1:])
    back = _powers(pow(_BASE, -1, 1 << 64), len(codes))
    return _mixed((sums[ends] - sums[starts]) * back[starts])


START_KEY = 0


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs of words."""
    return _mixed(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64))


def keys_of_pairs(
    words: np.ndarray, ranks: np.ndarray, left: np.ndarray, right: np.ndarray
) -> np.ndarray:
    """The keys of pairs of places among ``words``: by ranks if both words have one, or else by hash."""
    keys = np.empty(len(left), dtype=np.int64)
    for at in range(0, len(left), SLICE):
        a, b = left[at : at + SLICE], right[at : at + SLICE]
        part = (pair_keys(words[a], words[b]) << 1) | 1
        both = np.flatnonzero((ranks[a] > 0) & (ranks[b] > 0))
        part[both] = _ranked_keys(ranks[a[both]], ranks[b[both]])
        keys[at : at + SLICE] = part
    return keys


def ordered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of values, and the values in it. Sorts values together with their places,
    where both fit one number."""
    bits = len(values).bit_length()
    if len(values) and int(values.max()) >> (63 - bits):
        order = np.argsort(values, kind="stable")
        return order, values[order]
    both = np.sort((values << bits) | np.arange(len(values)))
    return both & ((1 << bits) - 1), both >> bits


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of each value among the different ones, these in rising order, and where each of
    them comes first."""
    order, found = ordered(values)
    new = np.ones(len(found), dtype=bool)
    new[1:] = found[1:] != found[:-1]
    where = np.empty(len(found), dtype=np.int64)
    where[order] = np.cumsum(new) - 1
    return where, found[new], order[new]


@dataclass
class Block:
    """``words``: sorted keys; ``places``: of each word in turn its place there; ``sizes``: words
    of each text."""

    words: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    common: Common = NONE

    @classmethod
    def of(cls, keys: list[np.ndarray], common: Common = NONE) -> Block:
        places, words, _ = numbered(np.concatenate([[START_KEY], *keys]))
        return cls(words, places[1:], np.array([len(k) for k in keys]), common)

    def packed(self) -> bytes:
        """Words are packed as ranks by frequency, which are small for frequent ones."""
        counts = np.bincount(self.places, minlength=len(self.words))
        rank = np.empty_like(counts)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        sizes = np.array([len(self.words), len(self.places)])
        words = self.common.written(self.words)
        return pack(sizes, words, counts, rank[self.places], self.sizes)

    @classmethod
    def unpacked(cls, data: bytes, common: Common = NONE) -> Block:
        found = unpack(data, 1)[0]
        n, m = found[:2]
        steps, counts, ranks, sizes = np.split(found[2:], np.cumsum([n, n, m]))
        places = np.argsort(-counts, kind="stable")[ranks]
        return cls(common.read(steps), places, sizes, common)

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the different pairs by key: keys, places of both words, counts; and each word's pair."""
        before = np.r_[0, self.places[:-1]] if len(self.places) else self.places
        starts = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        before[starts] = np.searchsorted(self.words, START_KEY)
        bits = len(self.words).bit_length()
        where, codes, _ = numbered((before << bits) | self.places)
        left, right = codes >> bits, codes & ((1 << bits) - 1)
        keys = keys_of_pairs(self.words, self.common.ranks(self.words), left, right)
        # Different pairs of one key stay apart, in the order of their codes.
        order = np.argsort(keys, kind="stable") if len(keys) >> (63 - PAIR_BITS) else None
        if order is None:
            shift = len(keys).bit_length()
            both = np.sort((keys << shift) | np.arange(len(keys)))
            order = both & ((1 << shift) - 1)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        n = np.bincount(where, minlength=len(codes))
        return keys[order], left[order], right[order], n[order], place[where]


def _ranges(keys: np.ndarray, parts: int, bits: int) -> list[slice]:
    """The sorted keys that belong to each partition."""
    ends = np.searchsorted(keys, (np.arange(parts + 1) << bits) // parts)
    return [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _dealt(
    keys: np.ndarray, columns: Iterable[np.ndarray], block: int, parts: int, bits: int, letter: Callable
) -> list[tuple]:
    """A letter to every partition, with the keys of its range as ``letter`` writes them."""
    rows = []
    for p, own in enumerate(_ranges(keys, parts, bits)):
        order, steps = letter(keys[own])
        rows.append((p, block, None, pack(steps, *(c[own][order] for c in columns)), None))
    return rows


def _answered(
    keys: np.ndarray, answers: pa.Table, columns: int, bits: int, letter: Callable
) -> np.ndarray:
    """What all partitions answered to the letters about ``keys``, in the order of these."""
    parts = _read_letters(answers, columns)[1]
    found = np.concatenate(parts, axis=1)
    ranges = _ranges(keys, len(parts), bits)
    order = np.concatenate([own.start + letter(keys[own])[0] for own in ranges])
    if found.shape[1] != len(order):
        raise RuntimeError("a block came out differently when it was made again")
    out = np.empty_like(found)
    out[:, order] = found
    return out


def _serialized(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _sent(read: Callable, parts: int, common: Broadcast):
    """Blocks of texts, kept at their home, and their pairs for the pair table. ``read`` makes of a
    batch pairs of a row and the keys of its words."""

    def letters(block: int, rows: list[pa.RecordBatch], keys: list[np.ndarray]) -> pa.Table:
        own = Block.of(keys, common.value)
        pairs, _, _, n, _ = own.pairs
        together = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        home = (block, -1, None, own.packed(), _serialized(together))
        return mail([home, *_dealt(pairs, [n], block, parts, PAIR_BITS, pair_letter)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = HOMES + TaskContext.get().partitionId() * PER_TASK
        rows, keys, words = [], [], 0
        for batch in batches:
            for part, found in read(batch):
                rows.append(part)
                keys.extend(found)
                words += sum(map(len, found))
                if words >= BLOCK:
                    yield from letters(block, rows, keys).to_batches()
                    block, rows, keys, words = block + 1, [], [], 0
        if rows:
            yield from letters(block, rows, keys).to_batches()

    return run


def _read_letters(table: pa.Table, columns: int) -> tuple[list[int], list[np.ndarray]]:
    table = table.sort_by("source")
    return table["source"].to_pylist(), [unpack(x.as_py(), columns) for x in table["packed"]]


def _histogram(counts: np.ndarray) -> list[int]:
    """How many numbers are 1, 2, 3 and 4, how many are 3 and more, how many and how much in all."""
    exact = [int((counts == i).sum()) for i in range(1, 5)]
    return [*exact, int((counts > 2).sum()), int((counts > 0).sum()), int(counts.sum())]


def _count_pairs(table: pa.Table) -> pa.Table:
    """Answers of a partition of the pair table: the count of each pair of a block in all other
    blocks, twice, and one more if the block is the first to hold it."""
    own = table["dest"][0].as_py()
    if own >= HOMES:
        return mail([])
    blocks, found = _read_letters(table, 2)
    keys = np.concatenate([read_pairs(steps) for steps, _ in found])
    where, _, first = numbered(keys)
    own_counts = np.concatenate([n for _, n in found])
    total = np.bincount(where, weights=own_counts).astype(np.int64)
    answer = 2 * (total[where] - own_counts)
    answer[first] += 1
    ends = np.cumsum([len(n) for _, n in found])[:-1]
    stats = _histogram(total)
    return mail(
        [(b, own, stats, pack(a), None) for b, a in zip(blocks, np.split(answer, ends), strict=True)]
    )


def _own_words(block: Block, answer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts of a block's pairs in all texts, and five numbers for each of its words: how often
    it is followed here, and, of pairs that this block is the first to hold, by how many words once,
    twice and more often, and how many precede it."""
    _, left, right, n, _ = block.pairs
    total, first = (answer >> 1) + n, (answer & 1).astype(bool)
    step, size = np.minimum(total, 3), len(block.words)
    columns = [np.bincount(left, weights=n, minlength=size)]
    columns += [np.bincount(left[first & (step == i)], minlength=size) for i in (1, 2, 3)]
    columns += [np.bincount(right[first], minlength=size)]
    return total, np.array(columns).astype(np.int64)


def _count_words(parts: int, common: Broadcast):
    """Letters of a block to the word table."""

    def run(home: pa.Table, answers: pa.Table) -> pa.Table:
        if not home.num_rows or home["dest"][0].as_py() < HOMES:
            return mail([])
        block = home["dest"][0].as_py()
        own = Block.unpacked(home["packed"][0].as_py(), common.value)
        answer = _answered(own.pairs[0], answers, 1, PAIR_BITS, pair_letter)[0]
        _, columns = _own_words(own, answer)
        return mail(_dealt(own.words, columns, block, parts, KEY_BITS, common.value.letter))

    return run


def _sum_words(parts: int, common: Broadcast):
    """Answers of a partition of the word table: the sums of each word over all other blocks."""

    def run(table: pa.Table) -> pa.Table:
        own = parts + table["dest"][0].as_py()
        blocks, found = _read_letters(table, 6)
        words = [common.value.read(x[0]) for x in found]
        keys = np.concatenate([x[common.value.letter(x)[0]] for x in words])
        where, _, _ = numbered(keys)
        columns = np.concatenate([x[1:] for x in found], axis=1)
        sums = np.array([np.bincount(where, weights=c) for c in columns]).astype(np.int64)
        ends = np.cumsum([x.shape[1] for x in found])[:-1]
        answers = np.split(sums[:, where] - columns, ends, axis=1)
        stats = _histogram(sums[4])
        return mail(
            [(b, own, stats, pack(*a), None) for b, a in zip(blocks, answers, strict=True)]
        )

    return run


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of one, two and three or more, from how many counts
    are 1, 2, 3 and 4. They are never 0, so that words no other text holds have a share."""
    if not n[0] or not n[1]:
        return np.array([0.0, 0.5, 0.75, 0.75])
    y = n[0] / (n[0] + 2 * n[1])
    found = [0.0] + [i - (i + 1) * y * n[i] / max(n[i - 1], 1) for i in (1, 2, 3)]
    return np.clip(np.array(found), [0.0, LEAST, LEAST, LEAST], [0.0, 0.95, 1.9, 2.9])


def log_sums(block: Block, total: np.ndarray, words: np.ndarray, pair_stats, word_stats):
    """The sum of the log probabilities of each text's words after the words before them.

    Pairs that share a hash are counted as one, so that a word may seem to be followed by too few:
    what is left for unseen pairs is held above 0. ``total``: counts of the block's pairs; ``words``: for each of its words how often it is
    followed, by how many words once, twice and more often, and how many precede it.
    """
    ends = np.concatenate([[0], np.cumsum(block.sizes)])
    sums, texts, first = np.zeros(len(block.sizes)), len(block.sizes), 0
    while first < texts:
        last = int(np.searchsorted(ends, ends[first] + SLICE, side="right")) - 1
        last = max(last, first + 1)
        sums[first:last] = _slice_sums(block, first, last, total, words, pair_stats, word_stats)
        first = last
    return sums


def _slice_sums(block: Block, first: int, last: int, total, words, pair_stats, word_stats):
    """``log_sums`` of the texts from ``first`` to before ``last``."""
    _, left, right, _, places = block.pairs
    begin, end = block.sizes[:first].sum(), block.sizes[:last].sum()
    places = places[begin:end]
    size, texts = len(block.words), last - first
    texts_of = np.repeat(np.arange(texts), block.sizes[first:last])
    upper, lower = discounts(pair_stats[:4]), discounts(word_stats[:4])
    n_one, n_two, _, _, n_more, n_words, n_pairs = word_stats
    n_words = max(n_words, 1)

    def step(x: np.ndarray) -> np.ndarray:
        return np.minimum(x, 3).astype(np.int64)

    def added(at: np.ndarray, what: np.ndarray) -> np.ndarray:
        return np.bincount(at, weights=what)

    bits = max(len(total), size).bit_length()
    mask = (1 << bits) - 1
    where, codes, _ = numbered((texts_of << bits) | places)
    own = np.bincount(where, minlength=len(codes))
    text, pair = codes >> bits, codes & mask
    count, rest = total[pair], total[pair] - own
    gone = rest == 0

    at, after, _ = numbered((text << bits) | left[pair])
    after &= mask
    context = words[0][after] - added(at, own)
    weight = np.zeros(len(after))
    for i in (1, 2, 3):
        change = (step(rest) == i).astype(int) - (step(count) == i)
        weight += upper[i] * np.maximum(words[i][after] + added(at, change), 0)
    weight = np.maximum(weight, LEAST)

    to, ends, _ = numbered((text << bits) | right[pair])
    preceded = words[4][ends & mask]
    others = np.maximum(preceded - added(to, gone), 0)
    ends_text = ends >> bits
    change = lower[step(others)] - lower[step(preceded)]
    left_over = lower[1] * n_one + lower[2] * n_two + lower[3] * n_more
    left_over = left_over + np.bincount(ends_text, weights=change, minlength=texts)
    left_over = np.maximum(left_over, LEAST)
    kinds = n_pairs - np.bincount(text, weights=gone, minlength=texts)
    shares = (others - lower[step(others)] + left_over[ends_text] / n_words) / np.maximum(
        kinds[ends_text], 1
    )
    low = np.where(kinds[ends_text] > 0, shares, 1 / n_words)[to]

    high = (rest - upper[step(rest)] + weight[at] * low) / np.maximum(context[at], 1)
    logs = np.log(np.where(context[at] > 0, high, low))
    return np.bincount(text, weights=own * logs, minlength=texts)


def _scored(parts: int, common: Common, home: pa.Table, answers: pa.Table) -> pa.Table:
    block = Block.unpacked(home["packed"][0].as_py(), common)
    rows = pa.ipc.open_stream(home["rows"][0].as_py()).read_all()
    answers = answers.sort_by("source")
    pairs, more = answers.slice(0, parts), answers.slice(parts)
    pair_stats, word_stats = (
        np.sum(x["stats"].to_pylist(), axis=0).tolist() for x in (pairs, more)
    )
    total, words = _own_words(block, _answered(block.pairs[0], pairs, 1, PAIR_BITS, pair_letter)[0])
    words += _answered(block.words, more, 5, KEY_BITS, common.letter)
    sums = log_sums(block, total, words, pair_stats, word_stats)
    mean = np.divide(-sums, block.sizes, out=np.zeros(len(sums)), where=block.sizes > 0)
    column = pa.array(mean, pa.float64(), mask=block.sizes == 0)
    return rows.append_column("word_perplexity", column)


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = b" ".join(x.encode("utf-8", "surrogatepass") for x in batch.column(0).to_pylist())
        words, n = np.unique(word_keys(data), return_counts=True)
        yield pa.record_batch([pa.array(words), pa.array(n)], names=["word", "n"])


def common_words(docs: DataFrame, text: Column) -> Common:
    """Frequent words of a sample of bounded size. It only decides how letters are written."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    texts = docs.sample(share, seed=9).select(F.substring(text, 1, SAMPLE_CHARS))
    counts = texts.mapInArrow(_word_counts, "word LONG, n LONG").groupBy("word")
    found = counts.agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    words, n = (found[c].to_numpy() for c in ("word", "n"))
    return Common(words[np.lexsort((words, -n))][: (1 << RANK_BITS) - 1])


def scored(docs: DataFrame, read: Callable, schema: str, common: Common = NONE) -> DataFrame:
    """The rows that ``read`` makes of ``docs``, of this schema, and the log perplexity of their
    words, null for texts without words."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = f"{schema}, word_perplexity DOUBLE"
    empty = spark.createDataFrame([], out).toArrow()
    shared = spark.sparkContext.broadcast(common)

    def final(home: pa.Table, answers: pa.Table) -> pa.Table:
        if not home.num_rows or home["dest"][0].as_py() < HOMES:
            return empty
        return _scored(parts, shared.value, home, answers)

    def posted(letters: DataFrame) -> DataFrame:
        # Dealt by name and number, so that letters that are read twice are written once, and a
        # union of letters is not dealt anew.
        return letters.repartition(parts, "dest")

    homes = posted(docs.mapInArrow(_sent(read, parts, shared), MAIL)).groupBy("dest")
    pairs = posted(homes.applyInArrow(_count_pairs, MAIL))
    letters = homes.cogroup(pairs.groupBy("dest")).applyInArrow(_count_words(parts, shared), MAIL)
    words = posted(letters).groupBy("dest").applyInArrow(_sum_words(parts, shared), MAIL)
    answers = pairs.union(posted(words)).groupBy("dest")
    return homes.cogroup(answers).applyInArrow(final, out)
