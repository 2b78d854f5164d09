"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

Pieces are dealt to blocks of bounded size. In each block several islands evolve whole packings: a
child takes its first parent's bins, well-filled bins of the second are injected whole, bins that
hold a piece twice now are removed, and their other pieces are put back best-fit, largest first.
The elites of an island migrate to its neighbour, evolve there again, and the best packing of the
block wins. Bins that stay open are dissolved and their pieces packed together with those of other
blocks, level by level, until one block is left.
"""

from __future__ import annotations

import json
import os
import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.staging import full_text, staged

CAPACITY = 4_096
END_ID = 1
BLOCK_ITEMS = 1_024
LAST_BLOCK_ITEMS = 4_096
ISLANDS = 2
POPULATION = 4
GENERATIONS = 8
#: Bins with more room than this share of the capacity are packed again at the next level.
OPEN_SHARE = 1 / 128
WELL_FILLED = 0.995
WORDS_KEPT, PARTS_KEPT = 350_000, 250_000
JOINED_WORDS = 200
BAR = "|"
#: Signs that a tokenizer may set apart from letters before them; the apostrophe joins some.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
MAX_LEVELS = 12

PIECES = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"
PLACED = f"{PIECES}, block LONG, island INT, bin INT, bins INT, fitness DOUBLE"
#: str.split parts words at these, tokenizers do not take them for white space.
ODD_SPACES = "\x1c\x1d\x1e\x1f"


class Generations:
    """What is known of words, in two generations: what was not met again while the younger one
    filled up is forgotten."""

    def __init__(self, kept: int):
        self.kept = kept
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def unknown(self, lists: list[list[str]]) -> list[str]:
        """The words of some lists that are to be learned; those met again are young again."""
        # A set is compared with a dict word by word, and with a view of its keys key by key.
        words = set().union(*lists)
        wanted = words.difference(self.young)
        if len(self.young) + len(wanted) > self.kept:
            self.old, self.young = self.young, {}
            wanted = words
        learned, old, young = [], self.old, self.young
        for word in wanted:
            ids = old.get(word)
            if ids is None:
                learned.append(word)
            else:
                young[word] = ids
        return learned


class WordTokens:
    """Ids of whole texts from the ids of their words, each word encoded once while it is known.

    That holds for tokenizers that never join characters across white space. Where the tokenizer
    ends words with a mark of its own, as the pieces' file says, runs of letters and of signs are
    words to it, so a word is put together from its letters and the signs behind them; and where it
    reads all letters as small ones, the small letters stand for both.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.parts = Generations(WORDS_KEPT), Generations(PARTS_KEPT)
        bar = self._ids([BAR])[0]
        self.bar = int(bar[0]) if len(bar) == 1 else None
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        suffix = model.get("end_of_word_suffix")
        self.last = None
        if suffix:
            self.last = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
            self.last[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        # Both are tried out rather than read from the file's rules.
        self.splits = self.last is not None and all(
            self._joined(["thin", "q" * 3], [mark, mark * 3]) for mark in SIGNS
        )
        self.folds = self._same(["Thin", "QX"], ["thin", "qx"])

    @staticmethod
    def words(text: str) -> list[str]:
        if any(c in text for c in ODD_SPACES):
            return [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
        return text.split()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _same(self, one: list[str], other: list[str]) -> bool:
        pairs = zip(self._ids(one), self._ids(other), strict=True)
        return all(np.array_equal(a, b) for a, b in pairs)

    def _joined(self, heads: list[str], tails: list[str]) -> bool:
        """Whether letters with signs behind them have the ids of both, one after the other."""
        whole = self._ids([h + t for h in heads for t in tails])
        apart = [np.r_[h, t] for h in self._ids(heads) for t in self._ids(tails)]
        return all(np.array_equal(a, b) for a, b in zip(whole, apart, strict=True))

    def _keep(self, words: list[str], ids: np.ndarray, cuts: np.ndarray, skip: int) -> bool:
        """Enter words whose ids end before (or at) the ``cuts``; False if their numbers differ."""
        ends = [*cuts.tolist(), len(ids)] if skip else (cuts + 1).tolist()
        if len(ends) != len(words):
            return False
        starts = [0, *(e + skip for e in ends[:-1])]
        data, young = ids.tobytes(), self.parts.young
        for word, a, b in zip(words, starts, ends, strict=True):
            young[word] = data[4 * a : 4 * b]
        return True

    def _learn(self, words: list[str]) -> None:
        """Many words are encoded as one text, which costs far less: runs of letters with spaces
        between them, as each has one end mark, and others with bars."""
        letters = [w for w in words if self.last is not None and w.isalpha()]
        rest = [w for w in words if self.last is None or not w.isalpha()]
        for first in range(0, len(letters), JOINED_WORDS):
            part = letters[first : first + JOINED_WORDS]
            ids = self._ids([" ".join(part)])[0]
            if not self._keep(part, ids, np.flatnonzero(self.last[ids]), 0):
                rest += part
        alone = [w for w in rest if self.bar is None or BAR in w]
        rest = rest if not alone else [w for w in rest if self.bar is not None and BAR not in w]
        for first in range(0, len(rest), JOINED_WORDS):
            part = rest[first : first + JOINED_WORDS]
            ids = self._ids([f" {BAR} ".join(part)])[0]
            if not self._keep(part, ids, np.flatnonzero(ids == self.bar), 1):
                alone += part
        for word, ids in zip(alone, self._ids(alone), strict=True):
            self.parts.young[word] = ids.tobytes()

    def forget_old(self) -> None:
        self.known.old, self.parts.old = {}, {}

    def _apart(self, word: str) -> tuple[str, str]:
        """The letters of a word and the signs behind them; a word of another form as a whole."""
        head, tail = word, ""
        if self.splits and not word.isalpha():
            head = word.rstrip(SIGNS)
            if not head.isalpha():
                return word, ""
            tail = word[len(head) :]
        if self.folds and head.isascii() and head.isalpha():
            head = head.lower()
        return head, tail

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [self.words(t) for t in texts]
        wanted = self.known.unknown(split)
        apart = [self._apart(w) for w in wanted]
        heads, tails = zip(*apart, strict=True) if apart else ((), ())
        self._learn([p for p in self.parts.unknown([heads, tails]) if p])
        parts, known = self.parts.young, self.known.young
        for word, (head, tail) in zip(wanted, apart, strict=True):
            known[word] = parts[head] + parts[tail] if tail else parts[head]
        for words in split:
            yield b"".join(map(known.__getitem__, words))


_TOKENS: dict[str, WordTokens] = {}


def tokens_of(path: str) -> WordTokens:
    """One per worker process, so that words stay known from task to task."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def _piece_rows(path: str, capacity: int, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for first in range(0, batch.num_rows, 512):
                texts = batch.column(1)[first : first + 512].to_pylist()
                for doc, data in zip(ids[first:], tokens.encode(texts), strict=False):
                    data += end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield _batch(rows)
        # The worker lives on, also for other stages, which need the memory.
        tokens.forget_old()

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """The pieces of every row's text and its end id; an empty text is the end id alone."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), full_text().alias("text"))
    return rows.mapInArrow(_piece_rows(tokenizer, capacity, end_id), PIECES)


Bins = list[list[int]]


class Evolution:
    """Packings of the pieces with these lengths, evolved from best-fit ones."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int):
        self.lengths = [int(x) for x in lengths]
        self.capacity = capacity
        self.least = -(-sum(self.lengths) // capacity)
        self.random = random.Random(seed)

    def fill(self, members: list[int]) -> int:
        return sum(self.lengths[i] for i in members)

    def fitness(self, bins: Bins) -> float:
        """Falkenauer's: full bins beside empty room count more than bins of equal fill."""
        return sum((self.fill(b) / self.capacity) ** 2 for b in bins) / max(len(bins), 1)

    def rank(self, bins: Bins) -> tuple[int, float]:
        return len(bins), -self.fitness(bins)

    def best_fit(self, bins: Bins, loose: Iterable[int], noise: float = 0.0) -> Bins:
        """``bins`` with the loose pieces put where they leave the least room."""
        bins = [list(b) for b in bins]
        room = sorted((self.capacity - self.fill(b), k) for k, b in enumerate(bins))
        order = sorted(
            loose,
            key=lambda i: self.lengths[i] * (1 - noise * self.random.random()),
            reverse=True,
        )
        for i in order:
            at = bisect_left(room, (self.lengths[i], -1))
            if at < len(room):
                left, k = room.pop(at)
            else:
                left, k = self.capacity, len(bins)
                bins.append([])
            bins[k].append(i)
            insort(room, (left - self.lengths[i], k))
        return bins

    def cross(self, first: Bins, second: Bins) -> Bins:
        good = [b for b in second if self.fill(b) >= WELL_FILLED * self.capacity]
        good = good or sorted(second, key=self.fill, reverse=True)[: max(1, len(second) // 4)]
        share = self.random.randint(1, max(1, (len(good) + 1) // 2))
        injected = self.random.sample(good, min(share, len(good)))
        inside = {i for b in injected for i in b}
        kept, loose = [list(b) for b in injected], []
        for b in first:
            if inside.isdisjoint(b):
                kept.append(b)
            else:
                loose += [i for i in b if i not in inside]
        return self.best_fit(kept, loose)

    def mutate(self, bins: Bins) -> Bins:
        """The emptiest bin and a few others are dissolved."""
        order = sorted(range(len(bins)), key=lambda k: self.fill(bins[k]))
        out = {order[0], *self.random.sample(order, min(3, len(order)))}
        loose = [i for k in out for i in bins[k]]
        return self.best_fit([b for k, b in enumerate(bins) if k not in out], loose)

    def run(self, elites: list[Bins]) -> Bins:
        everything = range(len(self.lengths))
        people = list(elites)
        noise = 0.0
        while len(people) < POPULATION and not self._done(people):
            people.append(self.best_fit([], everything, noise))
            noise += 0.15
        for _ in range(GENERATIONS):
            if self._done(people):
                break
            people.sort(key=self.rank)
            first, second = self.random.sample(people[: max(2, POPULATION // 2)], 2)
            for child in (self.cross(first, second), self.mutate(self.cross(second, first))):
                people.append(child)
            people = sorted(people, key=self.rank)[:POPULATION]
        return min(people, key=self.rank)

    def _done(self, people: list[Bins]) -> bool:
        return any(len(p) <= self.least for p in people)


def _bins_of(numbers: np.ndarray) -> Bins:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(numbers.tolist()):
        bins.setdefault(b, []).append(i)
    return list(bins.values())


def _placed(rows: pa.Table, bins: Bins, evolution: Evolution, block: int, island: int) -> pa.Table:
    numbers = np.zeros(rows.num_rows, dtype=np.int32)
    for k, members in enumerate(bins):
        numbers[members] = k
    n = rows.num_rows
    return (
        rows.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        .append_column("block", pa.array(np.full(n, block, dtype=np.int64)))
        .append_column("island", pa.array(np.full(n, island, dtype=np.int32)))
        .append_column("bin", pa.array(numbers))
        .append_column("bins", pa.array(np.full(n, len(bins), dtype=np.int32)))
        .append_column("fitness", pa.array(np.full(n, evolution.fitness(bins))))
    )


ORDER = [(c, "ascending") for c in ("length", "doc_id", "piece", "start", "ids_crc32")]


def _evolve(capacity: int, level: int) -> Callable:
    """First epoch of an island: the pieces of a block, evolved from scratch."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        block, island = (k.as_py() for k in key)
        rows = rows.sort_by(ORDER)
        seed = (level * 1_000_003 + block) * 101 + island
        evolution = Evolution(rows["length"].to_numpy(), capacity, seed)
        return _placed(rows, evolution.run([]), evolution, block, island)

    return run


def _migrate(capacity: int, level: int) -> Callable:
    """Second epoch: an island's own elite and the one that came from its neighbour."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        block, island = (k.as_py() for k in key)
        parts = _by_origin(rows)
        first = parts[min(parts)]
        seed = (level * 1_000_003 + block) * 101 + 50 + island
        evolution = Evolution(first["length"].to_numpy(), capacity, seed)
        elites = [_bins_of(parts[k]["bin"].to_numpy()) for k in sorted(parts)]
        return _placed(first, evolution.run(elites), evolution, block, island)

    return run


def _by_origin(rows: pa.Table) -> dict[int, pa.Table]:
    """The packings in ``rows`` by the island they come from, pieces in one order."""
    origin = rows["island"].to_numpy()
    return {
        int(k): rows.filter(pa.array(origin == k)).sort_by(ORDER) for k in np.unique(origin)
    }


def _settle(capacity: int, level: int, last: bool) -> Callable:
    """The best packing of a block: places in closed bins, and the pieces of open ones."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        block = key[0].as_py()
        parts = _by_origin(rows)
        best = min(parts.values(), key=lambda t: (t["bins"][0].as_py(), -t["fitness"][0].as_py()))
        order = np.argsort(best["bin"].to_numpy(), kind="stable")
        best = best.take(pa.array(order))
        bins, lengths = best["bin"].to_numpy(), best["length"].to_numpy()
        fills = np.bincount(bins, weights=lengths).astype(np.int64)
        ends = np.cumsum(lengths)
        firsts = np.r_[0, np.flatnonzero(np.diff(bins)) + 1]
        offsets = ends - lengths - np.repeat((ends - lengths)[firsts], np.bincount(bins)[bins[firsts]])
        open_bins = (capacity - fills > OPEN_SHARE * capacity) & (not last)
        sequence = (np.int64(level) << 58) + (np.int64(block) << 20) + bins
        return (
            best.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            .append_column("sequence_id", pa.array(sequence.astype(np.int64)))
            .append_column("offset", pa.array(offsets.astype(np.int64)))
            .append_column("open", pa.array(open_bins[bins]))
        )

    return run


SETTLED = f"{PIECES}, sequence_id LONG, offset LONG, open BOOLEAN"


def _pack_level(items: DataFrame, blocks: int, capacity: int, level: int, last: bool) -> DataFrame:
    dealt = items.withColumn("block", F.monotonically_increasing_id() % blocks)
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    elites = (
        dealt.withColumn("island", islands)
        .groupBy("block", "island")
        .applyInArrow(_evolve(capacity, level), PLACED)
    )
    moved = elites.withColumn(
        "to", F.explode(F.array(F.col("island"), (F.col("island") + 1) % ISLANDS))
    )
    evolved = moved.groupBy("block", "to").applyInArrow(_migrate(capacity, level), PLACED)
    return evolved.groupBy("block").applyInArrow(_settle(capacity, level, last), SETTLED)


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Pieces are at most ``capacity`` long. The levels end when what is open fits one block or does
    not get less.
    """
    items = staged(spark, pieces, "pieces")
    left, settled = items.count(), []
    for level in range(MAX_LEVELS):
        blocks = 1 if left <= LAST_BLOCK_ITEMS else -(-left // BLOCK_ITEMS)
        last = blocks == 1 or level == MAX_LEVELS - 1
        rows = staged(spark, _pack_level(items, blocks, capacity, level, last), "packed")
        settled.append(rows.where(~F.col("open")))
        items = rows.where("open").select("doc_id", "piece", "start", "length", "ids_crc32")
        still = 0 if last else items.count()
        if not still:
            break
        left = still
    packed = settled[0]
    for part in settled[1:]:
        packed = packed.unionByName(part)
    return packed.drop("open")


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) cut into pieces and packed.

    A null or empty text is one piece of the end id alone; repeated rows are packed each by itself;
    an empty table gives no rows; other columns are not read.
    """
    return pack(spark, token_pieces(docs, tokenizer))
