"""SentencePiece encoding and decoding over a lattice.

Texts fall into words at places that no piece can cross. A task encodes each different word it meets
once: all substrings of a block of words are walked through the pieces at the same time, what is a
piece is an edge of the word's lattice, and the edges of all words are folded side by side, the first
edge of every word, then the second, and so on. For a unigram model the fold is Viterbi: the
best-scored path to each place. For a BPE model edges come in merge order instead, since its own
segmentation is not the best-scored path: an edge that spans exactly two neighbouring parts merges
them. Nothing is shuffled or sent to the driver; a task holds one block of words with its edges and
the ids of as many words as a parameter allows. ``lattice`` and ``viterbi_fold`` are the same lattice
and the same path as a table and a column.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.staging import full_text

SPACE = "▁"
#: A task keeps the ids of so many words; when there are more, it starts anew.
COMMON_WORDS = 400_000
#: Longer words are encoded again by each part of the texts that holds them.
KEPT_LENGTH = 32
#: Characters of the words whose lattices are folded together.
BLOCK = 1 << 17
#: Rows and characters of the texts that are encoded together; a longer text is on its own.
PART_ROWS, PART_LENGTH = 500, 1 << 20
#: Bits of a character in a step of the trie.
CHARACTER = 21
BREAKS = "\n\t\r"


@dataclass(frozen=True)
class Model:
    """Pieces with their scores; ``first_byte`` is the id of the piece for byte 0."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    plain: tuple[bool, ...]
    first_byte: int
    longest: int

    @classmethod
    def load(cls, path: str) -> Model:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        pieces = tuple(sp.id_to_piece(i) for i in ids)
        plain = tuple(
            not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
            for i in ids
        )
        longest = max(len(p) for p, ok in zip(pieces, plain, strict=True) if ok)
        scores = tuple(sp.get_score(i) for i in ids)
        return cls(pieces, scores, plain, sp.piece_to_id("<0x00>"), longest)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (p, i, s)
            for i, (p, s, ok) in enumerate(zip(self.pieces, self.scores, self.plain, strict=True))
            if ok
        ]
        return spark.createDataFrame(rows, "piece STRING, id INT, score DOUBLE")

    @property
    def word_pattern(self) -> str:
        """Words: spaces with what follows them, cut at signs that no piece holds."""
        text = "".join(p for p, ok in zip(self.pieces, self.plain, strict=True) if ok)
        if any(SPACE in p.lstrip(SPACE) for p, ok in zip(self.pieces, self.plain, strict=True) if ok):
            raise ValueError("pieces of this model cross words")
        cuts = "".join(c for c in BREAKS if c not in text)
        cut = f"|[{cuts}]" if cuts else ""
        return f"{SPACE}*[^{SPACE}{cuts}]+|{SPACE}+{cut}"


def _parts(words: DataFrame, model: Model, pieces: DataFrame) -> DataFrame:
    """Substrings of each word up to the longest piece that are pieces or single characters.

    The piece table is sent to all executors; its size is that of the model file.
    """
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    longest = F.least(F.lit(model.longest), size - F.col("start"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), longest)).alias("length"))
    rows = rows.withColumn("part", F.substring("word", F.col("start") + 1, F.col("length")))
    found = rows.join(F.broadcast(pieces.withColumnRenamed("piece", "part")), "part", "left")
    return found.where(F.col("id").isNotNull() | (F.col("length") == 1))


def lattice(words: DataFrame, model: Model, spark: SparkSession) -> DataFrame:
    """word, n and edges of each distinct word: (score, start, end, id, part).

    Every single character is an edge, with a null id where it is no piece.
    """
    end = (F.col("start") + F.col("length")).alias("end")
    return (
        _parts(words, model, model.table(spark))
        .groupBy("word")
        .agg(
            F.max("n").alias("n"),
            F.collect_list(F.struct("score", "start", end, "id", "part")).alias("edges"),
        )
    )


def _bytes(part: Column, model: Model) -> Column:
    """The ids of a character's UTF-8 bytes."""
    code = F.hex(F.encode(part, "UTF-8"))
    places = F.sequence(F.lit(1), F.length(code), F.lit(2))
    return F.transform(
        places,
        lambda i: F.conv(F.substring(code, i, F.lit(2)), 16, 10).cast("int") + model.first_byte,
    )


def _ids(path: Column, model: Model) -> Column:
    return F.flatten(
        F.transform(
            path,
            lambda e: F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(
                _bytes(e["part"], model)
            ),
        )
    )


def viterbi_fold(model: Model) -> Column:
    """Ids of a word under a unigram model, from its ``edges``: for each place in turn the best
    path to it. Characters that are no piece score ten below the worst piece, as the library has
    it; of equal paths the one with the longer last piece is taken."""
    worst = min(s for s, ok in zip(model.scores, model.plain, strict=True) if ok) - 10.0
    order = F.array_sort(
        F.transform(
            "edges",
            lambda e: F.struct(
                e["end"],
                e["start"],
                F.coalesce(e["score"], F.lit(worst)).alias("score"),
                e["id"],
                e["part"],
            ),
        )
    )
    kind = "struct<total:array<double>,back:array<struct<start:int,id:int,part:string>>>"
    start = F.struct(F.array(F.lit(0.0)).alias("total"), F.array().alias("back")).cast(kind)

    def step(state: Column, e: Column) -> Column:
        score = F.get(state["total"], e["start"]) + e["score"]
        known = F.size(state["back"])
        link = F.array(F.struct(e["start"], e["id"], e["part"]))
        fresh = e["end"] > known
        better = score > F.get(state["total"], e["end"])
        total = F.when(fresh, F.concat(state["total"], F.array(score))).otherwise(
            F.concat(F.slice(state["total"], F.lit(1), e["end"]), F.array(score))
        )
        back = F.when(fresh, F.concat(state["back"], link)).otherwise(
            F.concat(F.slice(state["back"], F.lit(1), known - 1), link)
        )
        return (
            F.when(fresh | better, F.struct(total.alias("total"), back.alias("back")))
            .otherwise(state)
            .cast(kind)
        )

    def trace(back: Column) -> Column:
        begin = F.struct(
            F.size(back).alias("at"),
            F.array().cast("array<struct<start:int,id:int,part:string>>").alias("path"),
        )

        def hop(state: Column, _: Column) -> Column:
            link = F.get(back, state["at"] - 1)
            return F.when(
                state["at"] > 0,
                F.struct(
                    link["start"].alias("at"),
                    F.concat(state["path"], F.array(link)).alias("path"),
                ),
            ).otherwise(state)

        return F.aggregate(back, begin, hop, lambda s: F.reverse(s["path"]))

    return _ids(trace(F.aggregate(order, start, step, lambda s: s["back"])), model)


class Trie:
    """The pieces as steps from a state by a character to the next state; a word begins at 0."""

    def __init__(self, model: Model):
        known: dict[int, int] = {}
        piece = {}
        for i, (text, ok) in enumerate(zip(model.pieces, model.plain, strict=True)):
            if ok:
                state = 0
                for c in text:
                    state = known.setdefault(state << CHARACTER | ord(c), len(known) + 1)
                piece[state] = i
        steps = np.array([*known, (1 << 63) - 1], dtype=np.uint64)
        order = np.argsort(steps)
        self.steps = steps[order]
        self.states = np.array([*known.values(), 0], dtype=np.uint64)[order]
        #: The piece that ends in a state, or -1.
        self.piece = np.full(len(known) + 1, -1, dtype=np.int32)
        self.piece[list(piece)] = list(piece.values())
        # Most steps lead nowhere, which this table tells of nearly all of them.
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[self._slot(self.steps)] = True

    @staticmethod
    def _slot(steps: np.ndarray) -> np.ndarray:
        return steps * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(42)

    def walk(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the states have a step by their character, and the states it leads to."""
        steps = states << np.uint64(CHARACTER) | codes
        near = np.flatnonzero(self.maybe[self._slot(steps)])
        at = np.searchsorted(self.steps, steps[near])
        found = self.steps[at] == steps[near]
        return near[found], self.states[at[found]]


@dataclass(frozen=True)
class Edges:
    """The lattices of some words, as arrays. Places count through the characters of all words.

    ``codes`` and ``word`` are the character and the word of a place, ``sizes`` the length of a word;
    an edge goes from ``start`` to ``end`` and has the piece ``id``. Edges of one piece ascend by
    start, those of one start by length.
    """

    codes: np.ndarray
    sizes: np.ndarray
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    id: np.ndarray

    @classmethod
    def of(cls, words: list[str], trie: Trie, longest: int) -> Edges:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        stop = np.cumsum(sizes)[word]
        at, state = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
        found = []
        for length in range(1, longest + 1):
            inside = at + length <= stop[at]
            at, state = at[inside], state[inside]
            led, state = trie.walk(state, codes[at + length - 1])
            at = at[led]
            ids = trie.piece[state.astype(np.int64)]
            piece = ids >= 0
            found.append((at[piece], at[piece] + length, ids[piece]))
        start, end, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        return cls(codes, sizes, word, start, end, ids)


def _rounds(word: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the first row of every word, then of the second, and so on; words come in runs."""
    first = np.flatnonzero(np.diff(word, prepend=-1))
    count = np.diff(first, append=len(word))
    most = np.argsort(-count, kind="stable")
    first, count = first[most], count[most]
    for k in range(count[0] if len(count) else 0):
        first = first[: np.searchsorted(-count, -k)]
        yield first + k


def merged_parts(edges: Edges, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts of the words start under a BPE model, and their pieces (-1: none).

    Edges come by falling score, leftmost first. A piece's parts always precede it in that order,
    so one pass makes the merges of the model in their order.
    """
    rank = np.empty(len(model.scores), dtype=np.int64)
    rank[np.argsort(-np.array(model.scores), kind="stable")] = np.arange(len(rank))
    size = len(edges.codes)
    part = np.full(size, -1, dtype=np.int32)
    long = edges.end - edges.start > 1
    part[edges.start[~long]] = edges.id[~long]
    start, end, ids = edges.start[long], edges.end[long], edges.id[long]
    word = edges.word[start]
    order = np.argsort(word * len(rank) + rank[ids], kind="stable")
    start, end, ids = start[order], end[order], ids[order]
    # The end of the part that starts at a place, -1 where none does.
    follow = np.append(np.arange(1, size + 1), -2)
    for i in _rounds(word[order]):
        middle = follow[start[i]]
        fits = follow[middle] == end[i]
        i, middle = i[fits], middle[fits]
        follow[start[i]] = end[i]
        follow[middle] = -1
        part[start[i]] = ids[i]
    places = np.flatnonzero(follow[:-1] > 0)
    return places, part[places]


def best_parts(edges: Edges, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts of the words start on the path with the best sum of scores, and their pieces
    (-1: none).

    Characters that are no piece score ten below the worst piece, as the library has it; of equal
    paths the one with the longer last piece is taken.
    """
    scores = np.array(model.scores)
    worst = scores[np.array(model.plain)].min() - 10.0
    lone = np.ones(len(edges.codes), dtype=bool)
    lone[edges.start[edges.end - edges.start == 1]] = False
    lone = np.flatnonzero(lone)
    start, end = np.append(edges.start, lone), np.append(edges.end, lone + 1)
    ids = np.append(edges.id, np.full(len(lone), -1, dtype=np.int32))
    word = edges.word[start]
    order = np.lexsort((start, end, word))
    start, end, ids, word = start[order], end[order], ids[order], word[order]
    score = np.where(ids < 0, worst, scores[ids])
    # Each word has one place more than characters, its end.
    left, right = start + word, end + word
    stops = np.cumsum(edges.sizes + 1) - 1
    total = np.full(len(edges.codes) + len(edges.sizes), -np.inf)
    total[stops - edges.sizes] = 0.0
    last = np.full(len(total), -1)
    for i in _rounds(word):
        ahead = total[left[i]] + score[i]
        better = ahead > total[right[i]]
        i = i[better]
        total[right[i]], last[right[i]] = ahead[better], i
    chosen, at = [], stops
    while len(at):
        edge = last[at]
        edge = edge[edge >= 0]
        chosen.append(edge)
        at = left[edge]
    path = np.concatenate(chosen)
    path = path[np.argsort(start[path])]
    return start[path], ids[path]


Fold = Callable[[Edges, Model], tuple[np.ndarray, np.ndarray]]
FOLDS: dict[str, Fold] = {"bpe": merged_parts, "unigram": best_parts}


def _encoded_block(words: list[str], model: Model, trie: Trie, fold: Fold) -> Iterator[bytes]:
    edges = Edges.of(words, trie, model.longest)
    places, ids = fold(edges, model)
    spelled = {
        k: np.frombuffer(chr(edges.codes[places[k]]).encode(), dtype=np.uint8).astype("<u4")
        + np.uint32(model.first_byte)
        for k in np.flatnonzero(ids < 0).tolist()
    }
    counts = np.ones(len(ids), dtype=np.int64)
    counts[list(spelled)] = [len(x) for x in spelled.values()]
    flat = np.repeat(ids, counts).astype("<u4")
    first = np.cumsum(counts) - counts
    for k, own in spelled.items():
        flat[first[k] : first[k] + len(own)] = own
    sizes = np.bincount(edges.word[places], weights=counts, minlength=len(words)).astype(np.int64)
    ends = (4 * np.cumsum(sizes)).tolist()
    data = flat.tobytes()
    for begin, end in zip([0, *ends], ends, strict=False):
        yield data[begin:end]


def _blocks(items: list, sizes: Iterable[int], rows: int, length: int) -> Iterator[list]:
    """Runs of at most so many items and so much size; an item that is larger is on its own."""
    block, filled = [], 0
    for item, size in zip(items, sizes, strict=True):
        if block and (len(block) == rows or filled + size > length):
            yield block
            block, filled = [], 0
        block.append(item)
        filled += size
    if block:
        yield block


class WordIds:
    """Ids of words, as bytes of unsigned 32-bit numbers; each is encoded when it is first met."""

    def __init__(self, model: Model, kind: str, kept: int):
        self.model, self.trie, self.fold = model, Trie(model), FOLDS[kind]
        self.kept, self.known = kept, {}

    def encode(self, words: Iterable[str]) -> dict[str, bytes]:
        fresh = list(words)
        found: dict[str, bytes] = {}
        for block in _blocks(fresh, map(len, fresh), BLOCK, BLOCK):
            ids = _encoded_block(block, self.model, self.trie, self.fold)
            found.update(zip(block, ids, strict=True))
        return found

    def texts(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of texts that are given as their words."""
        met = set().union(*texts)
        if len(self.known) + len(met) > self.kept:
            self.known = {}
        fresh = self.encode(met - self.known.keys())
        self.known.update(fresh)
        found = [b"".join(map(self.known.__getitem__, words)) for words in texts]
        for word in fresh:
            if len(word) > KEPT_LENGTH:
                del self.known[word]
        return found


ENCODED = "doc_id LONG, n_words LONG, ids ARRAY<INT>, round_trip BOOLEAN"


def _encoded_rows(model: Model, kind: str, kept: int):
    pattern = re.compile(model.word_pattern)

    def words(text: str) -> list[str]:
        return pattern.findall(f"{SPACE}{text.replace(' ', SPACE)}") if text else []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = WordIds(model, kind, kept)
        for batch in batches:
            sizes = pc.utf8_length(batch.column(1)).to_pylist()
            for rows in _blocks(range(batch.num_rows), sizes, PART_ROWS, PART_LENGTH):
                part = batch.slice(rows[0], len(rows))
                texts = part.column(1).to_pylist()
                cut = [words(t) for t in texts]
                ids = [np.frombuffer(d, dtype="<i4") for d in shared.texts(cut)]
                offsets = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.int32())
                )
                trips = [
                    decode_ids(i.tolist(), model) == t for i, t in zip(ids, texts, strict=True)
                ]
                counts = pa.array([len(c) for c in cut], pa.int64())
                yield pa.record_batch(
                    [part.column(0), counts, lists, pa.array(trips, pa.bool_())],
                    names=["doc_id", "n_words", "ids", "round_trip"],
                )

    return run


_BYTES: dict[tuple, list[bytes]] = {}


def decode_ids(ids: list[int], model: Model) -> str:
    """The text of ids; the space that encoding puts in front is dropped, control ids are nothing."""
    table = _BYTES.get((len(model.pieces), model.first_byte))
    if table is None:
        table = [
            p.encode() if ok else b"" for p, ok in zip(model.pieces, model.plain, strict=True)
        ]
        table[model.first_byte : model.first_byte + 256] = [bytes([b]) for b in range(256)]
        _BYTES[(len(model.pieces), model.first_byte)] = table
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text.replace(SPACE, " ")[1:] if text.startswith(SPACE) else text.replace(SPACE, " ")


def encode_documents(
    spark: SparkSession,
    docs: DataFrame,
    model_path: str,
    kind: str = "bpe",
    common_words: int = COMMON_WORDS,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its ids, and whether they decode to its text.

    Null and empty texts have no ids. Repeated rows give repeated rows, an empty table none. A text
    that holds the space mark itself decodes to a space there. Other columns are not read.
    """
    model = Model.load(model_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), full_text().alias("text"))
    return rows.mapInArrow(_encoded_rows(model, kind, common_words), ENCODED)


def decode(df: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """``df`` with a column ``text`` decoded from its ids; null ids give a null text."""
    model = Model.load(model_path)

    def texts(column: pd.Series) -> pd.Series:
        return column.map(lambda x: None if x is None else decode_ids(list(x), model))

    return df.withColumn("text", F.pandas_udf(texts, "string")(ids))
