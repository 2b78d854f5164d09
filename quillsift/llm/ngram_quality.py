"""Quality rules and the perplexity of n-gram models counted from the corpus.

The model of words is modified Kneser-Ney over word pairs, see :mod:`quillsift.llm.word_model`; it
grows with the texts. A text that it finds far more surprising than the texts of its language is
rejected. Texts that hold only what other texts hold too are copies, and no worse for that.

Beside it a small model looks at spelling: character four-grams over a fixed alphabet of classes, of
bounded size: letters, other letters by hash, capitals, digits, white space and kinds of
punctuation. Spark counts the four-grams of all texts; lower orders count in how many contexts a
gram occurs; the discounts are those of modified Kneser-Ney. Keys and log probabilities lie in
sorted arrays that every executor searches. A text outside the band of its language on either side
is rejected. Bands come from all texts that pass the base rules.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm import word_model
from quillsift.llm.staging import full_text, staged

ORDER = 4
BITS = 6
#: 26 letters, 20 classes of other letters, and the rest below: at most CLASSES ** ORDER grams.
CLASSES = 58
FIRST_OTHER, OTHERS = 27, 20
CAPITAL, DIGIT, SPACE, BREAK, STOP, MARK, SYMBOL, QUOTE, DASH, REST = range(47, 57)
START = 57
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Bands lie so many robust deviations from the median; short texts vary more, as 1 / sqrt(length).
LOWER, UPPER = 4.0, 4.0
#: Perplexities are put in cells of this width to find medians by counting.
CELL = 0.002
MIN_BAND_DOCS = 30
#: Deviation of a text of one character, or word, that is due to chance alone.
CHANCE, WORD_CHANCE = 1.6, 4.0


class _Classes(dict):
    def __missing__(self, code: int) -> int:
        c = chr(code)
        if "a" <= c <= "z":
            out = code - ord("a") + 1
        elif c == "\n":
            out = BREAK
        elif c.isspace():
            out = SPACE
        elif c.isupper():
            out = CAPITAL
        elif c.isalpha():
            out = FIRST_OTHER + code * 2654435761 % (1 << 32) * OTHERS // (1 << 32)
        elif c.isdigit():
            out = DIGIT
        elif c in ".,":
            out = STOP
        elif c in "!?;:":
            out = MARK
        elif c in SYMBOLS:
            out = SYMBOL
        elif c in "\"'()[]{}«»“”„’":
            out = QUOTE
        elif c in "-–—_/":
            out = DASH
        else:
            out = REST
        self[code] = out
        return out


_TABLE = np.array([_Classes()[c] for c in range(0x250)], dtype=np.uint8)
_MORE = _Classes()


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    small = codes < len(_TABLE)
    if small.all():
        return _TABLE[codes]
    out = _TABLE[np.where(small, codes, 0)]
    high = codes[~small]
    kinds, where = np.unique(high, return_inverse=True)
    out[~small] = np.array([_MORE[int(c)] for c in kinds], dtype=np.uint8)[where]
    return out


def grams_of(text: str) -> np.ndarray:
    """The four-gram that ends at each character, as one number; text starts count as characters."""
    kinds = np.concatenate([np.full(ORDER - 1, START, dtype=np.uint8), classes_of(text)])
    kinds = kinds.astype(np.int32)
    n = len(text)
    out = np.zeros(n, dtype=np.int32)
    for i in range(ORDER):
        out = (out << BITS) | kinds[i : i + n]
    return out


def _gram_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Four-grams and their counts, summed over a task."""
    keys, counts = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    for batch in batches:
        for first in range(0, len(batch), 500):
            texts = batch["text"].iloc[first : first + 500]
            grams = [grams_of(t) for t in texts if t]
            if grams:
                fresh, n = np.unique(np.concatenate(grams), return_counts=True)
                both = np.concatenate([keys, fresh])
                keys, where = np.unique(both, return_inverse=True)
                sums = np.concatenate([counts, n])
                counts = np.bincount(where, weights=sums, minlength=len(keys)).astype(np.int64)
    yield pd.DataFrame({"gram": keys, "n": counts})


@dataclass
class KneserNey:
    """Natural log probabilities of four-grams, and what is needed for grams never seen: for each
    lower order sorted keys, their log probabilities, and the weight left to the order below."""

    keys: list[np.ndarray]
    logs: list[np.ndarray]
    context_keys: list[np.ndarray]
    context_logs: list[np.ndarray]

    def scores(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last class of each gram after the classes before it."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            part = grams[left] & ((1 << BITS * order) - 1)
            at, seen = _search(self.keys[order - 1], part)
            out[left[seen]] += self.logs[order - 1][at[seen]]
            left, part = left[~seen], part[~seen]
            if not len(left):
                return out
            at, seen = _search(self.context_keys[order - 1], part >> BITS)
            out[left[seen]] += self.context_logs[order - 1][at[seen]]
        out[left] -= math.log(CLASSES)
        return out


def _search(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _order(grams: np.ndarray, counts: np.ndarray, below: np.ndarray | None) -> tuple:
    """Probabilities and left-over weights of one order; ``below`` are the probabilities that the
    order below gives to these grams."""
    contexts, start, where = np.unique(grams >> BITS, return_index=True, return_inverse=True)
    totals = np.bincount(where, weights=counts)
    step = np.minimum(counts, 3).astype(np.int64)
    taken = word_model.discounts([int((counts == i).sum()) for i in range(1, 5)])[step]
    rest = np.bincount(where, weights=taken) / totals
    floor = np.full(len(grams), 1 / CLASSES) if below is None else below
    probability = (counts - taken) / totals[where] + rest[where] * floor
    return probability, contexts, np.log(np.maximum(rest, 1e-12))


def build(grams: np.ndarray, counts: np.ndarray) -> KneserNey:
    """The model of sorted distinct four-grams with their counts in the corpus."""
    tables = [(grams.astype(np.int64), counts.astype(np.float64))]
    for order in range(ORDER - 1, 0, -1):
        # How many different classes precede a gram of the lower order.
        lower, n = np.unique(tables[0][0] & ((1 << BITS * order) - 1), return_counts=True)
        tables.insert(0, (lower, n.astype(np.float64)))
    keys, logs, context_keys, context_logs = [], [], [], []
    below = None
    for order, (own, n) in enumerate(tables, start=1):
        floor = None
        if below is not None:
            shorter = own & ((1 << BITS * (order - 1)) - 1)
            floor = below[np.searchsorted(keys[-1], shorter)]
        below, contexts, rest = _order(own, n, floor)
        keys.append(own)
        logs.append(np.log(below).astype(np.float32))
        context_keys.append(contexts)
        context_logs.append(rest.astype(np.float32))
    return KneserNey(keys, logs, context_keys, context_logs)


def train(docs: DataFrame) -> KneserNey:
    """Counts the grams of all ``docs`` (text) with Spark; the model has at most
    CLASSES ** ORDER entries (11.3 million) and comes to the driver whole."""
    rows = docs.select(full_text().alias("text")).mapInPandas(_gram_rows, "gram INT, n LONG")
    sums = rows.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    sums = sums.sort_values("gram")
    return build(sums["gram"].to_numpy(np.int64), sums["n"].to_numpy(np.int64))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    return _base_counts(text, text.encode("utf-8", "surrogatepass").split())


def _base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return len(words), chars, symbols, repeated, _repeat_words(words)


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window that occurs twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter(
        (numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words)
    )
    size = len(numbers)
    pairs = ids[:-1] * size + ids[1:]
    if size < 2_000_000:
        windows = pairs[:-1] * size + ids[2:]
    else:
        windows = np.unique(pairs, return_inverse=True)[1][:-1] * np.int64(size) + ids[2:]
    _, where, often = np.unique(windows, return_inverse=True, return_counts=True)
    again = often[where] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


RATED = (
    "n_words LONG, word_chars LONG, n_symbols LONG, n_dup_lines LONG, n_repeat_words LONG,"
    " log_perplexity DOUBLE, n_chars LONG"
)


def _rate_rows(model):
    """Rated rows (doc_id, lang, text) with the keys of their words."""
    names = [c.split()[0] for c in RATED.split(", ")]

    def run(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        for first in range(0, batch.num_rows, 200):
            rows = batch.slice(first, 200)
            texts = rows.column(2).to_pylist()
            sizes = np.array([len(t) for t in texts])
            grams = np.concatenate([grams_of(t) for t in texts])
            # Each gram is looked up once, however often these texts have it.
            kinds, where = np.unique(grams, return_inverse=True)
            logs = np.r_[0.0, np.cumsum(model.value.scores(kinds.astype(np.int64))[where])]
            ends = np.cumsum(sizes)
            sums = logs[ends] - logs[ends - sizes]
            data = [t.encode("utf-8", "surrogatepass") for t in texts]
            counts = [_base_counts(t, d.split()) for t, d in zip(texts, data, strict=True)]
            means = np.divide(-sums, sizes, out=np.zeros(len(sums)), where=sizes > 0)
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            columns += [pa.array(means, mask=sizes == 0), pa.array(sizes, pa.int64())]
            keys = word_model.word_keys(b" ".join(data))
            cuts = np.cumsum([c[0] for c in counts])[:-1]
            yield (
                pa.record_batch(
                    [rows.column(0), rows.column(1), *columns], names=["doc_id", "lang", *names]
                ),
                np.split(keys, cuts),
            )

    return run


def rated(spark: SparkSession, docs: DataFrame, model: KneserNey) -> DataFrame:
    """doc_id, lang, the rated counts of every row, and the log perplexity of its words."""
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), full_text().alias("text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    common = word_model.common_words(docs, full_text())
    schema = f"doc_id {kind}, lang STRING, {RATED}"
    return word_model.scored(rows, _rate_rows(shared), schema, common)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bands(rows: DataFrame, column: str = "log_perplexity") -> DataFrame:
    """For each language with enough texts the median log perplexity and its robust deviation.

    Both are medians of counted cells, exact to the width of a cell, so that no language's texts
    are gathered in one task.
    """
    cells = rows.where(~base_failed() & F.col(column).isNotNull()).select(
        "lang", F.round(F.col(column) / CELL).cast("long").alias("cell")
    )
    middle = _medians(cells, "middle")
    away = cells.join(middle, "lang").select(
        "lang", F.abs(F.col("cell") - F.col("middle")).alias("cell")
    )
    spread = _medians(away, "spread")
    return middle.join(spread.drop("texts"), "lang").where(F.col("texts") >= MIN_BAND_DOCS).select(
        "lang",
        (F.col("middle") * CELL).alias("middle"),
        (F.greatest(F.col("spread"), F.lit(1)) * CELL * 1.4826).alias("spread"),
    )


def _medians(cells: DataFrame, name: str) -> DataFrame:
    counted = cells.groupBy("lang", "cell").agg(F.count(F.lit(1)).alias("n"))
    pairs = counted.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("cells"),
        F.sum("n").alias("texts"),
    )
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
    found = F.aggregate(
        "cells",
        start,
        lambda s, c: F.struct(
            (s["seen"] + c["n"]).alias("seen"),
            F.when(
                s["at"].isNull() & ((s["seen"] + c["n"]) * 2 >= F.col("texts")), c["cell"]
            )
            .otherwise(s["at"])
            .alias("at"),
        ),
    )
    return pairs.select("lang", "texts", found["at"].alias(name))


def _away(column: str, limits: str, size: str, chance: float) -> Column:
    """By how many of the deviations expected of a text of its length, those of the language and
    chance, a text lies off the median."""
    width = F.sqrt(F.col(f"{limits}.spread") ** 2 + chance**2 / F.greatest(F.col(size), F.lit(1)))
    return (F.col(column) - F.col(f"{limits}.middle")) / width


def judged(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, lang) with its counts, perplexity and verdict.

    ``perplexity`` is that of its words, ``spelling_perplexity`` that of its characters. Null texts
    count as empty and fail the base rules. A null language is a language of its own. Languages with
    fewer than MIN_BAND_DOCS texts have no band and reject nothing by perplexity.
    """
    model = train(docs)
    rows = staged(spark, rated(spark, docs, model), "quality")
    for column, name in (("word_perplexity", "words"), ("log_perplexity", "spelling")):
        limits = bands(rows, column).select("lang", F.struct("middle", "spread").alias(name))
        rows = rows.join(F.broadcast(limits), "lang", "left")
    words = _away("word_perplexity", "words", "n_words", WORD_CHANCE)
    spelling = _away("log_perplexity", "spelling", "n_chars", CHANCE)
    inside = F.coalesce((spelling >= -LOWER) & (spelling <= UPPER), F.lit(True))
    inside &= F.coalesce(words <= UPPER, F.lit(True))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & inside).alias("kept"),
        F.exp("word_perplexity").alias("perplexity"),
        words.alias("deviations"),
        F.exp("log_perplexity").alias("spelling_perplexity"),
        spelling.alias("spelling_deviations"),
    )
