"""Toxicity by a weighted lexicon.

Text is folded first: lower case, accents dropped, homoglyphs and digit substitutions mapped to the
letters they stand for. Terms are whole words and word beginnings, learned from labelled rows: a
term is kept if its share among toxic texts is far above its share among clean ones, beyond chance,
and if it occurs in texts of several kinds, so that the words of one copied text are no terms. Its
weight is the log ratio of the shares. An Aho-Corasick automaton finds all terms in one pass; hits
within exception phrases do not count; the summed weight is normalised by the length and turned
into a probability by a logistic curve.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.staging import boxed, full_text, staged, unboxed

# Letters of other scripts that look like Latin ones, and signs put for letters.
# i, l, 1 and | are read as one letter, since each is written for the others.
HOMOGLYPHS = "а a,в b,с c,е e,н h,і i,ј j,к k,м m,о o,р p,ѕ s,т t,у y,х x,ԁ d,ԛ q,ԝ w"
HOMOGLYPHS += ",α a,β b,ε e,η n,ι i,κ k,ν v,ο o,ρ p,τ t,υ u,χ x,ı i,ɡ g,ꞓ c"
SIGNS = "0 o,1 i,3 e,4 a,5 s,7 t,8 b,@ a,$ s,l i"

PREFIXES = range(4, 9)
#: At most so many labelled rows train the lexicon and its curve, those with the smallest hashes.
TRAINING_ROWS = 24_000
#: Chance is excluded from this G-squared on; e ** 2 times the clean share is far above.
MIN_EVIDENCE, MIN_RATIO, MIN_KINDS, KIND_SHARE = 24.0, 2.0, 5, 0.5
EXCEPTION_DOCS = 3
LENGTH_OFFSET = 25.0
THRESHOLD = 0.3
HELD_OUT = 2


class _Folds(dict):
    """Code point to its letters; a character that is no letter or digit parts words."""

    def __missing__(self, code: int) -> str:
        base = unicodedata.normalize("NFKD", chr(code)).lower()
        kept = [c for c in base if not unicodedata.combining(c)]
        out = "".join(SUBSTITUTES.get(c, c if c.isalnum() else " ") for c in kept)
        self[code] = out
        return out


SUBSTITUTES = dict(pair.split(" ") for pair in f"{HOMOGLYPHS},{SIGNS}".split(","))
_FOLDS = _Folds()


def fold(text: str) -> str:
    """Folded words between single spaces, with a space at either end."""
    return f" {' '.join(text.translate(_FOLDS).split())} "


@dataclass
class Lexicon:
    """``terms`` maps " word " or " beginning" to a weight; ``exceptions`` are folded phrases."""

    terms: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (-2.0, 1.0, 1.0)
    _automaton: ahocorasick.Automaton | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"terms": self.terms, "exceptions": self.exceptions, "curve": self.curve}

    def __setstate__(self, state):
        self.__dict__.update(state, _automaton=None)

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            made = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                made.add_word(term, (len(term), weight))
            for phrase in self.exceptions:
                made.add_word(f" {phrase} ", (len(phrase) + 2, None))
            made.make_automaton()
            self._automaton = made
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight) of the longest term at each word, without those in exceptions."""
        if not len(self.automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            elif start not in best or length > best[start][0]:
                best[start] = (length, weight)
        found = [(s, w) for s, (_, w) in best.items()]
        if spared:
            found = [(s, w) for s, w in found if not any(a <= s < b for a, b in spared)]
        return sorted(found)

    def features(self, text: str) -> tuple[float, float, int]:
        """Summed weight on a log scale, the same by length, and the number of hits."""
        folded = fold(text)
        hits = self.hits(folded)
        total = sum(w for _, w in hits)
        words = folded.count(" ") - 1
        return math.log1p(total), total / math.sqrt(words + LENGTH_OFFSET), len(hits)

    def probability(self, features: tuple[float, float, int]) -> float:
        a, b, c = self.curve
        z = a + b * features[0] + c * features[1]
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _term_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch and term: texts with it by label, and which of 64 kinds of toxic texts had it."""
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = fold(text).split()
            kind = 1 << _kind(words) if toxic else 0
            terms = {f" {w} " for w in set(words)}
            terms.update(t[: n + 1] for t in list(terms) for n in PREFIXES if n + 2 < len(t))
            for term in terms:
                row = counts.get(term)
                if row is None:
                    row = counts[term] = [0, 0, 0]
                row[toxic] += 1
                row[2] |= kind
        yield pd.DataFrame(
            [(t, a, b, c - (1 << 64) if c >> 63 else c) for t, (a, b, c) in counts.items()],
            columns=["term", "clean", "toxic", "kinds"],
        )


def _kind(words: list[str]) -> int:
    """One of 64 kinds, mostly the same for copies of a text: its smallest three-word hash."""
    threes = zip(words, words[1:], words[2:], strict=False)
    least = min((zlib.crc32(" ".join(t).encode()) for t in threes), default=len(words))
    return (least * 2654435761 >> 7) % 64


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of at most TRAINING_ROWS documents outside the held-out quarter.

    Ids with several labels are toxic if one of them is. The sample is small enough to be sent to
    every executor, so that the texts are not shuffled.
    """
    chosen = (
        labels.where(F.col("toxic").isin(0, 1) & ~_held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAINING_ROWS)
    )
    texts = docs.select("doc_id", full_text().alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def _held_out():
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "UTF-8")) % 4 == HELD_OUT


def _terms(rows: DataFrame, clean: int, toxic: int) -> dict[str, float]:
    """Words and beginnings that mark toxic texts, with their weights."""
    terms = rows.groupBy("term").agg(
        F.sum("clean").alias("clean"),
        F.sum("toxic").alias("toxic"),
        F.bit_count(F.bit_or("kinds")).alias("kinds"),
    )
    ratio = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log(
        (F.col("clean") + 0.5) / (clean + 1)
    )
    seen = F.col("toxic") + F.col("clean")
    share = toxic / max(toxic + clean, 1)
    evidence = 2 * (
        F.col("toxic") * F.log(F.greatest(F.col("toxic"), F.lit(0.5)) / (seen * share))
        + F.col("clean") * F.log(F.greatest(F.col("clean"), F.lit(0.5)) / (seen * (1 - share)))
    )
    varied = 64 * (1 - F.exp(-F.col("toxic") / 64.0)) * KIND_SHARE
    kept = terms.withColumn("weight", ratio).where(
        (ratio >= MIN_RATIO)
        & (evidence >= MIN_EVIDENCE)
        & (F.col("kinds") >= F.greatest(varied, F.lit(MIN_KINDS)))
    )
    found = {row.term: float(row.weight) for row in kept.select("term", "weight").collect()}
    # A longer term adds nothing where a shorter one matches as surely.
    return {
        t: w
        for t, w in sorted(found.items())
        if not any(found.get(t[: n + 1], -1.0) >= w - 0.5 for n in PREFIXES if n + 1 < len(t))
    }


def _phrase_rows(lexicon: Lexicon):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                folded, phrases = fold(text), set()
                for start, _ in lexicon.hits(folded):
                    end = folded.index(" ", start + 1)
                    before = folded.rfind(" ", 0, start)
                    after = folded.find(" ", end + 1)
                    if before >= 0:
                        phrases.add(folded[before + 1 : end])
                    if after >= 0:
                        phrases.add(folded[start + 1 : after])
                rows += [(p, 1 - toxic, toxic) for p in phrases]
            yield pd.DataFrame(rows, columns=["phrase", "clean", "toxic"])

    return run


def _exceptions(sample: DataFrame, lexicon: Lexicon, clean: int, toxic: int) -> frozenset[str]:
    """Two-word phrases around a term that mark clean texts rather than toxic ones."""
    if not lexicon.terms:
        return frozenset()
    phrases = sample.mapInPandas(_phrase_rows(lexicon), "phrase STRING, clean LONG, toxic LONG")
    sums = phrases.groupBy("phrase").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    spared = sums.where(
        (F.col("c") >= EXCEPTION_DOCS) & (F.col("c") * toxic >= 2 * F.col("t") * clean)
    )
    return frozenset(row.phrase for row in spared.collect())


def _feature_rows(lexicon: Lexicon):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*lexicon.features(t)[:2], y) for t, y in batch[["text", "toxic"]].to_numpy()]
            yield pd.DataFrame(rows, columns=["a", "b", "toxic"])

    return run


def _curve(points: np.ndarray) -> tuple[float, float, float]:
    """A logistic fit of (feature, feature, label) by Newton's method, slightly damped."""
    x = np.column_stack([np.ones(len(points)), points[:, :2]])
    y, beta = points[:, 2], np.array([-2.0, 0.5, 0.5])
    ridge = np.array([1e-3, 1e-1, 1e-1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * beta
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curvature, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), max(0.0, float(beta[1])), max(0.0, float(beta[2]))


def train(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    exceptions: Iterable[str] = (),
) -> Lexicon:
    """A lexicon from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    ``exceptions`` are phrases spared besides the learned ones. Without labels of both kinds the
    lexicon is empty.
    """
    given = frozenset(fold(p).strip() for p in exceptions)
    sample = staged(spark, labelled_sample(docs, labels), "toxicity-sample")
    sizes = {row.toxic: row["count"] for row in sample.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return Lexicon({}, given)
    rows = sample.select("text", "toxic").mapInPandas(
        _term_rows, "term STRING, clean LONG, toxic LONG, kinds LONG"
    )
    lexicon = Lexicon(_terms(rows, clean, toxic), given)
    lexicon = Lexicon(lexicon.terms, given | _exceptions(sample, lexicon, clean, toxic))
    points = sample.select("text", "toxic").mapInPandas(
        _feature_rows(lexicon), "a DOUBLE, b DOUBLE, toxic INT"
    )
    lexicon.curve = _curve(points.toPandas().to_numpy(dtype=np.float64))
    return lexicon


def _score_rows(lexicon: Lexicon):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [lexicon.features(t) for t in texts]
            yield pd.DataFrame(
                {
                    "score": [lexicon.probability(f) for f in found],
                    "hits": np.array([f[2] for f in found], dtype=np.int64),
                }
            )

    return run


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``row``, ``text`` and a struct ``toxicity`` of score and hits; a null text counts as empty."""
    rate = F.pandas_udf(_score_rows(lexicon), "score DOUBLE, hits LONG")
    return boxed(docs).withColumn("toxicity", rate(full_text()))


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with held_out, score and predicted, trained on ``labels``.

    Empty and null texts have the score of a text without hits; repeated rows give repeated rows;
    columns other than doc_id and text are not read.
    """
    lexicon = train(spark, docs, labels)
    rows = scored(docs.select("doc_id", "text"), lexicon).select("row.doc_id", "toxicity")
    return rows.select(
        "doc_id",
        _held_out().alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("toxicity.hits").alias("hits"),
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, in their own columns, whatever their names."""
    lexicon = train(spark, docs, labels)
    rows = scored(docs, lexicon).where(F.col("toxicity.score") < THRESHOLD)
    return unboxed(rows, docs.columns)
