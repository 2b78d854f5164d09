"""A quality classifier that compresses.

Two zstandard dictionaries are built from pieces of good and of bad labelled texts. A text is cut
into pieces, each is compressed with either dictionary, and the difference of the two sizes over the
larger one says which kind it resembles. The difference over the whole text, its extremes among the
pieces (a text may be junk in parts) and how small the text gets at all (repetition suits both
dictionaries) are calibrated by a logistic curve, on labelled rows that went into no dictionary.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.llm.staging import boxed, full_text, staged, unboxed

#: At most so many labelled rows train the classifier, those with the smallest hashes; half of them
#: give pieces to the dictionaries, the others calibrate.
TRAINING_ROWS = 24_000
#: Bytes of a piece, of a dictionary, and different pieces that a dictionary is built from at most.
PIECE, DICTIONARY, DICTIONARY_PIECES = 512, 1 << 17, 20_000
LEVEL = 3
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
RIDGE = 1e-3


def _compressor(dictionary: bytes, kind: int) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(dictionary, dict_type=kind)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=made,
        write_checksum=False,
        write_content_size=False,
        write_dict_id=False,
    )


def dictionary_of(pieces: list[bytes]) -> tuple[bytes, int]:
    """A dictionary of some pieces and its kind. Pieces too few to train one are its content."""
    try:
        made = zstandard.train_dictionary(DICTIONARY, pieces)
        return made.as_bytes(), zstandard.DICT_TYPE_FULLDICT
    except zstandard.ZstdError:
        return b"\n".join(pieces)[:DICTIONARY], zstandard.DICT_TYPE_RAWCONTENT


def pieces_of(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


@dataclass
class Classifier:
    """``good`` and ``bad`` are dictionaries with their kinds. ``curve`` holds the least and largest
    features it was calibrated on, their means and deviations, and the weights; without one every
    text has the score ``share``."""

    good: tuple[bytes, int] = (b"", zstandard.DICT_TYPE_RAWCONTENT)
    bad: tuple[bytes, int] = (b"", zstandard.DICT_TYPE_RAWCONTENT)
    curve: tuple[np.ndarray, ...] | None = None
    share: float = 0.5
    _pair: list | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_pair": None}

    def sizes(self, text: str) -> np.ndarray:
        """Plain size and sizes under the good and the bad dictionary of each piece."""
        if self._pair is None:
            self._pair = [_compressor(*self.good), _compressor(*self.bad)]
        good, bad = self._pair
        rows = [(len(p), len(good.compress(p)), len(bad.compress(p))) for p in pieces_of(text)]
        return np.array(rows, dtype=np.float64).reshape(-1, 3)

    def features(self, text: str) -> np.ndarray:
        sizes = self.sizes(text)
        if not len(sizes):
            return np.zeros(6)
        plain, good, bad = sizes.T
        # A short last piece says little; a text of nothing else is judged by it.
        large = plain >= min(PIECE / 2, plain.max())
        apart, small = ((bad - good) / np.maximum(good, bad))[large], (good / plain)[large]
        whole = (bad.sum() - good.sum()) / max(good.sum(), bad.sum())
        ratio = good.sum() / plain.sum()
        return np.array(
            [whole, apart.min(), apart.max(), ratio, small.min(), np.log1p(plain.sum())]
        )

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(features), self.share)
        low, high, mean, deviation, weights = self.curve
        # A text that lies in a dictionary differs more than any that calibrated the curve.
        x = (_crossed(np.clip(features, low, high)) - mean) / deviation
        return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))


def _crossed(features: np.ndarray) -> np.ndarray:
    """Features, their squares, and products of them that bear on each other."""
    f, length = features[:, :5], features[:, 5:]
    products = [f[:, :1] * f[:, 3:4], f[:, 3:4] * f[:, 4:5]]
    return np.hstack([features, f**2, f * length, *products])


def logistic(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, ...]:
    """A logistic regression by Newton's method with a ridge, see :class:`Classifier`."""
    x = _crossed(features)
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / deviation])
    weights = np.zeros(z.shape[1])
    ridge = np.full(len(weights), RIDGE)
    ridge[0] = RIDGE / 100
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (labels - p) / len(z) - ridge * weights
        curvature = (z * (p * (1 - p))[:, None]).T @ z / len(z) + np.diag(ridge)
        step = np.linalg.solve(curvature, slope)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return features.min(axis=0), features.max(axis=0), mean, deviation, weights


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned; a missing id counts as an empty text."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "UTF-8")) % FOLDS == HELD_OUT


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, quality and half (0 or 1) of at most TRAINING_ROWS labelled documents that are not held
    out.

    Ids with several labels are bad if one of them is. The sample's ids are few enough to be sent to
    every executor, so that the texts are not shuffled.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAINING_ROWS)
    )
    texts = docs.select("doc_id", full_text().alias("text"))
    # By the text, so that copies of one text are never on both sides.
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half")
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "quality", half)


def _piece_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (p, y) for t, y in zip(batch["text"], batch["quality"], strict=True) for p in pieces_of(t)
        ]
        yield pd.DataFrame(rows, columns=["piece", "quality"])


def _dictionary(pieces: DataFrame, quality: int) -> tuple[bytes, int]:
    """A dictionary from the different pieces of one label with the smallest hashes; at most
    DICTIONARY_PIECES of them, 10 MB, come to the driver."""
    own = pieces.where(F.col("quality") == quality).select("piece").distinct()
    rows = own.orderBy(F.xxhash64("piece"), "piece").limit(DICTIONARY_PIECES).collect()
    return dictionary_of([bytes(r.piece) for r in rows])


def _feature_rows(classifier: Classifier):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (classifier.features(t).tolist(), y)
                for t, y in zip(batch["text"], batch["quality"], strict=True)
            ]
            yield pd.DataFrame(rows, columns=["f", "quality"])

    return run


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Classifier:
    """A classifier from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Without labels of both kinds every text has the same score, the share of good labels, or 0.5
    without any.
    """
    sample = staged(spark, labelled_sample(docs, labels), "quality-sample")
    sizes = {
        (r.quality, r.half): r["count"] for r in sample.groupBy("quality", "half").count().collect()
    }
    bad, good = ([sizes.get((q, h), 0) for h in (0, 1)] for q in (0, 1))
    total = sum(bad) + sum(good)
    share = sum(good) / total if total else 0.5
    if not sum(bad) or not sum(good):
        return Classifier(share=share)
    # Where a half lacks a label, as in very small samples, both halves serve both ends.
    apart = all(bad) and all(good)
    source = sample.where("half = 0") if apart else sample
    pieces = source.select("text", "quality").mapInPandas(
        _piece_rows, "piece BINARY, quality INT"
    )
    pieces = staged(spark, pieces, "quality-pieces")
    classifier = Classifier(_dictionary(pieces, 1), _dictionary(pieces, 0), share=share)
    rest = sample.where("half = 1") if apart else sample
    points = rest.select("text", "quality").mapInPandas(
        _feature_rows(classifier), "f ARRAY<DOUBLE>, quality INT"
    )
    # Rows of six numbers, at most TRAINING_ROWS of them.
    points = points.orderBy("quality", "f").toPandas()
    classifier.curve = logistic(
        np.array(points["f"].to_list()), points["quality"].to_numpy(dtype=np.float64)
    )
    return classifier


def _score_rows(shared):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            classifier = shared.value
            found = np.array([classifier.features(t) for t in texts]).reshape(-1, 6)
            scores = classifier.probabilities(found)
            yield pd.DataFrame({"score": scores, "difference": found[:, 0]})

    return run


def scored(spark: SparkSession, docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``row``, ``text`` and a struct ``quality`` of score and difference (positive for texts that
    the good dictionary makes smaller); a null text counts as empty."""
    shared = spark.sparkContext.broadcast(classifier)
    rate = F.pandas_udf(_score_rows(shared), "score DOUBLE, difference DOUBLE")
    return boxed(docs).withColumn("quality", rate(full_text()))


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with held_out, score, predicted and the size difference.

    Whole texts are compressed. Null and empty texts have the score of a text of no pieces; repeated
    rows give repeated rows; an empty table gives none; columns other than doc_id and text are not
    read.
    """
    classifier = train(spark, docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    rows = scored(spark, docs.select("doc_id", "text"), classifier)
    return rows.select(
        "row.doc_id",
        held_out("row.doc_id").alias("held_out"),
        F.col("quality.score").alias("score"),
        (F.col("quality.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("quality.difference").alias("difference"),
    )


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` at the threshold or above, in their own columns, whatever their names."""
    classifier = train(spark, docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    rows = scored(spark, docs, classifier).where(F.col("quality.score") >= THRESHOLD)
    return unboxed(rows, docs.columns)
