"""The compression classifier: held-out quality, odd rows, and sizes against plain compression."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
import zstandard

from quillsift.llm import compression_quality as cq

SF = "/root/testdata/sf0.01"


def area(scores, labels):
    """The share of (good, bad) pairs in the right order, ties a half."""
    good, bad = scores[labels == 1], scores[labels == 0]
    above = (good[:, None] > bad).sum() + 0.5 * (good[:, None] == bad).sum()
    return above / (len(good) * len(bad))


@pytest.fixture(scope="module")
def judged(spark, sf_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, cq.score_documents(spark, docs, labels).toPandas()


def test_held_out_rows(judged):
    docs, labels, found = judged
    assert len(found) == docs.count()
    crc = found["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (found["held_out"] == crc).all()
    assert ((found["score"] >= 0) & (found["score"] <= 1)).all()
    assert (found["predicted"] == (found["score"] >= 0.3)).all()
    rows = found[found["held_out"]].merge(labels.toPandas(), on="doc_id")
    quality, scores = rows["quality"].to_numpy(), rows["score"].to_numpy()
    assert area(scores, quality) > 0.9
    assert (rows["predicted"] == quality).mean() > 0.9
    # Texts that lie in a dictionary differ more than others; they must not leave the curve.
    known = found[~found["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (known["predicted"] == known["quality"]).mean() > 0.95


def test_labels_of_held_out_rows_are_not_learned(spark, judged):
    docs, labels, found = judged
    turned = labels.withColumn(
        "quality", cq.F.when(cq.held_out(), 1 - cq.F.col("quality")).otherwise(cq.F.col("quality"))
    )
    again = cq.score_documents(spark, docs, turned).toPandas()
    a, b = (d.sort_values("doc_id")["score"].to_numpy() for d in (found, again))
    assert np.array_equal(a, b)


def test_sizes_are_those_of_plain_compression():
    pieces = [f"the quick brown fox {i} jumps over it".encode() for i in range(3000)]
    made, kind = cq.dictionary_of(pieces)
    classifier = cq.Classifier((made, kind), (b"junk &&& ***", zstandard.DICT_TYPE_RAWCONTENT))
    text = "the quick brown fox ä " * 90
    for plain, good, bad in classifier.sizes(text).tolist():
        assert plain <= cq.PIECE and good < bad
    data = text.encode()
    parts = [data[i : i + cq.PIECE] for i in range(0, len(data), cq.PIECE)]
    assert classifier.sizes(text)[:, 0].sum() == len(data)
    dictionary = zstandard.ZstdCompressionDict(made, dict_type=kind)
    plain = zstandard.ZstdCompressor(
        level=cq.LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False,
        write_dict_id=False,
    )
    assert classifier.sizes(text)[:, 1].tolist() == [len(plain.compress(p)) for p in parts]
    # Junk anywhere in a long text shows in its least difference: no prefix decides.
    late = classifier.features("the quick brown fox " * 900 + "junk &&& *** " * 60)
    assert late[1] < classifier.features("the quick brown fox " * 940)[1]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(i, i % 2, 0, "x") for i in range(10)] + [(None, 1, 0, "x"), (3, None, 0, "x"), (4, 7, 0, "x")]
    labels = spark.createDataFrame(rows, "doc_id LONG, quality INT, toxic INT, text STRING")
    found = cq.score_documents(spark, odd_docs, labels).collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert cq.score_documents(spark, no_docs, labels).count() == 0
    kept = cq.keep_good(spark, odd_docs, labels)
    assert kept.columns == odd_docs.columns
    none = labels.where("doc_id < 0")
    assert {r.score for r in cq.score_documents(spark, odd_docs, none).collect()} == {0.5}
    one = labels.where("quality = 1")
    assert {r.score for r in cq.score_documents(spark, odd_docs, one).collect()} == {1.0}
