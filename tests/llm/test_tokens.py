"""SentencePiece lattice and packing."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillsift.llm import packing
from quillsift.llm import sentencepiece_lattice as lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_ids_are_those_of_the_library(spark, odd_docs, sf_dir):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 40")
    docs = docs.select("doc_id", "text").unionByName(
        odd_docs.select((F.col("doc_id") + 1_000).alias("doc_id"), "text")
    )
    # Few common words, so that both ways to a word's ids are taken.
    rows = lattice.encode_documents(spark, docs, MODEL, common_words=50).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == sp.encode(texts[r.doc_id]), texts[r.doc_id][:80]
        assert r.round_trip == ("▁" not in texts[r.doc_id])


def test_encoding_nothing(spark, no_docs):
    assert lattice.encode_documents(spark, no_docs, MODEL).count() == 0


def test_decode(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["Hello  wörld\n𝔘 ", ""]
    df = spark.createDataFrame([(sp.encode(t),) for t in texts] + [(None,)], "ids ARRAY<INT>")
    assert [r.text for r in lattice.decode(df, MODEL).collect()] == [*texts, None]


def best_path(word, scores, worst):
    """All ways to cut a word, the best first."""
    found = []
    for bits in itertools.product([0, 1], repeat=len(word) - 1):
        cuts = [0, *[i + 1 for i, b in enumerate(bits) if b], len(word)]
        parts = [word[a:b] for a, b in itertools.pairwise(cuts)]
        if all(p in scores or len(p) == 1 for p in parts):
            found.append((sum(scores.get(p, worst) for p in parts), parts))
    return max(found)


def test_viterbi_finds_the_best_path(spark):
    random = np.random.default_rng(2)
    parts = {"".join(random.choice(list("abc"), n)) for n in (1, 1, 2, 2, 3, 3, 4) for _ in range(6)}
    pieces = tuple(sorted(parts - {"c"}))
    scores = tuple(float(-x) for x in random.uniform(1, 9, len(pieces)).round(3))
    model = lattice.Model(pieces, scores, (True,) * len(pieces), 1_000, 4)
    words = {"".join(random.choice(list("abcd"), n)) for n in range(1, 10) for _ in range(6)}
    df = spark.createDataFrame([(w, 1) for w in words], "word STRING, n LONG")
    rows = lattice.lattice(df, model, spark).select("word", lattice.viterbi_fold(model).alias("ids"))
    known, worst = dict(zip(pieces, scores, strict=True)), min(scores) - 10
    for word, ids in rows.collect():
        text = [pieces[i] if i < 1_000 else chr(i - 1_000) for i in ids]
        total, parts = best_path(word, known, worst)
        assert "".join(text) == word
        assert abs(sum(known.get(p, worst) for p in text) - total) < 1e-9, (word, text, parts)


def test_words_stay_off_the_driver(spark, odd_docs, monkeypatch):
    def refused(*_):
        raise AssertionError("rows go through the driver")

    for name in ("toPandas", "collect", "toArrow"):
        monkeypatch.setattr(type(odd_docs), name, refused)
    rows = lattice.encode_documents(spark, odd_docs, MODEL)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == odd_docs.count()


def test_folded_together_words_have_the_ids_of_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    chance = random.Random(4)
    letters = ["abcdeinrst", "aàéñößüaeio", "ab 12.,;(){}", "жшя漢字😀ab", "a"]
    texts = ["".join(chance.choices(s, k=n)) for s in letters for n in (1, 2, 5, 9, 40, 3_000)]
    model = lattice.Model.load(MODEL)
    pattern = re.compile(model.word_pattern)
    cut = [pattern.findall(f"▁{t.replace(' ', '▁')}") for t in texts]
    # Kept words are given up between texts, kept, or never kept.
    for kept in (0, 20, 1_000_000):
        ids = lattice.WordIds(model, "bpe", kept)
        for _ in range(2):
            for text, words in zip(texts, cut, strict=True):
                found = np.frombuffer(ids.texts([words])[0], dtype="<i4").tolist()
                assert found == sp.encode(text), text[:60]
        assert len(ids.known) <= max(kept, max(map(len, map(set, cut))))
        assert max(map(len, ids.known), default=0) <= lattice.KEPT_LENGTH


def test_both_viterbi_folds_agree(spark):
    chance = random.Random(5)
    parts = {"".join(chance.choices("abc", k=n)) for n in (1, 1, 2, 2, 3, 3, 4) for _ in range(6)}
    pieces = tuple(sorted(parts - {"c"}))
    scores = tuple(round(-chance.uniform(1, 9), 3) for _ in pieces)
    model = lattice.Model(pieces, scores, (True,) * len(pieces), 1_000, 4)
    words = sorted({"".join(chance.choices("abcdé", k=n)) for n in range(1, 30) for _ in range(9)})
    found = lattice.WordIds(model, "unigram", 9).encode(words)
    df = spark.createDataFrame([(w, 1) for w in words], "word STRING, n LONG")
    rows = lattice.lattice(df, model, spark).select("word", lattice.viterbi_fold(model).alias("ids"))
    for word, ids in rows.collect():
        assert np.frombuffer(found[word], dtype="<i4").tolist() == ids, word


def packed(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return bins


def test_pieces_are_those_of_the_tokenizer(spark, odd_docs, no_docs):
    extra = [(100, "it's 'RE we'll <|endoftext|>x a|b | c"), (101, "ab|cd " * 9_000)]
    docs = odd_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame(extra, "doc_id LONG, text STRING")
    )
    rows = packing.pack_documents(spark, docs, WORDS).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    want = []
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4_096)):
            part = np.array(ids[at : at + 4_096], dtype="<u4")
            want.append((r.doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    packed(rows)
    assert packing.pack_documents(spark, no_docs, WORDS).count() == 0


def test_packings_of_several_levels_are_tight(spark, monkeypatch):
    random = np.random.default_rng(7)
    lengths = random.integers(1, 2_500, 3_000).tolist()
    rows = [(i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    monkeypatch.setattr(packing, "BLOCK_ITEMS", 128)
    monkeypatch.setattr(packing, "LAST_BLOCK_ITEMS", 256)
    result = packing.pack(spark, spark.createDataFrame(rows, packing.PIECES)).collect()
    assert sorted((r.doc_id, r.length) for r in result) == sorted(enumerate(lengths))
    least = -(-sum(lengths) // packing.CAPACITY)
    assert len(packed(result)) <= least * 1.005 + 1


def test_children_hold_every_piece_once():
    random = np.random.default_rng(1)
    evolution = packing.Evolution(random.integers(600, 2_300, 200), 4_096, 3)
    first, second = (evolution.best_fit([], range(200), noise) for noise in (0.0, 0.5))
    for child in (evolution.cross(first, second), evolution.mutate(first), evolution.run([])):
        assert sorted(i for b in child for i in b) == list(range(200))
        assert max(map(evolution.fill, child)) <= 4_096
    assert len(evolution.run([second])) <= len(first)


def test_words_put_together_from_letters_and_signs(tmp_path):
    """Letters, signs behind them, either case and odd words against whole-text encoding, also where
    little is kept and words are forgotten and met again."""
    tokens = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    assert tokens.splits and tokens.folds
    tokens.known.kept, tokens.parts.kept = 40, 25
    pick = random.Random(4)
    stems = ["thing", "Thing", "THING", "é", "ÉTÉ", "İstanbul", "ΣΑΣ", "ﬁne", "x1", "don't", "it's", "'s", "ǅ",
             "한글", "á", "́", "q" * 60, "naïve", "Straße", "1", "²", "٣", "_a", "a_b", "日本語"]
    tails = ["", "", ".", ",", "...", "###", "$$$", "&&&", "!!", "|", "'", ".'", "%)", "–", "́", ".s"]
    texts = [
        " ".join(pick.choice(stems) + pick.choice(tails) for _ in range(pick.randrange(60)))
        for _ in range(200)
    ]
    for first in range(0, len(texts), 7):
        part = texts[first : first + 7]
        for text, ids in zip(part, tokens.encode(part), strict=True):
            whole = tokens.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == whole, text
