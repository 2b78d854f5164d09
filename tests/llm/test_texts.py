"""Toxicity, near copies, repeats and quality."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillsift.llm import near_dedup, ngram_quality, suffix_dedup, toxicity
from quillsift.llm.components import connected

WORDS = [f"w{a}{b}" for a in "bcdfgklm" for b in ("an", "el", "io", "us", "er")]


def prose(seed, n):
    pick = random.Random(seed)
    return [pick.choice(WORDS) + pick.choice("aeiou") + pick.choice("nrst") for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id LONG, text STRING")


@pytest.fixture(scope="module")
def insults(spark):
    """Clean and toxic texts; the term is disguised in some, and one phrase with it is harmless."""
    rows, marks = [], []
    for i in range(400):
        words = prose(i, 60)
        if i % 5 == 0:
            words[i % 50] = ["dreckig", "Dr3ckig", "DRECKIGER", "drеckig"][i // 5 % 4]
        elif i % 5 == 1:
            words[20:20] = ["dreckig", "washed"]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 5 == 0)))
    return frame(spark, rows), spark.createDataFrame(marks, "doc_id LONG, toxic INT"), dict(marks)


def test_terms_disguises_and_exceptions(spark, insults):
    docs, labels, marks = insults
    rows = toxicity.score_documents(spark, docs, labels).collect()
    wrong = [r.doc_id for r in rows if r.predicted != marks[r.doc_id]]
    assert len(wrong) <= 4
    assert all(0 <= r.score <= 1 for r in rows)


def test_given_exceptions():
    lexicon = toxicity.Lexicon({" trash ": 5.0}, frozenset(["trash can"]))
    assert lexicon.features("what tr4sh!")[2] == 1
    assert lexicon.features("the trash can")[2] == 0
    assert lexicon.features("")[2] == 0


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs, insults):
    labels = insults[1]
    rows = toxicity.score_documents(spark, odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_documents(spark, no_docs, labels).count() == 0
    kept = toxicity.drop_toxic(spark, odd_docs, labels.limit(0))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_components(spark):
    pick = random.Random(4)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1_000, 1_060)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.component for r in connected(spark, spark.createDataFrame(links, "a LONG, b LONG")).collect()}
    want = {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert got == want


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance():
    pick = np.random.default_rng(6)
    for _ in range(300):
        a = pick.integers(0, 6, pick.integers(0, 90)).astype(np.uint64)
        b = np.delete(a, pick.integers(0, len(a), 3)) if len(a) and pick.random() < 0.5 else a.copy()
        b[pick.random(len(b)) < 0.1] = 9
        true = edits(a.tolist(), b.tolist())
        for limit in (0, 2, true - 1, true, true + 3):
            if limit >= 0:
                assert near_dedup.distance_within(a, b, limit) == (true <= limit)


def test_classes_of_near_copies(spark):
    rows, group, pick = [], {}, random.Random(9)
    for g in range(12):
        base = prose(1_000 + g, 40 + 30 * g)
        for copy in range(1 + g % 4):
            words = list(base)
            for _ in range(int(len(words) * 0.04)):
                words[pick.randrange(len(words))] = "changed" + str(pick.randrange(99))
            text = " ".join(words) if copy % 2 else ". ".join(words).upper()
            rows.append((len(rows), text))
            group[len(rows) - 1] = g
    first = {}
    for i, g in group.items():
        first.setdefault(g, i)
    got = near_dedup.near_classes(spark, frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: first[g] for i, g in group.items()}
    assert {r.doc_id for r in got if r.kept} == set(first.values())


def test_texts_of_other_components_are_compared(spark, monkeypatch):
    """Without stars every link has to come from the comparison of blocks."""
    base = prose(5, 200)
    rows = [(i, " ".join(base[:i] + ["x"] + base[i + 1 :])) for i in range(6)]
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    real, calls = near_dedup._verified, []

    def verified(spark, pairs, *rest):
        calls.append(1)
        return real(spark, pairs.limit(0) if len(calls) == 1 else pairs, *rest)

    monkeypatch.setattr(near_dedup, "_verified", verified)
    got = near_dedup.near_classes(spark, frame(spark, rows)).collect()
    assert {r.class_id for r in got} == {0}


def only_star(monkeypatch, ids):
    """The comparison of centres finds one link, between the texts of two ids, or none."""
    real, calls = near_dedup._verified, []

    def verified(spark, pairs, texts, docs):
        calls.append(1)
        if len(calls) > 1:
            return real(spark, pairs, texts, docs)
        at = {r.doc_id: r.node for r in texts.collect()}
        links = [tuple(at[i] for i in ids)] if ids else []
        return spark.createDataFrame(links, "a LONG, b LONG")

    monkeypatch.setattr(near_dedup, "_verified", verified)


def agreeing(a, b):
    one, other = (near_dedup.sketch(near_dedup.shingles(near_dedup.word_hashes(t))) for t in (a, b))
    return int((one == other).sum())


def test_the_text_that_agrees_most_may_fail(spark, monkeypatch):
    """The second text of a component is tried where the first is not alike."""
    base = prose(55, 400)
    far = prose(159, 84) + base[84:]
    near = [f"changed{i}" if i % 23 == 20 else w for i, w in enumerate(base)]
    texts = [" ".join(t) for t in (base, far, near)]
    assert agreeing(texts[0], texts[1]) > agreeing(texts[0], texts[2]) >= 18
    words = [near_dedup.word_hashes(t) for t in texts]
    assert [near_dedup.alike(words[0], w) for w in words] == [True, False, True]
    only_star(monkeypatch, (1, 2))
    got = near_dedup.near_classes(spark, frame(spark, list(enumerate(texts)))).collect()
    assert {r.class_id for r in got} == {0}


def test_texts_that_agree_in_few_sketches_are_compared(spark, monkeypatch):
    """Scattered edits of a sixteenth of the words leave few sketches, and no centre links them."""
    base = prose(50, 400)
    near = [f"changed{i}" if i % 16 == 13 else w for i, w in enumerate(base)]
    texts = [" ".join(t) for t in (base, near)]
    assert 8 <= agreeing(*texts) < 18
    only_star(monkeypatch, ())
    got = near_dedup.near_classes(spark, frame(spark, list(enumerate(texts)))).collect()
    assert {r.class_id for r in got} == {0}


def test_block_links_against_brute_force():
    """Components of one bucket's texts, all pairs tried, from families that drift apart."""
    pick, texts = random.Random(3), []
    for family in range(6):
        words = prose(60, 60) + prose(600 + family, 40)
        for _ in range(12):
            words = [f"new{pick.random()}" if pick.random() < 0.09 else w for w in words]
            texts.append(near_dedup.word_hashes(" ".join(words)))
    sketches = np.array([near_dedup.sketch(near_dedup.shingles(t)) for t in texts])
    sketches[:, 0] = 7
    root, got = np.arange(len(texts)), np.arange(len(texts))
    for i in range(len(texts)):
        for j in range(i):
            agree = (sketches[i] == sketches[j]).sum() >= near_dedup.MIN_AGREEING
            if agree and near_dedup.alike(texts[i], texts[j]):
                root[root == root[i]] = root[j]
    assert 6 < len(set(root)) < len(texts)
    for key in np.unique(sketches):
        here = np.flatnonzero((sketches == key).any(axis=1))
        rows = pa.table(
            {
                "node": here,
                "component": here,
                "block": np.zeros(len(here), dtype=np.int32),
                "sketch": list(sketches[here]),
                "words": [texts[i].tobytes() for i in here],
            }
        )
        links = near_dedup._linked((pa.scalar(int(key), pa.uint64()), pa.scalar(0), pa.scalar(0)), rows)
        for a, b in zip(links["a"].to_pylist(), links["b"].to_pylist(), strict=True):
            got[got == got[a]] = got[b]
    same = root[:, None] == root[None, :]
    assert (same == (got[:, None] == got[None, :])).all()


def test_texts_without_words_are_told_apart():
    texts = ["", " \n", "!!", "! !", "?", "\U0001f600", "\U0001f601", "a!", "A"]
    batch = pa.record_batch(
        [pa.array(range(len(texts))), pa.array([b"k"] * len(texts)), pa.array(texts)],
        names=["doc_id", "text_key", "text"],
    )
    (rows,) = near_dedup._signature_rows([batch])
    keys = rows["words_key"].to_pylist()
    assert [keys.index(k) for k in keys] == [0, 0, 2, 2, 4, 5, 6, 7, 7]


def test_near_copies_of_odd_rows(spark, odd_docs, no_docs):
    rows = near_dedup.near_classes(spark, odd_docs).collect()
    assert len(rows) == odd_docs.count()
    classes = {r.doc_id: r.class_id for r in rows}
    assert classes[5] == classes[6] == 5 and {classes[i] for i in range(4)} == {0}
    kept = near_dedup.drop_near_copies(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({classes[i] for i in classes})
    assert near_dedup.near_classes(spark, no_docs).count() == 0


def brute_repeats(texts, span):
    starts = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - span + 1):
            if starts[t[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[: len(t)]])
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts():
    pick = random.Random(11)
    passages = [" ".join(prose(p, 120)) for p in range(4)]
    texts = []
    for i in range(60):
        parts = [" ".join(prose(100 + i, pick.randrange(80))), " ".join(prose(200 + i, 30))]
        if i % 2:
            cut = pick.randrange(300)
            parts.insert(1, passages[i % 4][cut : cut + pick.randrange(200, 700)])
        texts.append("é".join(parts))
    return [*texts, texts[0], texts[0], "ab" * 700, "z" * 401, "z" * 400, "q" * 399, "", None]


@pytest.mark.parametrize("segments", [2_048, 3])
@pytest.mark.parametrize("span", [suffix_dedup.SPAN, suffix_dedup.PASSAGE])
def test_repeats_against_brute_force(spark, monkeypatch, segments, span):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_SEGMENTS", segments)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 100_000)
    texts = repeated_texts()
    docs = frame(spark, list(enumerate(texts)))
    rows = {r.doc_id: r for r in suffix_dedup.dedup_bytes(spark, docs, span).collect()}
    want = brute_repeats([(t or "").encode() for t in texts], span)
    got = [tuple(rows[i])[1:5] for i in range(len(texts))]
    assert got == want
    for i, (size, gone, _, kept) in enumerate(want):
        rest = rows[i].text
        assert (rest == texts[i]) if not gone else len(rest.encode()) <= size - gone
        if gone and len(rest.encode()) == size - gone:
            assert hashlib.sha256(rest.encode()).hexdigest() == kept


def test_suffix_arrays_are_sorted():
    pick = np.random.default_rng(8)
    for size in (1, 2, 50, 3_000):
        text = bytes(pick.choice(list(b"ab"), size).tolist()) * 2 + b"\xff"
        order = suffix_dedup.suffix_array(suffix_dedup.words_at(text))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeats_of_odd_rows(spark, odd_docs, no_docs):
    got = suffix_dedup.cut_repeats(spark, odd_docs)
    assert got.columns == odd_docs.columns and got.count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[0] is None and texts[5] == "Same text, twice over." and texts[8] == ""
    assert suffix_dedup.cut_repeats(spark, no_docs).count() == 0
    assert suffix_dedup.dedup_bytes(spark, no_docs).count() == 0


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {
        k
        for i in range(len(words) - 2)
        if windows[tuple(words[i : i + 3])] > 1
        for k in range(i, i + 3)
    }
    lines = text.split("\n")
    dup = sum(
        bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i]
        for i, line in enumerate(lines)
    )
    chars = sum(map(len, words))
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), dup, len(again)


def test_base_counts():
    texts = ["", " \n", "a b c a b c", "x\nx\n\n\nx #*", "a a a a", "é b\x1cc\x0bd", "one two"]
    texts += [" ".join(prose(i, 80)[:40] * (1 + i % 2)) for i in range(6)]
    assert [ngram_quality.base_counts(t) for t in texts] == [brute_base(t) for t in texts]


def test_model_probabilities_add_up():
    grams = np.concatenate([ngram_quality.grams_of(" ".join(prose(i, 200))) for i in range(20)])
    keys, counts = np.unique(grams, return_counts=True)
    model = ngram_quality.build(keys.astype(np.int64), counts)
    for context in (keys[3] >> 6, keys[-1] >> 6, 5 << 12 | 9 << 6 | 40):
        every = (int(context) << 6) + np.arange(ngram_quality.CLASSES)
        assert abs(np.exp(model.scores(every.astype(np.int64))).sum() - 1) < 1e-3


def test_quality_rejects_what_reads_unlike_its_language(spark):
    rows = [(i, " ".join(prose(i, 90)), "en") for i in range(200)]
    shuffled = ["".join(random.Random(i).sample(t, len(t))) for i, (_, t, _) in enumerate(rows[:4])]
    rows += [(1_000 + i, t.replace(" ", "") + " a b" * 40, "en") for i, t in enumerate(shuffled)]
    rows += [(2_000 + i, " ".join(w.upper() + "!!" for w in prose(i, 90)), "en") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    got = {r.doc_id: r for r in ngram_quality.judged(spark, docs).collect()}
    assert all(got[i].kept for i in range(200))
    assert not any(got[2_000 + i].kept for i in range(4))


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    rows = ngram_quality.judged(spark, odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert [r.base_failed for r in rows if r.doc_id in (0, 1)] == [True, True]
    assert ngram_quality.judged(spark, no_docs).count() == 0
