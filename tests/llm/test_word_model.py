"""The model of words that op9 scores texts with, against a plain one."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from quillsift.llm import ngram_quality, word_model


def histogram(counts):
    values = list(counts)
    return [sum(v == i for v in values) for i in range(1, 5)]


def plain_model(texts):
    """Log probability of each text's words by modified Kneser-Ney over all other texts; discounts
    and the number of different words are those of all texts."""
    own = [Counter(zip(["", *t.split()], t.split(), strict=False)) for t in texts]
    every = sum(own, Counter())
    high = word_model.discounts(histogram(every.values()))
    low = word_model.discounts(histogram(Counter(w for _, w in every).values()))
    n_words = len({w for _, w in every})

    def probability(counts):
        total, kinds, before = Counter(), {}, Counter()
        for (v, w), n in counts.items():
            total[v] += n
            kinds.setdefault(v, []).append(n)
            before[w] += 1
        rest = sum(low[min(n, 3)] for n in before.values())

        def p(v, w):
            n = before[w]
            lower = (n - low[min(n, 3)] + rest / n_words) / len(counts) if counts else 1 / n_words
            if not total[v]:
                return lower
            n = counts[v, w]
            weight = sum(high[min(k, 3)] for k in kinds[v])
            return (n - high[min(n, 3)] + weight * lower) / total[v]

        return p

    models = [probability(every - o) for o in own]
    sums = [sum(n * math.log(p(*g)) for g, n in o.items()) for o, p in zip(own, models, strict=True)]
    return sums, models, {w for _, w in every}


def random_texts(seed, count):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    return [
        " ".join(pick.choices(words, [1 / (i + 1) for i in range(40)], k=pick.randrange(1, 60)))
        for _ in range(count)
    ]


def test_words_are_scored_by_all_other_texts(spark):
    texts = random_texts(1, 60) + ["only here twice only here", "w1 w2 w3", "w1 w2 w3"]
    sums, models, words = plain_model(texts)
    for p in models[:3]:
        assert sum(p("w1", w) for w in words) == pytest.approx(1)
    rows = [(i, t, "en") for i, t in enumerate([*texts, "", None])]
    # Three tasks at least, so that no block holds all texts.
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING").repartition(3)
    got = {r.doc_id: r.perplexity for r in ngram_quality.judged(spark, docs).collect()}
    assert got[len(texts)] is None and got[len(texts) + 1] is None
    for i, (text, total) in enumerate(zip(texts, sums, strict=True)):
        assert math.log(got[i]) == pytest.approx(-total / len(text.split()), abs=1e-9)


def test_quality_rejects_words_in_senseless_order(spark):
    pick = random.Random(5)
    # All begin and end alike, so that four characters never tell which word follows which.
    names = [f"a{''.join(pick.choices('abcdefghijklmnop', k=6))}a" for _ in range(300)]
    follows = {w: pick.sample(names, 4) for w in names}

    def text():
        out = [pick.choice(names)]
        while len(out) < 150:
            out.append(pick.choice(follows[out[-1]]))
        return out

    texts = [text() for _ in range(200)]
    rows = [(i, " ".join(t), "en") for i, t in enumerate(texts)]
    rows += [(1_000 + i, " ".join(pick.sample(t, len(t))), "en") for i, t in enumerate(texts[:6])]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    kept = {r.doc_id: r.kept for r in ngram_quality.judged(spark, docs).collect()}
    assert all(kept[i] for i in range(200))
    assert not any(kept[1_000 + i] for i in range(6))


def test_packed_blocks_come_back():
    keys = [word_model.word_keys(t) for t in (b"a b a", b" ", b"\nc a\tb ")]
    block = word_model.Block.of(keys)
    assert len({*keys[0], *keys[2]}) == 3 and keys[0][0] == keys[0][2] == keys[2][1]
    again = word_model.Block.unpacked(block.packed())
    assert again.words.tolist() == block.words.tolist()
    assert again.places.tolist() == block.places.tolist() and again.sizes.tolist() == [3, 0, 3]
    assert block.pairs[3].tolist() == again.pairs[3].tolist() and block.pairs[3].sum() == 6


def test_a_block_is_scored_in_slices(monkeypatch):
    pick = np.random.default_rng(3)
    sizes = [0, 5, *[500] * 600, 40_000, 0, 0, 7]
    keys = [pick.zipf(1.3, n) % 50_000 + 1 for n in sizes]
    block = word_model.Block.of(keys)
    total = block.pairs[3] + 1
    words = np.ones((5, len(block.words)), dtype=np.int64)
    stats = [90, 80, 70, 60, 300, 1_000, 5_000]

    def measured(size):
        monkeypatch.setattr(word_model, "SLICE", size)
        tracemalloc.start()
        sums = word_model.log_sums(block, total, words, stats, stats)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return sums, peak

    whole, large = measured(1 << 40)
    found, small = measured(1 << 12)
    assert np.array_equal(whole, found)
    assert small < large / 4


def test_frequent_words_make_letters_shorter():
    pick = np.random.default_rng(4)
    names = pick.integers(1, 1 << word_model.KEY_BITS, 60_000)
    keys = [names[(pick.zipf(1.2, 1_000) - 1) % 60_000] for _ in range(200)]
    # All but every third word have ranks, in the order of how frequent they are.
    common = word_model.Common(names[np.arange(60_000) % 3 < 2])
    plain, block = word_model.Block.of(keys), word_model.Block.of(keys, common)

    again = word_model.Block.unpacked(block.packed(), common)
    assert again.words.tolist() == plain.words.tolist()
    assert again.places.tolist() == plain.places.tolist()
    assert len(block.packed()) < len(plain.packed())

    pairs, left, right, n, _ = block.pairs
    assert len(set(pairs.tolist())) == len(pairs) == len(plain.pairs[0])
    ranks = common.ranks(block.words)
    assert ((pairs & 1) == ((ranks[left] == 0) | (ranks[right] == 0))).all()

    def letters(own):
        dealt = word_model._dealt(
            own.pairs[0], [own.pairs[3]], 1, 3, word_model.PAIR_BITS, word_model.pair_letter
        )
        return [packed for _, _, _, packed, _ in dealt]

    found = [word_model.unpack(x, 2) for x in letters(block)]
    read = [(k, c) for x in found for k, c in zip(word_model.read_pairs(x[0]), x[1], strict=True)]
    assert sorted(read) == list(zip(pairs, n, strict=True))
    # An even part for each, and much shorter than hashes.
    assert max(x.shape[1] for x in found) < 1.05 * len(pairs) / 3
    assert sum(map(len, letters(block))) < 0.8 * sum(map(len, letters(plain)))


def test_the_ends_of_ranks_have_keys_of_their_own():
    some = np.r_[1:70, (1 << word_model.RANK_BITS) - np.arange(1, 70), 1 << np.arange(8, 18)]
    left, right = np.repeat(some, len(some)), np.tile(some, len(some))
    keys = np.unique(word_model._ranked_keys(left, right))
    assert len(keys) == len(np.unique(some)) ** 2 and keys[-1] < 1 << word_model.PAIR_BITS
    order, steps = word_model.pair_letter(keys)
    assert word_model.read_pairs(steps).tolist() == keys[order].tolist()
    order, steps = word_model.pair_letter(np.zeros(0, dtype=np.int64))
    assert len(order) == len(word_model.read_pairs(steps)) == 0


def test_scores_do_not_depend_on_the_frequent_words(spark, monkeypatch):
    rows = [(i, t, "en") for i, t in enumerate(random_texts(2, 40))]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING").repartition(3)

    def scores():
        return {r.doc_id: r.perplexity for r in ngram_quality.judged(spark, docs).collect()}

    found = scores()
    words = word_model.word_keys(b" ".join(b"w%d" % i for i in range(0, 40, 2)))
    for common in (word_model.NONE, word_model.Common(words)):
        monkeypatch.setattr(word_model, "common_words", lambda *_, c=common: c)
        assert scores() == pytest.approx(found, abs=1e-12)


def test_answers_about_pairs_are_written_once(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id LONG, text STRING, lang STRING")
    rows = docs.select("doc_id", "lang", "text")

    def read(batch):
        yield batch.select(["doc_id"]), [word_model.word_keys(b"a b")] * batch.num_rows

    scored = word_model.scored(rows, read, "doc_id LONG")
    assert scored.count() == 1
    frame = scored._jdf.queryExecution()
    frame.executedPlan().execute().count()
    plan = frame.executedPlan().toString().split("== Initial Plan ==")[0]
    # Letters of blocks, of pairs and of words, and answers about words: nothing is dealt twice.
    assert len([x for x in plan.splitlines() if "Exchange hash" in x and "Reused" not in x]) == 4
