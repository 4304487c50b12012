import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import Row

from aerolith.llm import lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


def _segmentations(word, pieces):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces.number:
            for rest in _segmentations(word[n:], pieces):
                yield [pieces.number[word[:n]], *rest]


def test_forward_is_the_sum_of_all_segmentations():
    pieces = lm.Pieces.load(PATH)
    lattice = lm.Lattice(pieces, pieces.weight)
    for word in ("the", "ererti", "rereble", "ciónmente", "a", "fürü"):
        every = list(_segmentations(lm.START + word, pieces))
        brute = math.log10(math.fsum(math.exp(sum(pieces.weight[k] for k in s)) for s in every))
        assert lattice.word_log10(word) == pytest.approx(brute, rel=1e-12)
        into = [0.0] * len(pieces.weight)
        lattice.expect(word, 3, into)
        weights = [math.exp(sum(pieces.weight[k] for k in s)) for s in every]
        brute = Counter()
        for s, w in zip(every, weights, strict=True):
            for k in s:
                brute[k] += 3 * w / sum(weights)
        assert {k: x for k, x in enumerate(into) if x} == pytest.approx(dict(brute), rel=1e-9)


def test_sums_without_logs_are_those_by_logs():
    pieces = lm.Pieces.load(PATH)
    lattice = lm.Lattice(pieces, pieces.weight)
    for word in ("the", "fürü", "\U00012345\x00", "un" * 12, "xyz" * 400):
        by_logs, own = [0.0] * len(pieces.weight), [0.0] * len(pieces.weight)
        likely = lattice._expect_by_logs(word, 3, by_logs)
        assert lattice.expect(word, 3, own) == pytest.approx(likely, rel=1e-12) and own == pytest.approx(by_logs, rel=1e-9)
        assert lattice.word_log10(word) == pytest.approx(lattice.forward(lm.START + word)[-1] / lm.LOG10, rel=1e-12)
        assert (lattice.plain(lm.START + word) > lm.LEAST_PLAIN) == (len(word) < 100)  # long ones go by logs


def test_unknown_characters_are_spelled_and_long_words_scored():
    pieces = lm.Pieces.load(PATH)
    lattice = lm.Lattice(pieces, pieces.weight)
    assert math.isfinite(lattice.word_log10("\U00012345\x00"))
    assert math.isfinite(lattice.word_log10("xyz" * 20000))


def test_words_in_a_row_share_what_they_start_with(spark):
    pieces = lm.Pieces.load(PATH)
    lattice = lm.Lattice(pieces, pieces.weight)
    ordered = sorted(["the", "then", "there", "therefore", "fürü", "für\U00012345a", "für\U00012345b", "un" * 12, "un" * 13, "xyz" * 40, "xyz" * 41, "xyz" * 400, "\x00", "the"])
    for words in (ordered, ordered[::2] + ordered[1::2]):
        both, own = lm.Shared(lattice), [0.0] * len(pieces.weight)
        for n, word in enumerate(words, 1):
            assert both.expect(word, n) == pytest.approx(lattice.expect(word, n, own), rel=1e-12)
        assert both.expected() == pytest.approx(own, rel=1e-9)
        assert [both.word_log10(x) for x in words] == pytest.approx([lattice.word_log10(x) for x in words], rel=1e-12)

    # letters that are looked at: each of a prefix once, though a hundred words have it
    shared, letters = lm.Shared(lattice), []

    class Root(dict):
        def get(self, c):
            letters.append(c)
            return super().get(c)

    shared.root = Root(shared.root)
    shared.live = [[(0, shared.root)]]
    for k in range(100):
        shared.expect(f"unterhaltung{k:02}", 1)
    assert len(letters) == len(lm.START + "unterhaltung") + 10 + 100
    # and words come so
    docs = spark.createDataFrame([(f"{k * 7919 % 1000:03} x", True) for k in range(1000)], "text string, train boolean").repartition(8)
    parts = [[r.word for r in rows] for rows in lm.count_words(docs).rdd.glom().collect()]
    assert sum(map(len, parts)) == 1001 and all(x == sorted(x) for x in parts)


@pytest.mark.parametrize("frequent", [0, 3, 1 << 17])
def test_base_and_model_against_brute_force(spark, frequent):
    texts = [(1, "The cat  sat"), (2, "the\tdog\x0bsat the"), (2, "the\tdog\x0bsat the"), (3, ""), (4, None), (None, "dog Dog ÄRGER ärger"), (6, "cat the the unseen1"), (7, "w" * 5000)]
    train = {i: zlib.crc32(str(i if i is not None else "").encode()) % 2 == 0 or i in (1, 2) for i, _ in texts}
    docs = spark.createDataFrame([Row(doc_id=i, text=t, train=train[i], word="clash", n=1) for i, t in texts], "doc_id long, text string, train boolean, word string, n int")
    got = lm.score(docs, PATH, frequent=frequent).collect()
    assert len(got) == len(texts)
    words = {k: [w for w in (t or "").encode().lower().split()] for k, (_, t) in enumerate(texts)}
    counts = Counter(w for k, (i, _) in enumerate(texts) if train[i] for w in words[k])
    n_docs = sum(train[i] for i, _ in texts)
    total, distinct = sum(counts.values()) + n_docs, len(counts) + 1
    unseen = (sum(n == 1 for n in counts.values()) + 1) / (total + 1)
    pieces = lm.Pieces.load(PATH)
    weight, likely = pieces.weight, []
    for _ in range(lm.MOST_STEPS):
        into = [0.0] * len(weight)
        step = lm.Lattice(pieces, weight)
        each = [n * step.word_log10(w.decode()) for w, n in counts.items()]
        likely.append(math.fsum(each) + n_docs * weight[pieces.end] / lm.LOG10)
        assert math.fsum(step.expect(w.decode(), n, into) for w, n in counts.items()) / lm.LOG10 == pytest.approx(math.fsum(each))
        for k in [*pieces.number.values(), *pieces.byte]:
            into[k] += lm.FLOOR
        into[pieces.end] = n_docs + lm.FLOOR
        weight = lm._logs(into)
        if len(likely) > 1 and likely[-1] - likely[-2] < lm.LEAST_GAIN * total:
            break
    assert math.fsum(math.exp(x) for x in weight) == pytest.approx(1)
    lattice = lm.Lattice(pieces, weight)
    expected = []
    for k, (i, _) in enumerate(texts):
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words[k]) + math.log10((n_docs + 1) / (total + distinct + 1))
        model = math.log10((1 - unseen) * n_docs / total + unseen * math.exp(weight[pieces.end]))
        marginal = weight[pieces.end] / lm.LOG10 + sum(lattice.word_log10(w.decode()) for w in words[k])
        for w in words[k]:
            sub = math.log10(unseen) + lattice.word_log10(w.decode())
            model += math.log10((1 - unseen) * counts[w] / total + 10**sub) if counts[w] else sub
        expected.append((i or 0, train[i], len(words[k]) + 1, 1 + sum(counts[w] > 0 for w in words[k]), total, round(base, 8), round(marginal, 8), round(model, 8)))
    assert sorted((r.id or 0, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8), round(r.score, 8), round(r.mixture_score, 8)) for r in got) == sorted(expected)


def test_empty_table_and_no_training(spark):
    kind = "doc_id long, text string, train boolean"
    assert lm.score(spark.createDataFrame([], kind), PATH).count() == 0
    r = lm.score(spark.createDataFrame([(1, "a b", False)], kind), PATH).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
    assert math.isfinite(r.score)


def test_steps_make_training_texts_likelier_and_end(spark):
    texts = ["the rain in the plain", "a plainer rain rained", "unseen unplained plaining"] * 3
    docs = spark.createDataFrame([(k, t, True) for k, t in enumerate(texts)], "doc_id long, text string, train boolean")

    def likely(steps, gain=0.0):
        return math.fsum(r.score for r in lm.score(docs, PATH, most_steps=steps, least_gain=gain).collect())

    by_step = [likely(k) for k in (0, 1, 2, 4)]
    assert by_step == sorted(by_step) and by_step[0] < by_step[1] < by_step[2]
    assert likely(9, gain=1e9) == pytest.approx(likely(2))  # the second step is the first whose gain is known
