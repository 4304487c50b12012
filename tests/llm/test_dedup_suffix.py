import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from aerolith.llm import dedup_suffix as d


def brute(texts, depth):
    data = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + depth] for t in data for i in range(len(t) - depth + 1))
    out = []
    for t in data:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - depth + 1):
            if counts[t[i : i + depth]] > 1:
                gone[i : i + depth] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1))
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng, n, words=300):
    vocab = ["".join(rng.choice("abcdeéü日") for _ in range(rng.randint(1, 7))) for _ in range(words)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passages = [text(rng.randint(20, 200)) for _ in range(6)]
    out = []
    for k in range(n):
        parts = [text(rng.randint(0, 150))]
        while rng.random() < 0.6:
            parts += [rng.choice(passages)[rng.randint(0, 30) :], text(rng.randint(0, 120))]
        out.append(" ".join(parts))
        if rng.random() < 0.2:
            out.append(rng.choice(out))
        if rng.random() < 0.2:
            x = list(rng.choice(out))
            for _ in range(rng.randint(1, 4)):
                if x:
                    x[rng.randrange(len(x))] = "Q"
            out.append("".join(x))
    return [*out, None, "", "a" * 399, "x" * 400, "x" * 900, "ab" * 450, "ab" * 600, passages[0] * 5]


def test_the_cover_covers():
    assert {(a - b) % d.PERIOD for a in d.COVER for b in d.COVER} == set(range(d.PERIOD))


def brute_passages(texts, words):
    """(maximal runs, bytes in them) of strings of words that are found twice, for each text."""
    at = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
    own = [[(t or "").encode()[a:b] for a, b in spans] for t, spans in zip(texts, at, strict=True)]
    counts = Counter(tuple(w[i : i + words]) for w in own for i in range(len(w) - words + 1))
    out = []
    for w, spans in zip(own, at, strict=True):
        runs = []
        for i in range(len(w) - words + 1):
            if counts[tuple(w[i : i + words])] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + words
                else:
                    runs.append([i, i + words])
        out.append((len(runs), sum(spans[b - 1][1] - spans[a][0] for a, b in runs)))
    return out


@pytest.mark.parametrize("bucket", [256, 2])
def test_against_brute_force(spark, bucket):
    rng = random.Random(bucket)
    short = " ".join(f"w{k}" for k in range(55))  # over 50 words, below 400 bytes
    texts = [*corpus(rng, 60), f"one {short} two", f"three\n{short}"]
    df = spark.createDataFrame([Row(doc_id=k, text=t, k1="clash", at=1, spans=2, __spans=3, __K1=4, __s1=5, __s1_1=6) for k, t in enumerate(texts)])
    got = {r.doc_id: r for r in d.remove(df, bucket_contexts=bucket).collect()}
    for k, expected in enumerate(brute(texts, d.DEPTH)):
        r = got[k].repeats
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected, k
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert sum(x["to"] - x["from"] for x in r.runs) == r.n_removed
    for k, expected in enumerate(brute_passages(texts, d.PASSAGE_WORDS)):
        assert (got[k].repeats.n_passages, got[k].repeats.n_passage_bytes) == expected, k
    assert sum(r.repeats.n_passages > 0 and r.repeats.n_removed == 0 for r in got.values()) > 0
    assert got[0]["__spans"] == 3 and set(df.columns) < set(got[0].asDict())
    assert sum(r.repeats.n_removed > 0 for r in got.values()) > 20


def test_other_depths_and_repeated_rows(spark):
    rng = random.Random(5)
    texts = corpus(rng, 25)
    df = spark.createDataFrame([Row(doc_id=1, text=t) for t in texts + texts[:3] * 3])
    expected = Counter(brute(texts + texts[:3] * 3, 60))
    got = Counter((r.repeats.n_bytes, r.repeats.n_removed, r.repeats.n_spans, r.repeats.kept_sha256) for r in d.remove(df, depth=60, anchor=25).collect())
    assert got == expected


def test_passages_of_few_words(spark):
    rng = random.Random(6)
    texts = [" \n".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    df = spark.createDataFrame([Row(doc_id=k, text=t) for k, t in enumerate(texts)])
    got = {r.doc_id: r.repeats for r in d.remove(df, words=7, bucket_contexts=3).collect()}
    assert [(got[k].n_passages, got[k].n_passage_bytes) for k in range(len(texts))] == brute_passages(texts, 7)


def test_empty_table(spark):
    assert d.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sorting_a_bucket_against_brute_force():
    rng = random.Random(3)
    buckets, texts, at = [], [], []
    for b in range(4):
        core = bytes(rng.choices(b"ab", k=100))
        for _ in range(6):
            left, right = bytes(rng.choices(b"ab", k=rng.randint(0, 3))), bytes(rng.choices(b"ab", k=rng.randint(0, 3)))
            left = rng.choice([b"", b"LEFT", b"LEFT" + left]) + left
            texts.append(left + core + right + b"tail")
            at.append(len(left))
            buckets.append(b)
    hits = d.sort_buckets(buckets, texts, at, d.Level(1, 103, 100))
    for b in range(4):
        own = [k for k in range(len(texts)) if buckets[k] == b]
        for offset in range(-10, 10):
            strings = {k: texts[k][at[k] + offset : at[k] + offset + 103] for k in own if 0 <= at[k] + offset <= len(texts[k]) - 103}
            counts = Counter(strings.values())
            for k, s in strings.items():
                assert hits[k][at[k] + offset] == (counts[s] > 1)
