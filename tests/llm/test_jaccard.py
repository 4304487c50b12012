import random

import pytest
from pyspark.sql import Row

from aerolith.llm import jaccard as j


def brute(rows, words=5):
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        n = min(words, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set())
    n = len(rows)
    near = [[b for b in range(n) if b != a and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])] for a in range(n)]
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        same = [rows[b][0] for b in range(n) if b == a or (sets[a] and sets[a] == sets[b])]
        out.append((rows[a][0], min(same), len(near[a]), min(rows[b][0] for b in seen)))
    return sorted(out)


def corpus(rng, n):
    vocab = ["".join(rng.choice("abcdefgü") for _ in range(rng.randint(1, 6))) for _ in range(500)]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    common = text(60)
    out = []
    for _ in range(n):
        base = text(rng.randint(1, 150))
        if rng.random() < 0.5:
            base = base[:40] + common + base[40:]
        for _ in range(rng.choice([1, 1, 1, 2, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(" ".join(copy))
    hub = text(120)
    for _ in range(40):
        copy = list(hub)
        copy[rng.randrange(len(copy))] = rng.choice(vocab)
        out.append(" ".join(copy))
    return [*out, None, "", "  \n ", "one", "one", "one two", "x " * 3000, "x " * 4000]


@pytest.mark.parametrize("bucket,block", [(256, 128), (4, 8)])
def test_against_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(j, "BUCKET", bucket)
    monkeypatch.setattr(j, "BLOCK", block)
    texts = corpus(random.Random(bucket), 60)
    rows = list(enumerate(texts))
    df = spark.createDataFrame([Row(doc_id=k, text=t, node="clash", key=1, family=2, tie=3) for k, t in rows], "doc_id long, text string, node string, key int, family int, tie int")
    got = j.join(df).collect()
    assert sorted((r.id, r.class_id, r.n_links, r.component_id) for r in got) == brute(rows)
    kept = {r.doc_id for r in j.deduplicate(df).collect()}
    assert kept == {r[3] for r in brute(rows)}


def test_bands_reach_the_recall():
    for recall in (0.9, 0.999, 0.99999):
        bands, rows = j.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= j.MOST_HASHES


def test_repeated_rows_null_ids_and_empty_tables(spark):
    kind = "doc_id long, text string, extra string"
    t = "a b c d e f g h"
    df = spark.createDataFrame([(1, t, "x"), (1, t, "y"), (None, t, "z"), (2, "other words here", "w"), (3, "", ""), (3, None, "")], kind)
    got = sorted((r.id or 0, r.n_links) for r in j.join(df).collect())
    assert got == [(0, 2), (1, 2), (1, 2), (2, 0), (3, 0), (3, 0)]
    assert j.deduplicate(df).count() == 4
    empty = spark.createDataFrame([], kind)
    assert j.join(empty).count() == 0 and j.deduplicate(empty).count() == 0


def test_large_buckets_tie_all_that_is_near(spark):
    """Thousands of classes that share one band by a template: none but one is near the centre."""
    rng = random.Random(9)
    n, briefs = 3000, {}
    for k in range(1, n, 2):
        base = bytearray(rng.randbytes(40))
        briefs[k] = bytes(base)
        base[0:8] = bytes(x ^ 1 for x in base[0:8])
        briefs[k + 1] = bytes(base)
    near = bytearray(rng.randbytes(40))
    briefs[0] = bytes(near)  # the centre
    near[:12] = bytes(x ^ 1 for x in near[:12])
    briefs[n + 1] = bytes(near)  # near the centre, and near the next one, which is not near the centre
    near[-12:] = bytes(x ^ 1 for x in near[-12:])
    briefs[n + 2] = bytes(near)
    node = lambda k: k.to_bytes(16, "big")
    rows = spark.createDataFrame([(7, node(k)) for k in briefs], "key long, node binary")
    got = j.candidate_edges(rows, spark.createDataFrame([(node(k), b) for k, b in briefs.items()], "node binary, brief binary"), 24)
    reach = j.Union(n + 3)
    for r in got.collect():
        reach.join(int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big"))
    assert all(reach.root(k) == reach.root(k + 1) == k for k in range(1, n, 2))
    assert reach.root(n + 1) == reach.root(n + 2) == 0
