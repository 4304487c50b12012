import hashlib
import random

from aerolith.llm import trie

KIND = "conv_id long, turn long, role string, text string, k int, name string"


def brute(rows):
    """Nodes by sequences of turns."""
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()
    convs = {}
    for c, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, digest(r[2] or "", r[3] or ""))):
        convs.setdefault(c, []).append((role or "", text or ""))
    return brute_nodes(convs)


def brute_nodes(convs):
    members = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    out = []
    for node, who in members.items():
        under = [x for x in members if x[: len(node)] == node]
        kids = [x for x in under if len(x) == len(node) + 1]
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in under) for x in under)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].split()) for x in under if x)
        ends = sorted(c for c in who if len(convs[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def made(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(-n // 4, n):
        for t in range(rng.choice([0, 1, 2, 5, longest])):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]), rng.choice(["hello there", "", None, "a b  c", "Grüß\tGott"]) if rng.random() < 0.4 else "same words here", 5, "clash"))
    rows += [(10_000 + k, t, "user", f"copy {t}", 5, None) for k in range(12) for t in range(9)]  # copies
    rows += [(20_000 + k, t, "user", f"long {t}", 5, None) for k in range(2) for t in range(60)]  # shared through several blocks
    rows += [(20_000, 60, "user", "and on", 5, None), (None, 1, "user", "no id", 5, None), (3, 1, "user", "tie", 5, None), (3, 1, "user", "tie", 5, None), (3, 1, "user", "x" * 100_000, 5, None)]
    return rows


def test_against_brute_force(spark):
    rows = made(1, 60, 8)
    assert rows_of(trie.trie(spark.createDataFrame(rows, KIND))) == brute(rows)


def test_small_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "FIRST", 1)
    monkeypatch.setattr(trie, "MOST", 4)
    monkeypatch.setattr(trie, "CHUNK", 10)
    rows = made(2, 30, 6)
    assert rows_of(trie.trie(spark.createDataFrame(rows, KIND))) == brute(rows)


def test_blocks_are_without_gaps(spark):
    from pyspark.sql import functions as F

    seen = [r[0] for r in spark.range(1, 5000).select(trie.block_of(F.col("id"))).collect()]
    ends = [k + 1 for k in range(len(seen) - 1) if seen[k] != seen[k + 1]]
    assert seen[0] == 0 and all(b - a in (0, 1) for a, b in zip(seen, seen[1:])) and ends == [trie.last_turn(b) for b in range(len(ends))]


def test_few_conversations(spark):
    empty = spark.createDataFrame([], KIND)
    assert trie.trie(empty).count() == 0
    one = [(7, 1, "user", "a b", 5, None), (7, 2, "user", "c", 5, None)]
    assert rows_of(trie.trie(spark.createDataFrame(one, KIND))) == brute(one)


def test_conversations_without_turns(spark):
    turns = trie.numbered(spark.createDataFrame([(1, 1, "user", "a", 5, None)], KIND))
    every = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "conv_id long, n_turns long")
    assert rows_of(trie.nodes(turns, every)) == brute_nodes({1: [("user", "a")], 2: [], 3: []})
    assert rows_of(trie.nodes(turns.limit(0), every.where("conv_id > 1"))) == brute_nodes({2: [], 3: []})


def test_an_order_of_numbers(spark):
    rows = [(c, t, "user", "same", 5, None) for c in (9, 10, -3) for t in range(2)]
    assert rows_of(trie.trie(spark.createDataFrame(rows, KIND))) == brute(rows)
