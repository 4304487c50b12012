import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolith.llm import negatives as m

KIND = "vec_id long, embedding array<long>, label int, row int, cell string"


def brute(rows, is_anchor):
    rows = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[1]]
    order = lambda x: (-x[0], x[1][0] is None, x[1][0] or 0)
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for k, (aid, a, label, *_) in enumerate(rows):
        if not is_anchor(aid):
            continue
        scored = sorted(((clip(sum(x * y for x, y in zip(a, r[1]))), r) for j, r in enumerate(rows) if j != k and len(r[1]) == len(a)), key=order)
        for p, pos in [x for x in scored if x[1][2] == label][:5]:
            good = [x for x in scored if x[1][2] != label and 80 * p <= 100 * x[0] <= 100 * p][:5]
            out += [(aid, pos[0], n + 1, r[0], p, s) for n, (s, r) in enumerate(good)]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash") for r in rows], KIND)


def made(seed, n, dim=6, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim)) * 100
    rows = [(k, (centres[rng.integers(5)] + rng.normal(size=dim) * 20).astype(int).tolist(), int(rng.integers(labels))) for k in range(n)]
    rows += [(n + k, rows[3][1], k % 2) for k in range(40)]  # copies, of two labels
    return rows


@pytest.mark.parametrize("cell_rows,block_rows", [(2000, 16_384), (20, 16)])
def test_against_brute_force(spark, monkeypatch, cell_rows, block_rows):
    monkeypatch.setattr(m, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(m, "BLOCK_ROWS", block_rows)
    rows = made(cell_rows, 300)
    got = m.mine(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, lambda i: i % 10 == 0)
    assert len(got) > 100


def test_edges(spark):
    rows = made(5, 30, 4)
    rows += [(None, [1, 2, 3, 4], 1), (None, [9, 9, 9, 9], 2), (100, None, 1), (101, [1, None, 2, 3], 1), (102, [1, 2, 3, 4], None), (103, [], 1), (110, [], 1), (104, [], 2), (105, [5], 1), (120, [5], 1), (106, [5], 0)]
    rows += [(130, [0, 0, 0, 0], 1), (131, [0, 0, 0, 0], 1), (132, [-50, -3, 2, 1], 2), (133, [1 << 40, 1 << 41, 3, 4], 1), (140, [1 << 62, -(1 << 62), 1 << 61, 5], 2), (141, [1 << 62, -(1 << 62), 1 << 61, 4], 2), (142, [1 << 62, -(1 << 62), 1 << 61, 3], 1)]
    got = m.mine(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, lambda i: i is not None and i % 10 == 0)
    assert m.mine(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert m.mine(frame(spark, [(1, None, 1)]), F.lit(True)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([1, 3, 40]), st.sampled_from([1.0, 1e6]))
def test_brackets_hold(seed, dim, size):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(50, dim)) * size * 100)
    square = float((x * x).sum(axis=1).max())
    pivots = m.choose(list(x[:20]), square, 8)
    far = pivots.of_rows(x).astype(np.float32)
    stored = min(m.PIVOTS, len(pivots.centres))
    q = x[30:40]
    d = pivots.of_anchors(q)[:, :stored]
    low = np.abs(d[:, None, :] - far[None, :, :stored]).max(axis=2)
    high = (d[:, None, :] + far[None, :, :stored]).min(axis=2)
    worst, best = pivots.scores((q * q).sum(axis=1)[:, None], low, high, dim)
    exact = q @ x.T
    assert (worst <= exact).all() and (exact <= best).all()


def test_numbers_are_packed_narrowly():
    rng = random.Random(1)
    for top in (1, 40_000, 1 << 40):
        x = np.array([rng.randint(-top, top) for _ in range(9)], np.int64)
        assert m.unpacked(m.packed(x)).tolist() == x.tolist()
    assert m.unpacked(m.packed(np.zeros(0, np.int64))).tolist() == [] and math.isfinite(m.LONG)
    assert m.unpacked(m.packed(np.array([-(1 << 63), (1 << 63) - 1]))).tolist() == [-(1 << 63), (1 << 63) - 1]
