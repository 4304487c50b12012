import math

import numpy as np
import pytest
from pyspark.sql import Row

from aerolith.llm import vectors as v

KIND = "vec_id long, embedding array<float>, node string, unit int"


def brute(rows, threshold=0.9):
    units = []
    for _, x in rows:
        x = np.array([math.nan if c is None else c for c in x or ()], np.float64)
        units.append(x / np.sqrt(x @ x) if len(x) and np.isfinite(x).all() and x.any() else None)
    n = len(rows)
    near = [[b for b in range(n) if b != a and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold] for a in range(n)]
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out.append((rows[a][0], len(near[a]), min(rows[b][0] for b in seen)))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([Row(vec_id=i, embedding=x, node="clash", unit=1) for i, x in rows], KIND)


@pytest.mark.parametrize("block,centres", [(1024, 16_384), (16, 16_384), (1024, 5)])
def test_recall_against_brute_force(spark, monkeypatch, block, centres):
    monkeypatch.setattr(v, "BLOCK", block)
    monkeypatch.setattr(v, "MOST_CENTRES", centres)
    monkeypatch.setattr(v, "LIST_SIZE", 20)
    rng = np.random.default_rng(block)
    rows = []
    for _ in range(120):
        x = rng.normal(size=24)
        for _ in range(int(rng.choice([1, 1, 2, 5, 30], p=[0.4, 0.3, 0.15, 0.1, 0.05]))):
            rows.append((len(rows), (x + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.3])).astype(np.float32).tolist()))
    expected = brute(rows)
    got = sorted((r.id, r.n_links, r.component_id) for r in v.link(frame(spark, rows)).collect())
    links = sum(r[1] for r in expected)
    assert links > 200
    assert sum(r[1] for r in got) >= 0.99 * links
    assert all(a[1] <= b[1] for a, b in zip(got, expected, strict=True))
    one_list = sorted((r.id, r.n_links, r.component_id) for r in v.link(frame(spark, rows), probes=1000).collect())
    assert one_list == expected


def test_vectors_that_link_with_nothing(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (10, [3e38, 3e38]), (11, [1e-38, 1e-38]), (7, [1.0, 2.0])]
    got = sorted((r.id, r.n_links, r.component_id) for r in v.link(frame(spark, rows)).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 4, 7), (7, 4, 7), (8, 4, 7), (9, 0, 9), (10, 4, 7), (11, 4, 7)]


def test_null_ids_and_empty_table(spark):
    got = [(r.id, r.n_links) for r in v.link(frame(spark, [(None, [1.0, 0.0]), (2, [1.0, 0.0])])).collect()]
    assert sorted(n for _, n in got) == [1, 1]
    assert v.link(frame(spark, [])).count() == 0


def test_two_levels_keep_lists_of_a_size(monkeypatch):
    monkeypatch.setattr(v, "MOST_CENTRES", 16)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 16)).astype(np.float32)
    x[3000:] = x[:3000] + rng.normal(size=(3000, 16)).astype(np.float32) * 0.05
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = v.fit(x, 40_000)
    assert index.lists >= 190 and v.LEAST_PROBES <= index.probes <= index.lists
    home, near = index.nearest(x, 1)[:, 0], index.nearest(x, index.probes)
    far = np.stack([np.linalg.norm(x - index.centre(k), axis=1) for k in range(index.lists)], axis=1)
    assert (far.argmin(axis=1) == home).mean() > 0.7  # only the second centres beside the nearest first one are tried
    assert np.bincount(home).max() < 20 * len(x) / index.lists
    found = [home[b] in near[a] or home[a] in near[b] for a, b in zip(range(3000), range(3000, 6000), strict=True) if x[a] @ x[b] >= 0.9]
    assert np.mean(found) > 0.999


def test_probes_follow_the_links_of_the_sample():
    rng = np.random.default_rng(5)
    far = np.eye(24, dtype=np.float32)[rng.integers(0, 24, 3000)]
    tight = far + rng.normal(size=far.shape).astype(np.float32) * 0.01
    tight /= np.linalg.norm(tight, axis=1)[:, None]
    assert v.fit(tight, 3000).probes <= v.PROBES
    alone = np.eye(600, dtype=np.float32)
    assert v.fit(alone, 4000).probes == min(v.PROBES, 20)  # no link in the sample
    two = np.concatenate([alone[:300], alone[:300] * 0.999 + alone[300:] * 0.01])
    two /= np.linalg.norm(two, axis=1)[:, None]
    assert v.LEAST_PROBES <= v.fit(two, 4000).probes <= 20


def test_probes_are_as_many_as_links_need():
    """Links whose lists are far down the order are found by asking for more lists, not by giving up."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = v.Index(x.copy(), np.zeros((1, 3), np.float32), np.zeros((3, 256, 1), np.float32), [0, 1, 2, 3], 0.0, 1)
    far = v.needed_probes(index, x, -0.5, measured=50, most=4)
    order = index.nearest(x, 400)
    linked = [(a, b) for a in range(0, 400, 8) for b in range(400) if a != b and x[a] @ x[b] >= -0.5]
    assert 4 < far <= 400
    place = lambda a, b: int(np.flatnonzero(order[a] == b)[0]) + 1
    assert far <= max(min(place(a, b), place(b, a)) for a, b in linked)
    assert v.needed_probes(index, x, -0.5, measured=50, most=400) == far
