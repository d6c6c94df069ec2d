import math
from collections import defaultdict

import brute
import numpy as np
import pytest

from tidemark.llm import mixing


def plain_targets(sizes: dict) -> dict:
    """Deal out, cap, deal the excess out again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def check(spark, rows, slack):
    found = mixing.copies(brute.documents(spark, rows)).collect()
    assert brute.ordered((r.doc_id, r.source, r.size) for r in found) == brute.ordered((r[0], r[3], len((r[1] or "").encode().split())) for r in rows)
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        longest[r.source] = max(longest[r.source], r.size)
    target = plain_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], abs_tol=1e-6) and 0 <= r.copies <= 2
    for s in sizes:
        assert abs(taken[s] - target[s]) <= slack * max(1, longest[s]) + 1e-6
    again = mixing.copies(brute.documents(spark, rows)).collect()
    assert brute.ordered(found) == brute.ordered(again)


def test_awkward_rows(spark):
    check(spark, brute.awkward(), 1)


@pytest.mark.parametrize("stratum", [mixing.STRATUM, 16])
def test_sources(spark, monkeypatch, stratum):
    monkeypatch.setattr(mixing, "STRATUM", stratum)
    draw = np.random.default_rng(1)
    rows = [(k, "w " * int(draw.integers(1, 200)), None, f"s{min(9, k % 30)}" if k % 50 else None, None, *brute.NO_EXTRA) for k in range(1500)]
    check(spark, rows, 0.5)


def test_rows_of_the_mix(spark):
    rows = brute.awkward()
    docs = brute.documents(spark, rows)
    mixed = mixing.repeated(docs)
    assert mixed.schema == docs.schema
    want = [r for r in mixing.copies(docs).collect() for _ in range(r.copies)]
    assert brute.ordered((r.doc_id, r.source) for r in mixed.collect()) == brute.ordered((r.doc_id, r.source) for r in want)


def test_empty(spark):
    docs = brute.documents(spark, [])
    assert mixing.mix(docs).collect() == [] and mixing.repeated(docs).collect() == []


def test_flight_has_no_drift():
    """Each unit is picked as often as its probability says; totals stay."""
    size = np.array([5.0, 1, 9, 3, 3, 100, 2, 8, 1, 4] * 3)
    probability = np.linspace(0.1, 0.9, len(size))
    picked = np.zeros(len(size))
    for seed in range(3000):
        for width in (3,):
            cube = mixing.Cube(np.random.default_rng(seed), width)
            got = {k: v for k in range(len(size)) for k, v in cube.add(k, probability[k], size[k])}
            got |= dict(cube.land())
            assert len(got) == len(size)
            picked += [got[k] for k in range(len(size))]
    assert np.abs(picked / 3000 - probability).max() < 0.05
