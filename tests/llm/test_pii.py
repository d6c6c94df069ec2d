"""Personal data: patterns and tagger against plain versions, held-out accuracy, the query's base columns."""

import hashlib
import itertools
import math
import random
import re

import brute
import numpy as np
import pytest

from tidemark.llm import pii
from tidemark.llm.queries import QUERIES
from tidemark.llm.tagger import Tagger, encode

FOLDER = "/root/testdata/sf0.01"


def luhn(number: str) -> bool:
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(number))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_base(text: str) -> list[tuple]:
    """The contract's patterns as they are written."""
    digits = lambda m: "".join(c for c in m[0] if c in "0123456789")
    each = lambda pattern: re.finditer(pattern, text)
    spans = [("email", m) for m in each(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")]
    spans += [("ip", m) for m in each(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", m) for m in each(r"[0-9]([\x20-]?[0-9])+") if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [("phone", m) for m in each(r"\+[0-9][\x20().0-9-]+[0-9]") if 10 <= len(digits(m)) <= 15]
    return sorted(((k, m.start(), m.end()) for k, m in spans), key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.mark.parametrize("seed", range(300))
def test_base_spans(seed):
    draw = random.Random(seed)
    parts = ["a.b", "@", "x@y.z", ".com", "1", "12", ".", "255", "256", "007", "-", " ", "(", ")", "+", "+1", "4041894974608795", "4041 8949 7460 8795"]
    parts += ["555-2485", "%", "é", "\n", "_", "@@", "1.2.3.4", "٣", "+49 (30) 12345678", "0000000000000000"]
    text = "".join(draw.choices(parts, k=draw.randint(0, 25)))
    assert pii.base_spans(text) == plain_base(text)


def test_base_spans_take_linear_time():
    for text in ("x" * 400_000, "1" * 400_000, "1." * 200_000, "x@" * 200_000, "+1" + "(" * 400_000, "1 " * 200_000):
        assert pii.base_spans(text) in ([], plain_base("1." * 200_000))


@pytest.fixture(scope="module")
def small():
    draw = np.random.default_rng(3)
    tagger = Tagger.new(3, 4, 0)
    for w in tagger.weights():
        w[...] = draw.normal(0, 0.6, w.shape)
    return tagger, draw.integers(0, 131, (5, 6)).astype(np.uint8), draw.integers(0, 3, (5, 6)).astype(np.uint8)


def plain_scores(tagger: Tagger, x: list[int]) -> list[list[float]]:
    """One window, one character, one gate at a time."""
    size, sig = tagger.inner.shape[1], lambda v: 1 / (1 + math.exp(-v))
    scores = [[float(b) for b in tagger.bias] for _ in x]
    for side in (0, 1):
        h, c = [0.0] * size, [0.0] * size
        for t in range(len(x)) if side == 0 else range(len(x) - 1, -1, -1):
            z = [float(tagger.table[side][x[t]][k]) + sum(h[j] * float(tagger.inner[side][j][k]) for j in range(size)) for k in range(4 * size)]
            for j in range(size):
                c[j] = sig(z[size + j]) * c[j] + sig(z[j]) * math.tanh(z[3 * size + j])
            h = [sig(z[2 * size + j]) * math.tanh(c[j]) for j in range(size)]
            for k in range(len(tagger.bias)):
                scores[t][k] += sum(h[j] * float(tagger.out[side][j][k]) for j in range(size))
    return scores


def path_score(tagger: Tagger, scores, path) -> float:
    return sum(scores[t][k] for t, k in enumerate(path)) + sum(float(tagger.moves[a, b]) for a, b in zip(path, path[1:]))


def test_scores_and_paths(small):
    tagger, x, _ = small
    found = tagger.scores(x)
    paths = tagger.decode(found)
    for row in range(len(x)):
        scores = plain_scores(tagger, x[row].tolist())
        assert np.allclose(found[:, :, row], scores, atol=1e-4)
        assert np.allclose(tagger.emissions(x, [])[:, row], scores, atol=1e-4)
        best = max(itertools.product(range(3), repeat=6), key=lambda p: path_score(tagger, scores, p))
        assert tuple(paths[row]) == best


def test_likelihood_and_gradient(small):
    tagger, x, y = small
    loss, slopes = tagger.gradients(x, y)
    plain = 0.0
    for row in range(len(x)):
        scores = plain_scores(tagger, x[row].tolist())
        every = [path_score(tagger, scores, p) for p in itertools.product(range(3), repeat=6)]
        plain += math.log(sum(map(math.exp, every))) - path_score(tagger, scores, y[row].tolist())
    assert loss == pytest.approx(plain / len(x), abs=1e-4)
    for w, slope in zip(tagger.weights(), slopes):
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        before, step = w[at], 1e-2
        w[at] = before + step
        more = tagger.gradients(x, y)[0]
        w[at] = before - step
        less = tagger.gradients(x, y)[0]
        w[at] = before
        assert (more - less) / (2 * step) == pytest.approx(slope[at], rel=0.02, abs=1e-3)


def test_windows_without_gain_are_not_searched(small):
    tagger, x, _ = small
    scores = tagger.scores(x)
    scores[:, 0] += 100
    assert not tagger.decode(scores).any()


@pytest.fixture(scope="module")
def learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    windows = pii.sample(docs)
    held = {hashlib.md5(t.encode()).digest()[0] % 4 == 0 for _, t, _ in windows}
    assert held == {True, False}
    side = lambda out: [w for w in windows if (hashlib.md5(w[1].encode()).digest()[0] % 4 == 0) == out]
    return pii.fitted(side(False)), side(True)


def test_held_out_accuracy(learnt):
    tagger, held = learnt
    x, y = pii.examples(held, 99)
    right = tagger.decode(tagger.scores(x)) == y
    some = (y > 0).any(axis=1)
    assert right.mean() > 0.99
    assert right.all(axis=1)[some].mean() > 0.85
    assert right.all(axis=1)[~some].mean() > 0.97


def test_spans_across_windows(learnt):
    tagger, _ = learnt
    phone = "988-555-2485"
    for away in range(0, 300, 17):
        text = "the rate of things " * 20
        text = text[: 60 + away] + f" {phone} " + text[60 + away :]
        (_, _, tagged), = pii.tag(tagger, [(0, text)])
        assert ("phone", 61 + away, 61 + away + len(phone)) in pii.added(text, pii.base_spans(text), tagged), away


def test_blocks_do_not_change_a_text(learnt, monkeypatch):
    tagger, _ = learnt
    texts = [(k, brute.prose(k, 40 * (k % 9)) + " card 4041.8949.7460.8795 " * (k % 2)) for k in range(30)]
    whole = list(pii.tag(tagger, texts))
    monkeypatch.setattr(pii, "BLOCK", 7)
    assert list(pii.tag(tagger, texts)) == whole and any(spans for _, _, spans in whole)


def test_reconciled_is_the_heaviest_choice():
    draw = random.Random(5)
    for _ in range(200):
        pieces, at = [], 0
        for kind in pii.KINDS:
            at = 0
            for _ in range(draw.randint(0, 2)):
                at += draw.randint(1, 6)
                end = at + draw.randint(1, 6)
                pieces.append((kind, at, end, float(draw.randint(1, 50))))
                at = end + 1
        weight = {p[:3]: p[3] for p in pieces}
        best = 0.0
        for n in range(len(pieces) + 1):
            for some in itertools.combinations(pieces, n):
                if all(a[2] <= b[1] or b[2] <= a[1] for a, b in itertools.combinations(some, 2)):
                    best = max(best, sum(p[3] for p in some))
        kept = pii.reconciled(pieces)
        assert sum(weight[s] for s in kept) == pytest.approx(best)
    assert pii.reconciled([("card", 3, 9, 5.0), ("card", 7, 12, 5.0), ("phone", 4, 6, 1.0)]) == [("card", 3, 12)]


def test_awkward_rows(spark):
    rows = brute.awkward() + [(20, "mail a@b.co now", None, None, None, *brute.NO_EXTRA), (20, "x@" * 50_000 + "q.z 10.1.2.3", None, None, None, *brute.NO_EXTRA)]
    docs = brute.documents(spark, rows).repartition(4)
    found = pii.find(docs, pii.train(docs), docs.columns).select("kept.*", "spans")
    got = brute.ordered((r["doc_id"], r["text"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"])) for r in found.collect())
    assert got == brute.ordered((r[0], r[1], tuple(plain_base(r[1] or ""))) for r in rows)


def test_empty_table(spark):
    docs = brute.documents(spark, [])
    assert pii.train(docs) is None and pii.find(docs, None, ["doc_id"]).collect() == []


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op12_pii"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert tuple(r[f"n_{k}"] for k in pii.KINDS) == tuple(sum(s[0] == k for s in base) for k in pii.KINDS)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert [s for s in spans if s in set(base)] == base and spans == pii.in_order(spans)
    assert {tuple(r) for r in rows} == {tuple(r) for r in QUERIES["op12_pii"](spark, FOLDER).collect()}
