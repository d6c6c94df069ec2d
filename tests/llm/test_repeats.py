"""Recurring bytes and words against plain counting, on awkward rows and on either way through hot marks."""

import random
from dataclasses import replace

import brute
import numpy as np
import pytest

from tidemark.llm import automata, spans, suffix
from tidemark.llm.queries import QUERIES

NO_ROWS: list = []


def bytes_of(spark, docs):
    found = suffix.deduplicate(docs).collect()
    return brute.ordered((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), brute.sha(bytes(r.kept))) for r in found)


def words_of(spark, docs):
    return brute.ordered((r.doc_id, r.n_words, r.n_removed, brute.sha(bytes(r.kept))) for r in automata.deduplicate(docs).collect())


@pytest.mark.parametrize("most", [suffix.BYTES.most, 1000, 0])
def test_bytes(spark, monkeypatch, most):
    monkeypatch.setattr(suffix, "BYTES", replace(suffix.BYTES, most=most))
    rows = brute.awkward()
    want = brute.recurring_bytes([r[1] for r in rows])
    assert bytes_of(spark, brute.documents(spark)) == brute.ordered((r[0], *w) for r, w in zip(rows, want))


@pytest.mark.parametrize("most", [automata.WORDS.most, 200, 0])
def test_words(spark, monkeypatch, most):
    monkeypatch.setattr(automata, "WORDS", replace(automata.WORDS, most=most))
    rows = brute.awkward()
    want = brute.recurring_words([r[:2] for r in rows])
    assert words_of(spark, brute.documents(spark)) == brute.ordered((r[0], *w) for r, w in zip(rows, want))


def test_repeating_text_alone(spark):
    """A string that recurs only within one text, at every period, and at the edge of the length."""
    texts = ["ab" * 150, "x" * 201, "x" * 200, brute.prose(9, 60) + " " + brute.prose(9, 60)]
    texts += ["".join(random.Random(p).choices("abcdef", k=p)) * 3 for p in (37, 90, 199, 200, 260)]
    for text in texts:
        rows = [(1, text, None, None, None, *brute.NO_EXTRA)]
        assert bytes_of(spark, brute.documents(spark, rows)) == [(1, *brute.recurring_bytes([text])[0])]


def test_mark_of_thousands_of_spans(spark, monkeypatch):
    """One phrase in every text, more different texts around it than a shard takes, some of them shared by two or three."""
    monkeypatch.setattr(suffix, "BYTES", replace(suffix.BYTES, most=1 << 17))
    draw = random.Random(3)
    letters = lambda n: "".join(draw.choices("abcdefghij", k=n))
    phrase, texts = letters(120), []
    for k in range(2500):
        before, after = letters(60), letters(120)
        for _ in range(1 + (k % 50 == 0) + (k % 100 == 0)):
            texts.append(letters(40) + before + phrase + after + letters(40))
    texts += [letters(30) + phrase * 3 + letters(30), letters(30) + phrase * 3]
    rows = [(k, t, None, None, None, *brute.NO_EXTRA) for k, t in enumerate(texts)]
    want = brute.recurring_bytes(texts)
    assert sum(w[1] for w in want) > 75 * 200
    assert bytes_of(spark, brute.documents(spark, rows)) == brute.ordered((r[0], *w) for r, w in zip(rows, want))


def test_words_of_a_mark_of_thousands_of_spans(spark, monkeypatch):
    monkeypatch.setattr(automata, "WORDS", replace(automata.WORDS, most=1 << 14))
    draw = random.Random(4)
    words = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    phrase, texts = words(30), []
    for k in range(1500):
        before, after = words(15), words(30)
        for _ in range(1 + (k % 50 == 0) + (k % 100 == 0)):
            texts.append(" ".join(words(10) + before + phrase + after + words(10)))
    rows = [(k, t, None, None, None, *brute.NO_EXTRA) for k, t in enumerate(texts)]
    want = brute.recurring_words([r[:2] for r in rows])
    assert sum(w[1] for w in want) > 40 * 50
    assert words_of(spark, brute.documents(spark, rows)) == brute.ordered((r[0], *w) for r, w in zip(rows, want))


def test_empty_table(spark):
    docs = brute.documents(spark, [])
    assert bytes_of(spark, docs) == words_of(spark, docs) == NO_ROWS


@pytest.mark.parametrize("seed", range(6))
def test_prefixes_from_transform(seed):
    """Recurring starts of strings in one shard, over few letters so that intervals nest deeply."""
    draw = random.Random(seed)
    length = draw.choice([3, 8, 20])
    texts = sorted({"".join(draw.choices("ab", k=draw.randint(length, 90))).encode() for _ in range(30)})
    found = {(k, at) for k, a, n, _ in suffix.solve([(0, k, 1, 0, 0, t) for k, t in enumerate(texts)], length) for at in range(a, a + n)}
    met: dict = {}
    for k, t in enumerate(texts):
        for at in range(len(t) - length + 1):
            met.setdefault(t[at : at + length], []).append((k, at))
    assert found == {place for places in met.values() if len(places) > 1 for place in places}


def test_spans_hold_every_window_once():
    units = np.array([random.Random(5).randrange(4) for _ in range(5000)] + [1] * 3000, np.uint64)
    marks, starts, counts, _ = spans.cut(units, 40, 8, 100)
    assert starts.tolist() == np.r_[0, np.cumsum(counts)[:-1]].tolist() and counts.sum() == len(units) - 39
    assert counts.max() <= 100
    seen: dict = {}
    for mark, start, n in zip(marks.tolist(), starts.tolist(), counts.tolist()):
        for k in range(start, start + n):
            assert seen.setdefault(units[k : k + 40].tobytes(), mark) == mark


@pytest.mark.parametrize("name", ["op1_suffix_array_dedup", "op7_substring_dedup"])
def test_whole_table(spark, folder, name):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    plain = brute.recurring_bytes([t for _, t in docs]) if "op1" in name else brute.recurring_words(docs)
    assert brute.ordered(QUERIES[name](spark, folder).collect()) == brute.ordered((d, *p) for (d, _), p in zip(docs, plain))
