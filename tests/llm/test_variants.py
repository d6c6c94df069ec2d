"""Spelling variants: the index against edit distances, the query against a plain version."""

import random
import re
import zlib
from collections import Counter

import brute
import pytest

from tidemark.llm import variants
from tidemark.llm.fmindex import near_words
from tidemark.llm.queries import QUERIES


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


@pytest.mark.parametrize("seed", range(30))
def test_near_words(seed):
    draw = random.Random(seed)
    alphabet = draw.choice(["ab", "abc", "abé𝒳ÿ", "abcdefgh"])
    words = list({"".join(draw.choices(alphabet, k=draw.randint(2, 9))) for _ in range(120)})
    asked = words + ["".join(draw.choices(alphabet + "zq", k=draw.randint(2, 9))) for _ in range(20)]
    for first in (True, False):
        def half(w, cut):
            return w[:cut] if first else w[cut:]

        expected = set()
        for a, q in enumerate(asked):
            cut = len(q) // 2
            for b, w in enumerate(words):
                same = w[:cut] == q[:cut] if first else w[len(w) - (len(q) - cut) :] == q[cut:] and len(w) >= len(q) - cut
                if one_edit(q, w) and same:
                    expected.add((a, b))
        found = list(near_words(words, asked, first))
        assert len(found) == len(set(found)) and set(found) == expected


def plain(docs: list[tuple]) -> dict:
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def found(df) -> dict:
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def chained() -> list[tuple]:
    """Words that lead from one to the next, many near words of one word, ties, and awkward texts."""
    draw = random.Random(11)
    words = ["abcdefg"] * 5 + ["abcdefgh"] * 25 + ["abcdefghi"] * 130 + ["abcdefghij"] * 700 + ["Straße", "straßé"] * 40
    for c in "abcdefghijklmnop":
        words += ["kernel" + c] * draw.choice([5, 9, 30]) + [c + "kernel"] * 6
    words += ["kernel"] * 4 + ["×÷×÷×÷"] * 7 + ["×÷×÷×"] * 9 + ["Àbcdéfg"] * 6 + ["àbcdéfg"] * 40
    draw.shuffle(words)
    docs = [(k % 97 if k % 13 else None, " ".join(words[k :: 150])) for k in range(150)]
    return docs + [(1, None), (2, ""), (3, "1_2"), (4, "aaaaaa" * 20_000), (5, "abcdef " * 20_000)]


def test_chains_and_awkward_rows(spark):
    docs = chained()
    df = brute.documents(spark, [(d, t, None, None, None, *brute.NO_EXTRA) for d, t in docs] + brute.awkward()).repartition(5)
    assert found(variants.group_variants(df)) == plain(docs + [r[:2] for r in brute.awkward()])


def test_hot_key_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(variants, "CHUNK", 7)
    monkeypatch.setattr(variants, "SHARD", 300)
    docs = chained()
    assert found(variants.group_variants(spark.createDataFrame(docs, "doc_id bigint, text string"))) == plain(docs)


def test_hot_key_beside_a_small_one(spark, monkeypatch):
    """A word of a hot key also stands under the key before it, whose shard must not take a chunk in."""
    monkeypatch.setattr(variants, "CHUNK", 7)
    draw = random.Random(1)
    long = sorted({"abcd" + "".join(draw.choices("efghijklmnop", k=5)) for _ in range(40)})
    words = long + [w[:k] + w[k + 1 :] for w, k in zip(long, (4, 5, 6, 7, 8))]
    docs = [(k, " ".join(words)) for k in range(8)]
    assert found(variants.group_variants(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(1))) == plain(docs)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = found(QUERIES["op11_spelling_variants"](spark, folder))
    assert rows == plain(docs) and len(rows) > 100


def test_empty_table(spark):
    assert variants.group_variants(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
