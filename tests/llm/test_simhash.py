import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES


def plain(docs: list[tuple], words: int = 4, radius: int = 4) -> list[tuple]:
    prints = [(d, brute.simhash(t, words)) for d, t in docs]
    of = brute.components(sorted({f for _, f in prints}), lambda a, b: (a ^ b).bit_count() <= radius)
    least = {id(c): min((d for d, f in prints if f in c and d is not None), default=None) for c in of.values()}
    return brute.ordered((d, f"{f:016x}", least[id(of[f])]) for d, f in prints)


def test_whole_table(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert brute.ordered(QUERIES["op4_simhash_dedup"](spark, folder).collect()) == plain(docs)


def test_awkward_rows(spark):
    assert brute.ordered(simhash.near_duplicates(brute.documents(spark)).collect()) == plain([r[:2] for r in brute.awkward()])
    assert simhash.near_duplicates(brute.documents(spark, [])).collect() == []


def edited(text: str, n: int, seed: int) -> str:
    words = text.split()
    for k in random.Random(seed).sample(range(len(words)), n):
        words[k] = f"edit{seed}{k}"
    return " ".join(words)


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 40])
def test_one_large_group(spark, monkeypatch, chunk):
    """Many texts near one another: linked as plain comparison links them, also if their blocks are dealt out."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    text = brute.prose(1, 400)
    docs = [(k, edited(text, 1 + k % 3, k)) for k in range(150)] + [(1000 + k, brute.prose(50 + k, 30)) for k in range(60)]
    rows = [(d, t, None, None, None, *brute.NO_EXTRA) for d, t in docs]
    assert brute.ordered(simhash.near_duplicates(brute.documents(spark, rows)).collect()) == plain(docs)


@pytest.mark.parametrize("bits, radius", [(64, 4), (64, 0), (256, 52)])
def test_lanes(bits, radius):
    draw = np.random.default_rng(radius)
    base = draw.integers(0, 256, (1, bits // 8), np.uint8)
    flips = np.packbits(draw.random((300, bits)) < draw.random((300, 1)) * 0.3, axis=1)
    prints = base ^ flips
    distance = np.unpackbits(prints[:, None] ^ prints[None], axis=2).sum(axis=2)
    of = brute.components(list(range(300)), lambda a, b: distance[a, b] <= radius)
    links = simhash.forest(prints, radius, queries=7)
    assert all(distance[a, b] <= radius for a, b in links)
    found = brute.components(list(range(300)), lambda a, b, s=set(links): (a, b) in s or (b, a) in s)
    assert {frozenset(c) for c in found.values()} == {frozenset(c) for c in of.values()}
    blocks = np.repeat(np.arange(15), 20)
    pairs = set(simhash.pair_links(prints, blocks, radius))
    of = brute.components(list(range(300)), lambda a, b: blocks[a] == blocks[b] and distance[a, b] <= radius)
    found = brute.components(list(range(300)), lambda a, b: (a, b) in pairs)
    assert {frozenset(c) for c in found.values()} == {frozenset(c) for c in of.values()}


def test_components(spark):
    draw = random.Random(3)
    links = [(k, k + 1) for k in range(100, 130)] + [(draw.randrange(90), draw.randrange(90)) for _ in range(60)] + [(500, k) for k in range(501, 560)]
    of = brute.components(sorted({n for l in links for n in l}), lambda a, b, s=set(links): (a, b) in s or (b, a) in s)
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert dict(map(tuple, found)) == {n: min(of[n]) for n in of if len(of[n]) > 1}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_keep_one(spark):
    text, other = brute.prose(1, 300), brute.prose(2, 200)
    docs = [(5, text), (3, edited(text, 3, 1)), (9, text), (4, other), (4, other), (None, other), (7, None), (8, ""), (2, brute.prose(3, 100))]
    rows = [(d, t, None, None, None, *brute.NO_EXTRA) for d, t in docs]
    kept = simhash.keep_one(brute.documents(spark, rows))
    assert kept.columns == brute.documents(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 7]
    assert simhash.keep_one(brute.documents(spark, [])).collect() == []


def test_keep_one_keeps_one_of_each_component(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {r.component_id for r in QUERIES["op4_simhash_dedup"](spark, folder).collect()}
    for parts in (3, 17):
        assert sorted(r.doc_id for r in simhash.keep_one(docs.repartition(parts)).collect()) == sorted(ids)


def test_components_of_links_that_come_in_another_order_each_time(spark):
    """Another spanning forest each time the links are computed: each of them has all its links both ways."""

    def forest(stream):
        for batch in stream:
            order = np.random.permutation(200)  # a chain through the nodes, in an order of its own
            yield pa.RecordBatch.from_arrays([pa.array(order[:-1]), pa.array(order[1:])], ["a", "b"])

    links = spark.range(1, numPartitions=1).mapInArrow(forest, "a bigint, b bigint")
    assert {tuple(r) for r in components(links).collect()} == {(k, 0) for k in range(200)}
