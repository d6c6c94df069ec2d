"""Quality classifier: a generalised additive model with pairwise interactions.

Every text gives ``FEATURES`` numbers, read from its characters and words alone. Each feature is cut
into bins at quantiles of the training rows. Boosting goes round the features: one shallow tree on one
feature at a time, fitted to what is left to explain and added to that feature's table in small steps,
so that no feature takes what another one could say. Then the pairs that lower the loss most get a table
over two features each, boosted the same way. Scoring adds up table entries for whole batches and takes
the logistic of the sum; the tables are the whole model, and can be read.

The model is fitted on ``SAMPLE`` labelled rows at most, those with the smallest hashes of doc_id; the
sample bounds what reaches the driver (a few numbers per row) and all documents are scored.

A null text is an empty one; empty texts are scored like others. Documents with a null or repeated id
are scored like others. Labels with a null id, or a null label, teach nothing; of an id labelled more
than once the mean of its labels counts, rounded. Without labelled rows, every score is 0.5. Other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, values

SAMPLE = 20_000
FOLDS = 5
#: Scores from which a text counts as good.
KEEP = 0.3
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, RATE, PAIRS = 120, 60, 0.15, 6
LEAVES, SMALLEST_LEAF, RIDGE = 4, 20.0, 1.0

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "punctuation", "symbol", "bar", "exclamation",
    "other_ascii", "high_byte", "new_line", "sentence_end", "distinct_words", "longest_word", "line_words",
    "repeated_lines", "symbol_words", "doubled_words",
)

_CLASSES = np.zeros((256, 10))
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"?()-", b"#$%&*@^~+=<>", b"|", b"!", b"_/\\[]{}`")):
    _CLASSES[list(_chars), _k] = 1
_CLASSES[128:, 7] = 1
_CLASSES[ord("\n"), 8] = 1
_CLASSES[list(b" \t\r\n\x0b\x0c"), 9] = 1
_ENDS = (b".", b"?", b"!")


def features(text: str | None) -> list[float]:
    raw = (text or "").encode()
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    upper, digit, punctuation, symbol, bar, exclamation, other, high, lines, space = (
        np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES
    ).tolist()
    words = raw.split()
    n_words = max(1, len(words))
    solid = max(1.0, n - space)
    ends = raw.count(b". ") + raw.count(b".\n") + raw.count(b"? ") + raw.count(b"! ") + raw.rstrip().endswith(_ENDS)
    of_lines = [x for x in raw.split(b"\n") if x.strip()]
    per_line = len(words) / max(1, len(of_lines))
    symbol_words = sum(raw.count(x) for x in (b"###", b"$$$", b"%%%", b"&&&", b"***", b"!!", b" | ")) / n_words
    return [
        math.log1p(n), math.log1p(len(words)), solid / n_words, upper / solid, digit / solid, punctuation / solid,
        symbol / solid, bar / solid, exclamation / solid, other / solid, high / solid, lines / n_words, ends / n_words,
        len(set(words)) / n_words, float(max(map(len, words), default=0)), per_line,
        1 - len(set(of_lines)) / max(1, len(of_lines)), symbol_words, sum(map(operator.eq, words, words[1:])) / n_words,
    ]


@dataclass
class Model:
    """Cuts and tables; a pair's table is indexed by coarse bins of its two features."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, rows: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, rows[:, k], "right") for k, c in enumerate(self.cuts)]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        bins = self.bins(rows)
        for b, table in zip(bins, self.tables):
            total += table[b]
        for i, j, table in self.pairs:
            total += table[coarse(bins[i], self.cuts[i]), coarse(bins[j], self.cuts[j])]
        return 1 / (1 + np.exp(-total))


def coarse(bins: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return bins * PAIR_BINS // (len(cuts) + 1)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The values of a tree of ``LEAVES`` leaves over ordered bins with gradients g and weights h."""
    sums_g, sums_h = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        best = (1e-6, None, None)
        for low, high in leaves:
            at = np.arange(low + 1, high)
            left_h, right_h = sums_h[at] - sums_h[low], sums_h[high] - sums_h[at]
            left_g, right_g = sums_g[at] - sums_g[low], sums_g[high] - sums_g[at]
            whole = _gain(sums_g[high] - sums_g[low], sums_h[high] - sums_h[low])
            gain = np.where(np.minimum(left_h, right_h) * 4 >= SMALLEST_LEAF, _gain(left_g, left_h) + _gain(right_g, right_h) - whole, 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (low, high), int(at[gain.argmax()]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for low, high in leaves:
        out[low:high] = (sums_g[high] - sums_g[low]) / (sums_h[high] - sums_h[low] + RIDGE)
    return out


def fit(rows: np.ndarray, label: np.ndarray) -> Model:
    """Boost tables for rows of features and labels 0 or 1; the same rows give the same model."""
    if not len(rows):
        return Model()
    mean = (label.sum() + 0.5) / (len(label) + 1)
    model = Model(base=math.log(mean / (1 - mean)))
    grid = np.linspace(0, 1, BINS + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(rows[:, k], grid, method="higher")) for k in range(rows.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = model.bins(rows)
    total = np.full(len(rows), model.base)

    def left() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return label - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            g, h = left()
            n = len(model.tables[k])
            step = RATE * _tree(np.bincount(b, g, n), np.bincount(b, h, n))
            model.tables[k] += step
            total += step[b]

    rough = [coarse(b, c) for b, c in zip(bins, model.cuts)]
    g, h = left()
    cells = {(i, j): rough[i] * PAIR_BINS + rough[j] for i, j in itertools.combinations(range(len(bins)), 2)}
    size = PAIR_BINS * PAIR_BINS
    worth = {p: _gain(np.bincount(c, g, size), np.bincount(c, h, size) + RIDGE).sum() for p, c in cells.items()}
    chosen = sorted(worth, key=lambda p: (-worth[p], p))[:PAIRS]
    tables = {p: np.zeros(size) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for p in chosen:
            g, h = left()
            n = np.bincount(cells[p], minlength=size)
            step = RATE * np.where(n >= SMALLEST_LEAF, np.bincount(cells[p], g, size) / (np.bincount(cells[p], h, size) + RIDGE), 0)
            tables[p] += step
            total += step[cells[p]]
    model.pairs = [(i, j, tables[i, j].reshape(PAIR_BINS, PAIR_BINS)) for i, j in chosen]
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept back; a null id has no label to learn from and counts as kept back."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled rows that are not held out, ``sample`` of them at most."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.round(F.avg("quality")).alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # ``sample`` rows of two numbers
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.float64()), ("x", pa.list_(pa.float64()))])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(schema, ((d, q, features(t)) for d, q, t in values(stream)))

    found = texts.select("doc_id", "quality", "text").mapInArrow(run, "doc_id bigint, quality double, x array<double>")
    # repeated documents: one row per id, so that the sample's bound holds
    rows = found.groupBy("doc_id").agg(F.min(F.struct("x", "quality")).alias("row")).orderBy("doc_id").select("row.*").collect()
    table = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))
    return fit(table, np.array([r["quality"] for r in rows]))


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` as the struct ``kept``, and ``score``, the chance that a text is of quality 1."""
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col("text").alias("scored_text"))
    schema = kept.select("kept", F.lit(0.0).alias("score")).schema

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                if model.tables:
                    rows = np.array([features(t) for t in part.column(1).to_pylist()])
                    found = model.scores(rows)
                else:
                    found = np.full(part.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["kept", "score"])

    return kept.mapInArrow(run, schema)
