"""Personal data: fixed patterns, and what a character-level tagger finds beside them.

Base spans come from patterns. They also label the text that the tagger learns from: windows around them in a
bounded sample of documents, as they stand and rewritten into forms the patterns don't know (``name (at)
host dot org``, ``1[.]2[.]3[.]4``, cards with points, telephone numbers without a plus), and windows without any. Every
whole text is read in overlapping windows; pieces of one span from neighbouring windows are joined,
and of spans that exclude each other those are taken that weigh most together, over the whole text.
A tagged span that meets a base span adds nothing; the rest must look like their kind and are added.

A null text is an empty one. Rows stand for themselves: null and repeated ids, ties and repeated
rows are tagged like others. Where the sample holds no base span (an empty table) nothing is learnt
and nothing added. Columns named in ``kept`` come back as a struct, whatever their names.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, values
from tidemark.llm.tagger import PAD, Tagger, encode

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 20_000  #: documents looked at for training, about
SAMPLE_WINDOWS = 600  #: windows with a span, and as many without, at most
LEARNT = 72  #: characters in a window of training
WINDOW, OVERLAP = 224, 32
BLOCK = 440  #: windows that move together
HIDDEN, ROUNDS, BATCH, RATE = 8, 12, 128, 0.03

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that fails at its start fails from inside too, so only starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return _NOT_DIGITS.sub("", text)


def _small(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain and at >= end:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                end = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start, then kind; in time linear in the text."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _small(m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


# what the tagger learns from


def rewritten(kind: str, text: str, draw: random.Random) -> str:
    """A span's text with other digits and letters, as it is written or in a form the patterns don't know."""
    some = lambda n: "".join(draw.choices("0123456789", k=n))
    new = re.sub("[0-9]", lambda m: draw.choice("0123456789"), text)
    new = re.sub("[a-z]", lambda m: draw.choice("abcdefghijklmnopqrstuvwxyz"), new) if draw.random() < 0.5 else new
    if kind == "email":
        at = draw.choice(["@", " at ", " (at) ", "(at)", " [at] ", "[at]", " @ "])
        dot = "." if at in ("@", " @ ") else draw.choice([" dot ", " (dot) ", "(dot)", "[dot]", " [dot] ", "."])
        local, _, domain = text.partition("@")
        local = local if draw.random() < 0.5 else new.partition("@")[0]
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        dot = draw.choice([".", "[.]", "(.)", "[dot]", " . "])
        return dot.join(str(draw.randint(0, 255)) for _ in range(4))
    if kind == "card":
        gap, number = draw.choice(["", " ", "-", ".", "_"]), some(15)
        number += next(d for d in "0123456789" if luhn(number + d))
        return gap.join(number[k : k + 4] for k in range(0, 16, 4))
    gap = draw.choice([" ", "-", ".", " - "])
    head = draw.choice([f"+{some(1)}{gap}", "", f"00{some(2)}{gap}", "tel:"])
    area = some(3) if draw.random() < 0.5 else f"({some(3)})"
    return f"{head}{area}{gap}{some(3)}{gap}{some(4)}"


def _other_number(draw: random.Random) -> str:
    """A number that is nobody's data: a year, a price, a version, a short code."""
    n = draw.randint
    return draw.choice([f"{n(1900, 2099)}", f"{n(1, 9999)}.{n(0, 99):02d}", f"v{n(0, 9)}.{n(0, 20)}.{n(0, 9)}", f"{n(0, 99999)}", f"#{n(0, 999999):x}"])


def windows_of(text: str, mark: int) -> Iterator[tuple[bool, str, list[Span]]]:
    """Up to four windows around spans of a text, and one without any if a place drawn from ``mark`` has none."""
    draw = random.Random(mark)
    spans = base_spans(text)
    for _, start, end in draw.sample(spans, min(4, len(spans))):
        low = max(0, start - draw.randint(0, max(0, LEARNT - (end - start))))
        inside = [(k, a - low, b - low) for k, a, b in spans if low <= a and b <= low + LEARNT]
        cut = any(a < low < b or a < low + LEARNT < b for _, a, b in spans)
        if inside and not cut:
            yield True, text[low : low + LEARNT], inside
    low = draw.randint(0, max(0, len(text) - LEARNT))
    if text and not any(a < low + LEARNT and b > low for _, a, b in spans):
        yield False, text[low : low + LEARNT], []


def examples(windows: list[tuple[bool, str, list[Span]]], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes and labels: each window as it is, and those with spans twice more with these rewritten."""
    draw = random.Random(seed)
    texts: list[tuple[str, list[Span]]] = []
    for some, text, spans in windows:
        texts.append((text, spans))
        for _ in range(2 if some else 0):
            new, labelled, at = "", [], 0
            for kind, start, end in sorted(spans, key=lambda s: s[1]):
                if start < at:
                    continue
                new += text[at:start]
                other = rewritten(kind, text[start:end], draw)
                labelled.append((kind, len(new), len(new) + len(other)))
                new, at = new + other, end
            texts.append((new + text[at:], labelled))
        if not some:
            at = draw.randint(0, len(text))
            texts.append((f"{text[:at]} {_other_number(draw)} {text[at:]}", []))
    x = np.full((len(texts), LEARNT), PAD, np.uint8)
    y = np.zeros((len(texts), LEARNT), np.uint8)
    for row, (text, spans) in enumerate(texts):
        codes = encode(text[:LEARNT])
        x[row, : len(codes)] = codes
        for kind, start, end in spans:
            y[row, start:end] = KINDS.index(kind) + 1
    return x, y


def sample(docs: DataFrame) -> list[tuple[bool, str, list[Span]]]:
    """Windows of about ``SAMPLE_DOCS`` documents chosen by hash, ``SAMPLE_WINDOWS`` of each sort at most.

    The same rows give the same windows in any order. Collects a bounded number of short strings.
    """
    n = docs.count()
    mark = F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce(F.col("doc_id"), F.lit(0)))
    chosen = docs.select(mark.alias("mark"), F.coalesce("text", F.lit("")).alias("text"))
    if n > SAMPLE_DOCS:
        chosen = chosen.where(F.pmod("mark", F.lit(1_000_003)) < int(1_000_003 * SAMPLE_DOCS / n))
    schema = pa.schema([("some", pa.bool_()), ("mark", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("spans", pa.string())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for mark, text in values(stream):
                for part, (some, window, spans) in enumerate(windows_of(text, mark)):
                    yield some, mark, part, window, joined(spans)

        yield from batches(schema, rows())

    found = chosen.mapInArrow(run, "some boolean, mark bigint, part bigint, text string, spans string").distinct()
    picked = [
        found.where(F.col("some") == some).orderBy(F.xxhash64("mark", "part"), "mark", "part", "text").limit(SAMPLE_WINDOWS)
        for some in (True, False)
    ]
    parse = lambda s: [(k, int(a), int(b)) for k, a, b in (p.split(":") for p in s.split(",") if p)]
    return [(r["some"], r["text"], parse(r["spans"])) for side in picked for r in side.collect()]


def train(docs: DataFrame, seed: int = 7) -> Tagger | None:
    """A tagger fitted to the sample; None where there is nothing to learn from."""
    return fitted(sample(docs), seed)


def fitted(windows: list[tuple[bool, str, list[Span]]], seed: int = 7) -> Tagger | None:
    if not any(some for some, _, _ in windows):
        return None
    x, y = examples(windows, seed)
    tagger = Tagger.new(len(KINDS) + 1, HIDDEN, seed)
    rounds = max(ROUNDS, min(30, -(-ROUNDS * 2500 // len(x))))  # few examples are gone over more often
    tagger.fit(x, y, rounds, BATCH, RATE, seed)
    return tagger


# reading whole texts


def _looks_like(kind: str, text: str) -> bool:
    digits = len(_digits(text))
    if kind == "email":
        return re.fullmatch(r"[\w.%+-]+ ?(@|[(\[]?at[)\]]?) ?[\w-]+( ?(\.|[(\[]?dot[)\]]?) ?[\w-]+)+", text) is not None
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and _small(parts)
    if kind == "card":
        return 14 <= digits <= 19 and luhn(_digits(text)) and re.fullmatch("[0-9](?:[ ._-]?[0-9])+", text) is not None
    return 9 <= digits <= 15 and re.fullmatch(r"(?:tel:)?[+(]{0,2}[0-9](?:[ ().-]{0,3}[0-9])+", text) is not None


def reconciled(pieces: list[tuple[str, int, int, float]]) -> list[Span]:
    """Spans of a text from the labelled runs of all its windows.

    Runs of one kind that overlap or touch are one span, whose weight is their mean weight per
    character times its length. Of spans that overlap, those are kept that weigh most together.
    """
    whole: list[list] = []
    for kind in KINDS:
        last = None
        for _, start, end, weight in sorted(p for p in pieces if p[0] == kind):
            if last and start <= last[2]:
                last[2] = max(last[2], end)
                last[3] += weight
                last[4] += end - start
            else:
                last = [kind, start, end, weight, end - start]
                whole.append(last)
    spans = sorted(((k, a, b, w / n * (b - a)) for k, a, b, w, n in whole), key=lambda s: (s[2], s[1], KINDS.index(s[0])))
    ends = np.array([s[2] for s in spans], np.int64)
    best: list[tuple[float, int, bool]] = [(0.0, 0, False)]  # weight, spans looked at before, taken
    for n, (_, start, _, weight) in enumerate(spans):
        before = int(np.searchsorted(ends[:n], start, "right"))
        taken = best[before][0] + weight
        best.append((taken, before, True) if taken > best[n][0] else (best[n][0], n, False))
    kept, n = [], len(spans)
    while n:
        _, before, taken = best[n]
        if taken:
            kept.append(spans[n - 1][:3])
        n = before
    return kept[::-1]


def added(text: str, base: list[Span], tagged: list[Span]) -> list[Span]:
    """Tagged spans that look like their kind and meet no base span."""
    out = []
    for kind, start, end in tagged:
        inner = text[start:end]
        start, end = start + len(inner) - len(inner.lstrip(" \t\n,;:.")), end - len(inner) + len(inner.rstrip(" \t\n,;:."))
        if end > start and _looks_like(kind, text[start:end]) and not any(a < end and start < b for _, a, b in base):
            out.append((kind, start, end))
    return out


def tag(tagger: Tagger, texts: Iterator[tuple[object, str]]) -> Iterator[tuple[object, str, list[Span]]]:
    """Each (key, text) with its tagged spans, windows of all texts in blocks; memory is bounded by one text and a block."""
    step = WINDOW - OVERLAP
    waiting: list[list] = []  # key, text, classes, windows left, pieces
    block: list[tuple[list, int]] = []

    def work() -> None:
        x = np.full((len(block), WINDOW), PAD, np.uint8)
        for row, (doc, start) in enumerate(block):
            codes = doc[2][start : start + WINDOW]
            x[row, : len(codes)] = codes
        scores = tagger.scores(x)
        path = tagger.decode(scores)
        for row in np.nonzero(path.any(axis=1))[0]:
            doc, base = block[row]
            labels = path[row]
            edges = np.concatenate([[0], np.nonzero(labels[1:] != labels[:-1])[0] + 1, [WINDOW]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                label = labels[a]
                b_in = min(b, len(doc[2]) - base)
                if label and b_in > a:
                    weight = float((scores[a:b_in, label, row] - scores[a:b_in, 0, row]).sum())
                    doc[4].append((KINDS[label - 1], base + a, base + b_in, weight))
        for doc, _ in block:
            doc[3] -= 1
        block.clear()

    for key, text in texts:
        codes = encode(text)
        starts = range(0, max(1, len(codes) - OVERLAP), step) if len(codes) else ()
        doc = [key, text, codes, len(starts), []]
        waiting.append(doc)
        for start in starts:
            block.append((doc, start))
            if len(block) == BLOCK:
                work()
        while waiting and waiting[0][3] == 0:
            key, text, _, _, pieces = waiting.pop(0)
            yield key, text, reconciled(pieces)
    if block:
        work()
    for key, text, _, _, pieces in waiting:
        yield key, text, reconciled(pieces)


_SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def find(docs: DataFrame, tagger: Tagger | None, kept: list[str]) -> DataFrame:
    """``kept``, a struct of the named columns, and ``spans``: kind, start, end in code points, and whether a pattern found it."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = ((k, t or "") for k, t in enumerate(part.column(1).to_pylist()))
                tagged = tag(tagger, texts) if tagger else ((k, t, []) for k, t in texts)
                spans = []
                for _, text, beside in tagged:
                    base = base_spans(text)
                    both = [(s, True) for s in base] + [(s, False) for s in added(text, base, beside)]
                    both.sort(key=lambda s: (s[0][1], KINDS.index(s[0][0]), s[0][2]))
                    spans.append([{"kind": k, "start": a, "end": b, "base": by} for (k, a, b), by in both])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _ARROW_SPANS)], ["kept", "spans"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("kept"), F.col("text"))
    return rows.mapInArrow(run, f"kept {rows.schema['kept'].dataType.simpleString()}, spans {_SPANS}")
