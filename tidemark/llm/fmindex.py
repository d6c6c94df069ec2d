"""A bidirectional FM-index over a delimited vocabulary, and search schemes for one error.

The text is ``#w1#w2#...#wn#``. A state is a pattern's interval of suffix ranks in the text and the
interval of its reverse in the reversed text, which are equally long, so a pattern grows on either side. A
word within one edit of another has its first or its second half unchanged: match that half
exactly, next to its delimiter, then grow across the other half with exactly one edit. States of all
patterns of one length are numpy arrays and move together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np

END, MARK = 0, 1  #: codes of the text's end and of the delimiter; characters follow


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_ranks(codes: np.ndarray) -> np.ndarray:
    """The suffix array, by doubling; the last code is the least and stands once."""
    rank = codes.astype(np.int64)
    step = 1
    while True:
        later = np.full(len(rank), -1, np.int64)
        later[:-step] = rank[step:]
        order = np.lexsort((later, rank))
        changed = (rank[order][1:] != rank[order][:-1]) | (later[order][1:] != later[order][:-1])
        rank = np.empty(len(rank), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(changed)])
        if rank[order[-1]] == len(rank) - 1 or step >= len(rank):
            return order
        step *= 2


class _Ranks:
    """Where each code's suffixes begin, and how many of each code stand before each rank of the transform."""

    def __init__(self, codes: np.ndarray, size: int) -> None:
        self.order = suffix_ranks(codes)
        transform = codes[self.order - 1]
        counts = np.zeros((len(codes) + 1, size), np.int32)
        counts[np.arange(1, len(codes) + 1), transform] = 1
        self.before = np.cumsum(counts, axis=0, dtype=np.int32)
        self.first = np.concatenate([[0], np.cumsum(self.before[-1])[:-1]]).astype(np.int64)


class States:
    """Intervals of many patterns: which pattern, its rank in the text and in the reversed text, its length."""

    def __init__(self, pattern: np.ndarray, text: np.ndarray, back: np.ndarray, size: np.ndarray) -> None:
        self.pattern, self.text, self.back, self.size = pattern, text, back, size

    def where(self, kept: np.ndarray) -> States:
        return States(self.pattern[kept], self.text[kept], self.back[kept], self.size[kept])

    def __add__(self, other: States) -> States:
        mine, theirs = vars(self).values(), vars(other).values()
        return States(*(np.concatenate(pair) for pair in zip(mine, theirs)))

    def __len__(self) -> int:
        return len(self.pattern)


class Index:
    """The words, each to be found by its position among them."""

    def __init__(self, words: list[str], alphabet_of: list[str]) -> None:
        joined = code_points("".join(words))
        self.alphabet = np.unique(np.concatenate([joined, code_points("".join(alphabet_of))]))
        lengths = np.array([len(w) for w in words])
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])  # of the delimiter before each word
        codes = np.full(starts[-1] + 2, MARK, np.int64)
        codes[-1] = END
        inside = np.ones(len(codes), bool)
        inside[starts], inside[-1] = False, False
        codes[inside] = self.coded(joined)
        self.word_at = np.full(len(codes), -1, np.int64)
        self.word_at[starts[:-1]] = np.arange(len(words))
        size = len(self.alphabet) + 2
        self.forward = _Ranks(codes, size)
        self.backward = _Ranks(np.concatenate([codes[-2::-1], [END]]), size)

    def coded(self, points: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.alphabet, points) + 2

    def marks(self, n: int) -> States:
        """The delimiter, as the beginning of ``n`` patterns."""
        first, count = self.forward.first[MARK], int(self.forward.before[-1, MARK])
        return States(np.arange(n), np.full(n, first), np.full(n, first), np.full(n, count))

    def grown(self, states: States, codes: np.ndarray, right: bool) -> States:
        """Each state with its own code added on one side; those without a match drop out."""
        ranks = self.backward if right else self.forward
        near, far = (states.back, states.text) if right else (states.text, states.back)
        low, high = ranks.before[near], ranks.before[near + states.size]
        row = np.arange(len(states))
        size = (high[row, codes] - low[row, codes]).astype(np.int64)
        lesser = np.concatenate([np.zeros((len(states), 1), np.int64), np.cumsum(high - low, axis=1, dtype=np.int64)], axis=1)
        near, far = ranks.first[codes] + low[row, codes], far + lesser[row, codes]
        text, back = (far, near) if right else (near, far)
        return States(states.pattern, text, back, size).where(size > 0)

    def grown_by_any(self, states: States, right: bool) -> tuple[States, np.ndarray]:
        """Each state with every character that stands next to it, and those characters' codes."""
        ranks = self.backward if right else self.forward
        near = states.back if right else states.text
        some = (ranks.before[near + states.size] - ranks.before[near]) > 0
        some[:, : MARK + 1] = False
        row, codes = np.nonzero(some)
        return self.grown(states.where(row), codes, right), codes

    def one_error(self, halves: np.ndarray, others: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (pattern, word): the half as it is, the other half with exactly one edit.

        Both are arrays of codes, a row per pattern, in the order in which the pattern grows: away
        from the delimiter at the half's outer end, up to the one at the other end.
        """
        states = self.marks(len(halves))
        for column in halves.T:
            states = self.grown(states, column[states.pattern], right)
        n = others.shape[1]
        clean, edited = states, [states.where(np.zeros(len(states), bool)) for _ in range(n + 1)]
        for at in range(n + 1):
            more, _ = self.grown_by_any(clean, right)  # one character more in the word
            edited[at] += more
            if at == n:
                break
            wanted = others[:, at]
            other, codes = self.grown_by_any(clean, right)
            edited[at + 1] += other.where(codes != wanted[other.pattern])  # another character
            edited[at + 1] += clean  # one character less
            edited[at + 1] += self.grown(edited[at], wanted[edited[at].pattern], right)
            clean = self.grown(clean, wanted[clean.pattern], right)
        whole = self.grown(edited[n], np.full(len(edited[n]), MARK), right)
        # the pattern is now #word#, which stands once
        pairs = np.unique(np.stack([whole.pattern, self.word_at[self.forward.order[whole.text]]], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def near_words(words: list[str], asked: list[str], first_half: bool) -> Iterator[tuple[int, int]]:
    """Places in ``asked`` and ``words`` of pairs one edit apart that share the asked word's first (or second) half.

    ``words`` are distinct.
    """
    index = Index(words, asked)
    by_length = defaultdict(list)
    for place, word in enumerate(asked):
        by_length[len(word)].append(place)
    for length, places in by_length.items():
        codes = index.coded(code_points("".join(asked[p] for p in places))).reshape(-1, length)
        cut = length // 2
        if first_half:
            found = index.one_error(codes[:, :cut], codes[:, cut:], right=True)
        else:
            found = index.one_error(codes[:, cut:][:, ::-1], codes[:, :cut][:, ::-1], right=False)
        for pattern, word in zip(*(f.tolist() for f in found)):
            yield places[pattern], word
