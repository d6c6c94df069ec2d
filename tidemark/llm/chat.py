"""Chat formatting: conversations as one text, encoded once, with a loss mask aligned by offsets.

**Template.** A turn is ``<s>[INST] role [/INST]text</s>``. Inside roles and texts a backslash is
doubled and a control string gets a backslash after its first character, so that no turn can forge a
mark; ``unescape`` undoes it exactly.

**Mask.** The text is encoded once, with offsets. Token spans and the spans of assistant texts are
both sorted, so for each turn span two binary searches give the tokens that meet it. The mask is kept
as the pieces of text each such token contributes: a token that reaches over the end of a turn counts
only with what lies inside.

Turns are ordered by turn, then role, then text; null turns first. A null role or text is an empty
one. Repeated rows are repeated turns. Rows with a null conv_id form one conversation. An empty table
gives no rows; columns other than the four are not read. A conversation is cut between turns once a
piece has ``SEGMENT`` characters, so that a conversation of any length is formatted in bounded memory;
its pieces are rows numbered by ``segment``.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, pre_tokenizers, processors

from tidemark.llm.common import batches, values

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
SEGMENT = 2_000_000
_MARKS = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(r"<s>\[INST\] (?P<role>.*?) \[/INST\](?P<text>.*?)</s>", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _MARKS.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST] {escape(role)} [/INST]", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}</s>")
        at += len(parts[-1])
    return "".join(parts), spans


@functools.cache
def _tokenizer(path: str) -> Tokenizer:
    """The vocabulary, with offsets that keep white space and control strings taken as ordinary text."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
    return tokenizer


def loss_pieces(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For tokens that meet a span: their index, and the start and end of what they share with it.

    A character whose bytes are dealt over several tokens belongs to the first of them.
    """
    starts, ends = offsets[:, 0], offsets[:, 1]
    reached = np.maximum.accumulate(np.concatenate([[0], ends]))[:-1] if len(ends) else ends
    starts = np.maximum(starts, reached)
    tokens, begin, finish = [], [], []
    for low, high in spans:
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        index = np.arange(first, last)
        tokens.append(index)
        begin.append(np.maximum(starts[first:last], low))
        finish.append(np.maximum(np.minimum(ends[first:last], high), begin[-1]))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(tokens or none), np.concatenate(begin or none), np.concatenate(finish or none)


_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("segment", pa.int32()),
        ("formatted", pa.string()),
        ("ids", pa.list_(pa.int32())),
        ("loss_token", pa.list_(pa.int32())),
        ("loss_start", pa.list_(pa.int32())),
        ("loss_end", pa.list_(pa.int32())),
    ]
)
_DDL = (
    "conv_id bigint, segment int, formatted string, ids array<int>, "
    "loss_token array<int>, loss_start array<int>, loss_end array<int>"
)


def format_chats(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """One row per conversation (or per segment of a very long one): its text, ids and loss mask.

    ``loss_token`` lists the indexes of the ids under the mask, ``loss_start`` and ``loss_end`` the
    characters of ``formatted`` each stands for. Rows of a conversation lie in one task, in order.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokenizer(tokenizer)

        def row(conv_id: int, segment: int, turns: list[tuple[str, str]]) -> tuple:
            formatted, spans = render(turns)
            encoded = encoder.encode(formatted, add_special_tokens=False)
            offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
            tokens, begin, finish = loss_pieces(offsets, spans)
            return conv_id, segment, formatted, encoded.ids, tokens, begin, finish

        def rows() -> Iterator[tuple]:
            for conv_id, group in itertools.groupby(values(stream), key=lambda r: r[0]):
                segment, size, turns = 0, 0, []
                for _, _, role, text in group:
                    if size >= SEGMENT:
                        yield row(conv_id, segment, turns)
                        segment, size, turns = segment + 1, 0, []
                    turns.append((role or "", text or ""))
                    size += len(turns[-1][1])
                yield row(conv_id, segment, turns)

        yield from batches(_SCHEMA, rows(), 64)

    ordered = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _DDL)


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
_READ_DDL = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what the output of ``format_chats`` says: its turns, and the text under its mask."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv_id, group in itertools.groupby(values(stream), key=lambda r: r[0]):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = formatted_chars = 0
                for _, formatted, begin, finish in group:
                    formatted_chars += len(formatted)
                    for m in _TURN.finditer(formatted):
                        n_turns += 1
                        turns.update(f"{unescape(m['role'])}\n{unescape(m['text'])}\n".encode())
                    masked = unescape("".join(formatted[a:b] for a, b in zip(begin, finish)))
                    loss_chars += len(masked)
                    loss.update(masked.encode())
                yield conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted_chars

        yield from batches(_READ, rows())

    return chats.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(run, _READ_DDL)
