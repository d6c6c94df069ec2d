"""Token ids in binary chunks: blocks of ids are cut into byte planes, each compressed by itself.

**Format.** A token table is a folder with three Parquet tables, the containers that any store Spark
writes to can hold:

* ``chunks``: one row per chunk, a chunk being whole documents in ascending order of doc_id: ``part``
  and ``chunk`` (their order is the order of the ids), ``ahead`` (ids of the part's chunks before it),
  ``n_ids``, ``doc_id`` and ``n_tokens`` (one entry per document), ``planes``. The ids of a chunk are cut into blocks of ``BLOCK`` (the last one
  shorter); each block is written as four byte planes (all lowest bytes, then the next ones, ...),
  every plane a zstandard frame of its own; ``planes`` has them block by block.
* ``parts``: one row per writing task: ``part``, ``base`` (ids of all parts before it);
* ``index``: one row per chunk: ``part``, ``chunk``, ``start`` (ids of all chunks before it), ``n_ids``,
  ``n_docs``, ``first_doc``, ``last_doc``. A reader that wants a range of ids reads the index and those
  chunks, and of a chunk only the blocks in question.

Documents with a null id come first; rows with the same id are written next to each other, ordered by
their text. A null text is encoded as an empty one. Every document ends with ``end_id``. Columns other
than doc_id and text are not read; an empty table gives an empty token table. A chunk holds whole
documents and is closed at ``CHUNK`` ids, so only a single longer document makes a larger one.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import batches, values

BLOCK = 1 << 16
CHUNK = 1 << 20
#: Pieces whose ids a worker remembers, twice over (the newer and the older half).
REMEMBERED = 400_000
LEVEL = 3


#: Bytes as the characters that stand for them in byte-level vocabularies: printable ones for themselves,
#: the others, in order, for the characters from 256 on.
_PRINTABLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_CHARACTER = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
#: The pieces of a lower-cased text of plain Latin letters, digits and ASCII symbols.
_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00DF-\u00F6\u00F8-\u012F\u0131-\u017F]+|[0-9]|[!-/:-@\[-`{-~]+"
)
_SPACES = " \n\t\r\x0b\x0c"
#: What is done to a text, and how it is cut, before pieces reach the vocabulary; a file that says
#: something else is always asked word by word.
_KNOWN_STEPS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}


class PieceIds(dict):
    """Ids of pieces of text, as bytes, looked up in the vocabulary when first met.

    For vocabularies that cut a text into pieces, drop white space and join no token across pieces, so
    that a text's ids are those of its pieces one after the other. Texts of plain Latin letters, digits
    and symbols are lower-cased and cut here; any other text is parted at ASCII white space, and words
    that hold something else are given to the tokenizer. Two generations are kept, so that frequent
    pieces stay and memory is bounded.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.older: dict[str, bytes] = {}
        steps = json.loads(self.tokenizer.to_str())
        cut = ((steps["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        self.plain = steps["normalizer"] == _KNOWN_STEPS["normalizer"] and cut == _KNOWN_STEPS["pattern"]

    def __missing__(self, piece: str) -> bytes:
        """A piece, or a space and a word for the tokenizer."""
        ids = self.older.get(piece)
        if ids is None:
            if piece[0] == " ":
                found = self.tokenizer.encode(piece[1:], add_special_tokens=False).ids
            else:
                letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_CHARACTER)
                found = [t.id for t in self.model.tokenize(letters)]
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def pieces(self, text: str) -> list[str] | None:
        """The pieces of a plain text, None of another one."""
        low = text.lower()
        found = _PIECES.findall(low)
        whole = sum(map(len, found)) + sum(map(low.count, _SPACES)) == len(low)
        return found if self.plain and whole and "<|" not in low else None  # <| may open a special token

    def encode(self, text: str) -> bytes:
        found = self.pieces(text)
        if found is None:
            found = []
            for word in text.encode().split():
                plain = self.pieces(word := word.decode())
                found += [f" {word}"] if plain is None else plain
        return b"".join(map(self.__getitem__, found))


@functools.cache
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def pack(ids: np.ndarray) -> list[bytes]:
    """Blocks of ids as compressed byte planes."""
    planes = []
    shrink = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    for start in range(0, len(ids), BLOCK):
        block = ids[start : start + BLOCK].astype("<u4").view(np.uint8).reshape(-1, 4)
        planes += [shrink.compress(np.ascontiguousarray(block[:, k]).tobytes()) for k in range(4)]
    return planes


def unpack(planes: list[bytes]) -> np.ndarray:
    """The ids that ``pack`` was given."""
    grow = zstandard.ZstdDecompressor()
    blocks = []
    for start in range(0, len(planes), 4):
        bytes_of = [np.frombuffer(grow.decompress(p), np.uint8) for p in planes[start : start + 4]]
        blocks.append(np.stack(bytes_of, axis=1).reshape(-1).view("<u4"))
    return np.concatenate(blocks) if blocks else np.zeros(0, "<u4")


_CHUNKS = pa.schema(
    [
        ("part", pa.int32()),
        ("chunk", pa.int32()),
        ("ahead", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_id", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("planes", pa.list_(pa.binary())),
    ]
)
_CHUNKS_DDL = "part int, chunk int, ahead bigint, n_ids bigint, doc_id array<bigint>, n_tokens array<bigint>, planes array<binary>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``text`` of all documents and write the token table to ``path``.

    ``tokenizer`` is the path of a vocabulary file, which every worker must reach.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_ids(tokenizer)
        part, end = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()

        def chunks() -> Iterator[tuple]:
            number, ahead, n, docs_of, sizes, held = 0, 0, 0, [], [], []
            for doc_id, text in values(stream):
                ids = known.encode(text or "") + end
                docs_of.append(doc_id)
                sizes.append(len(ids) // 4)
                held.append(ids)
                n += sizes[-1]
                if n >= CHUNK:
                    yield part, number, ahead, n, docs_of, sizes, pack(np.frombuffer(b"".join(held), "<u4"))
                    number, ahead, n, docs_of, sizes, held = number + 1, ahead + n, 0, [], [], []
            if docs_of:
                yield part, number, ahead, n, docs_of, sizes, pack(np.frombuffer(b"".join(held), "<u4"))

        yield from batches(_CHUNKS, chunks(), 1)

    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    ordered.mapInArrow(run, _CHUNKS_DDL).write.parquet(f"{path}/chunks")

    spark = docs.sparkSession
    chunks = spark.read.schema(_CHUNKS_DDL).parquet(f"{path}/chunks")
    by_part = chunks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per writing task
    by_part.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")).write.parquet(f"{path}/parts")
    chunks.join(_parts(spark, path), "part").select(
        "part",
        "chunk",
        (F.col("base") + F.col("ahead")).alias("start"),
        "n_ids",
        F.size("doc_id").cast("bigint").alias("n_docs"),
        F.element_at("doc_id", 1).alias("first_doc"),
        F.element_at("doc_id", -1).alias("last_doc"),
    ).write.parquet(f"{path}/index")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Broadcast: two numbers for each task that wrote, however large the texts were."""
    return F.broadcast(spark.read.schema("part int, base bigint").parquet(f"{path}/parts"))


_DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk of a token table, with the number of ids before it: what ``documents_of`` takes."""
    chunks = spark.read.schema(_CHUNKS_DDL).parquet(f"{path}/chunks").join(_parts(spark, path), "part")
    return chunks.select("part", "chunk", (F.col("base") + F.col("ahead")).alias("start"), "doc_id", "n_tokens", "planes")


def documents_of(chunks: DataFrame) -> DataFrame:
    """Each document as its chunk holds it: doc_id, start, n_tokens, and a checksum of its ids."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in stream:
                for k in range(batch.num_rows):  # one chunk at a time as Python objects
                    start, doc_ids, sizes, planes = (c[k].as_py() for c in batch.columns)
                    ids, at = unpack(planes), 0
                    for doc_id, n in zip(doc_ids, sizes):
                        yield doc_id, start + at, n, zlib.crc32(ids[at : at + n].tobytes())
                        at += n

        yield from batches(_DOCUMENTS, rows())

    return chunks.select("start", "doc_id", "n_tokens", "planes").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
