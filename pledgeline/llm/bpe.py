"""Byte-level BPE over ranks: encoding by overlapping chunks, decoding by joining raw bytes.

Texts of up to ``CHUNK_CHARS`` characters are encoded as they are. Longer ones are pre-tokenised as
overlapping chunks, each in a task of its own, stitched where the pre-token boundaries of two chunks resynchronise
(see ``chunks``), and then the pieces, which together are exactly the text, are encoded apart.

Within a text, no pre-token reaches from a character that isn't white space into white space, so a
text may be cut before each single space between two such characters and the parts encoded alone.
Parts recur, so each Python worker remembers the ids of up to ``REMEMBERED`` short ones.

Defined results: a null text counts as empty and has no ids. Rows with equal ids or texts each give a
row. Columns other than ``doc_id`` and ``text`` are ignored. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeline.llm.chunks import CHUNK_CHARS, OVERLAP_CHARS, long_texts, spliced
from pledgeline.llm.common import shared_folder, text_or_empty

#: Part ids that a Python worker remembers, and the longest part that it remembers.
REMEMBERED = 400_000
REMEMBERED_CHARS = 48
#: Documents in one batch that a task hands back.
BATCH = 256
#: Characters that the choice of a pre-token may look ahead, beyond its own end: a contraction.
LOOKAHEAD = 4

ENCODED = "doc_id long, n_tokens long, ids binary"

# Python's white space includes that of the pattern, so that each of these cuts is a safe one.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_OTHER_SPACE = re.compile(r"\s |  | \s|^ | $")

_OPENED: dict[str, Codec] = {}


class _Parts(dict):
    """Ids (as bytes) of text parts that follow ``prefix``."""

    def __init__(self, encoding: tiktoken.Encoding, prefix: str):
        super().__init__()
        self.encoding, self.prefix = encoding, prefix

    def __missing__(self, part: str) -> bytes:
        ids = array("I", self.encoding.encode_ordinary(self.prefix + part)).tobytes()
        if len(self) < REMEMBERED and len(part) <= REMEMBERED_CHARS:
            self[part] = ids
        return ids


class Codec:
    """Encodes and decodes texts by the ranks of one vocabulary file."""

    def __init__(self, ranks: bytes, pattern: str):
        lines = (line.split() for line in ranks.splitlines() if line)
        table = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes_of = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self.bytes_of[rank] = token
        self.pattern = regex.compile(pattern)
        encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        self.first, self.spaced = _Parts(encoding, ""), _Parts(encoding, " ")

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if _OTHER_SPACE.search(text):
            return b"".join(map(self.first.__getitem__, _CUT.split(text)))
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.spaced.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def starts(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text)]


class Vocabulary:
    """A rank file, read by the driver (a few MB at most) and opened once per Python worker."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = file.read()
        self.ranks = spark.sparkContext.broadcast(ranks)
        self.pattern = pattern
        self.digest = hashlib.sha256(ranks + pattern.encode()).hexdigest()

    def open(self) -> Codec:
        if self.digest not in _OPENED:
            _OPENED[self.digest] = Codec(self.ranks.value, self.pattern)
        return _OPENED[self.digest]


def _encoded_whole(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = vocabulary.open()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                ids = [codec.encode(text) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "ids"],
                )

    return run


def _encoded_pieces(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = vocabulary.open()
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                piece = row["value"][row["begin"] - row["start"] : row["until"] - row["start"]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([row["doc_id"]], pa.int64()),
                        "digest": [row["digest"]],
                        "copies": pa.array([row["copies"]], pa.int64()),
                        "k": pa.array([row["k"]], pa.int64()),
                        "ids": pa.array([codec.encode(piece)], pa.binary()),
                    }
                )

    return run


def _joined(pieces: pa.Table) -> pa.Table:
    """The ids of one long document, from its pieces in order."""
    rows = sorted(pieces.to_pylist(), key=lambda r: r["k"])
    ids = b"".join(r["ids"] for r in rows)
    return pa.table(
        {
            "doc_id": pieces["doc_id"][:1],
            "copies": pieces["copies"][:1],
            "n_tokens": pa.array([len(ids) // 4], pa.int64()),
            "ids": pa.array([ids], pa.binary()),
        }
    )


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of each document."""
    if pattern != public_tokenizers.PATTERN:
        raise ValueError("texts can be cut safely by the pattern of the public tokenizers only")
    spark = docs.sparkSession
    vocabulary = Vocabulary(spark, path, pattern)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    short = texts.filter(F.length("text") <= chunk_chars).mapInArrow(
        _encoded_whole(vocabulary), ENCODED
    )

    def reader():
        codec = vocabulary.open()
        return lambda piece: (codec.starts(piece), piece)

    chunks = spliced(
        long_texts(texts, chunk_chars),
        reader,
        "string",
        LOOKAHEAD,
        shared_folder(spark),
        chunk_chars,
        overlap_chars,
    )
    pieces = chunks.select(
        "doc_id", "digest", "copies", "k", "start", "begin", "until", "value"
    ).mapInArrow(
        _encoded_pieces(vocabulary), "doc_id long, digest string, copies long, k long, ids binary"
    )
    long = pieces.groupBy("doc_id", "digest").applyInArrow(
        _joined, "doc_id long, copies long, n_tokens long, ids binary"
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return short.unionByName(
        long.select("doc_id", "n_tokens", "ids", each.alias("copy")).drop("copy")
    )


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The columns of ``encoded`` with ``ids`` replaced by ``decoded``, the bytes they stand for.

    Null ids count as none.
    """
    vocabulary = Vocabulary(encoded.sparkSession, path, pattern)
    rows = encoded.select(*[c for c in encoded.columns if c != "ids"], F.col("ids"))
    names = [*rows.columns[:-1], "decoded"]
    schema = rows.withColumnRenamed("ids", "decoded").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = vocabulary.open()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                decoded = [codec.decode(ids or b"") for ids in part.column(len(names) - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(decoded, pa.binary())], names
                )

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, and the SHA-256 of the ids and of the bytes that they decode to."""
    encoded = encode(docs, path, pattern).withColumn("ids_sha256", F.sha2("ids", 256))
    return decode(encoded, path, pattern).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
