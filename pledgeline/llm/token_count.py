"""Token counts as a byte-level tokenizer file gives them, also of texts too long for one step.

Texts of up to ``CHUNK_CHARS`` characters are counted as they are. Longer ones are encoded as
overlapping chunks with offsets and spliced at common pre-token starts (see ``chunks``): a chunk counts
the tokens that begin in the span it owns. Where two chunks have no common start, the text is cut again
with wider overlaps.

What comes before a pre-token start has no bearing on the tokens after it, and a decision looks ahead a
few characters only: a contraction, or a special string, which is why chunks are not trusted within
``LOOKAHEAD`` characters plus the longest special string of their end.

Within a text, no token reaches from a character that isn't white space into white space, so a text may
be cut before each single space between two such characters. Parts recur, so each Python worker
remembers the counts of up to ``REMEMBERED`` short ones.

Defined results: a null text counts as empty and has no tokens. Special strings inside a text are special
tokens, the library's default. Rows with equal ids or texts each give a row. Columns other than ``doc_id``
and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pledgeline.llm.chunks import CHUNK_CHARS, OVERLAP_CHARS, long_texts, spliced
from pledgeline.llm.common import shared_folder, text_or_empty

REMEMBERED = 400_000
REMEMBERED_CHARS = 48
#: Documents in one batch that a task hands back.
BATCH = 256
LOOKAHEAD = 8
LIMIT = 1024

COUNTED = "doc_id long, n_bytes long, n_tokens long"

# Python's white space includes that of the tokenizer, so that each of these cuts is a safe one.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_OTHER_SPACE = re.compile(r"\s |  | \s|^ | $")

_OPENED: dict[str, Counter] = {}


class _Parts(dict):
    """Token counts of text parts that follow ``prefix``."""

    def __init__(self, tokenizer: Tokenizer, prefix: str):
        super().__init__()
        self.tokenizer, self.prefix = tokenizer, prefix

    def __missing__(self, part: str) -> int:
        n = len(self.tokenizer.encode(self.prefix + part, add_special_tokens=False))
        if len(self) < REMEMBERED and len(part) <= REMEMBERED_CHARS:
            self[part] = n
        return n


class Counter:
    """Counts tokens by one tokenizer file."""

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_str(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.first, self.spaced = _Parts(self.tokenizer, ""), _Parts(self.tokenizer, " ")

    def count(self, text: str) -> int:
        if not text:
            return 0
        if _OTHER_SPACE.search(text):
            return sum(map(self.first.__getitem__, _CUT.split(text)))
        head, *rest = text.split(" ")
        return self.first[head] + sum(map(self.spaced.__getitem__, rest))

    def read(self, piece: str) -> tuple[list[int], list[int]]:
        """Where the pre-tokens and where the tokens of a chunk begin."""
        found = self.tokenizer.encode(piece, add_special_tokens=False)
        starts = [begin for begin, _ in found.offsets]
        words = found.word_ids
        new = [k for k in range(len(words)) if k == 0 or words[k] != words[k - 1]]
        return [starts[k] for k in new], starts


class TokenizerFile:
    """A tokenizer file, read by the driver (a few MB) and opened once per Python worker."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        made = json.loads(text)
        before = made.get("pre_tokenizer") or {}
        if (
            made.get("normalizer")
            or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space")
            or any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in made["added_tokens"])
        ):
            raise ValueError(f"{path}: only byte-level tokenizers can be cut at white space")
        self.margin = LOOKAHEAD + max([0, *(len(t["content"]) for t in made["added_tokens"])])
        self.text = spark.sparkContext.broadcast(text)
        self.digest = hashlib.sha256(text.encode()).hexdigest()

    def open(self) -> Counter:
        if self.digest not in _OPENED:
            _OPENED[self.digest] = Counter(self.text.value)
        return _OPENED[self.digest]


def _counted(file: TokenizerFile):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = file.open()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                counts = [counter.count(text) for text in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = LIMIT,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``."""
    spark = docs.sparkSession
    file = TokenizerFile(spark, path)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    short = (
        texts.filter(F.length("text") <= chunk_chars)
        .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
        .mapInArrow(_counted(file), COUNTED)
    )
    chunks = spliced(
        long_texts(texts, chunk_chars),
        lambda: file.open().read,
        "array<long>",
        file.margin,
        shared_folder(spark),
        chunk_chars,
        overlap_chars,
    )

    def owned(at):
        return (F.col("begin") <= F.col("start") + at) & (F.col("start") + at < F.col("until"))

    long = (
        chunks.withColumn("held", F.size(F.filter("value", owned)).cast("long"))
        .groupBy("doc_id", "digest", "copies", "n_bytes")
        .agg(F.sum("held").alias("n_tokens"))
        .select(
            "doc_id",
            "n_bytes",
            "n_tokens",
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
