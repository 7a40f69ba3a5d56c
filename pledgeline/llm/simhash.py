"""Near duplicates by SimHash, with candidates from covering locality-sensitive hashing.

Fingerprint: the words of a text (A-Z lower-cased) give shingles of three words, each shingle its
64-bit XXH64, and a bit of the fingerprint is set if more than half of the shingles have it set.

Candidates: give each of the 64 bit positions a nonzero vector of ``radius + 1`` bits. For every
nonzero vector v there is one table, whose mask holds the positions whose vector has an odd product
with v. If two fingerprints differ in at most ``radius`` positions, the vectors of these positions
span too little to leave no v orthogonal to all of them, and in the table of that v the masked
fingerprints are equal. So every pair within the radius meets in some table: no pair is missed.

Each distinct fingerprint goes in once, with one row per table. In a bucket of at most ``MAX_BUCKET``
fingerprints, pairs are compared. The fingerprints of larger buckets take another exact way, whose
work is linear in their number: if two fingerprints are within three bits, some word z lies within
one bit of the one and two bits of the other. All fingerprints within one bit of z are linked to the
smallest of them, and so are all that lie within two bits of z. Every such link is itself within
three bits, so the components are the same as with all pairs.

Defined results: a text that is null or has no words has fingerprint zero, linked like any other. A
text of fewer than three words has one shingle, all its words. Rows with equal ids or texts each give
a row. ``component_id`` ignores null ids; it is null if all ids of a component are. Columns other than
``doc_id`` and ``text`` are ignored. Of each component ``one_of_each`` keeps the document with the
smallest id, a null id being the largest, and among equal ids the one with the smallest SHA-256 (null
texts first); it is known by id and digest, so equal or null ids of several components don't meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import only_once, shared_folder, stored
from pledgeline.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
MAX_BUCKET = 256
#: Shingle hashes whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()  # of bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(shingle, len(words)) - 1
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist())
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), BLOCK):
        block = hashes[k : k + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the ``carried`` columns and ``fp``, the fingerprint as a signed long."""
    kept = ["doc_id", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_py(), shingle) for text in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(fps, pa.int64())], [*kept, "fp"]
            )

    schema = docs.select(*kept).withColumn("fp", F.lit(0).cast("long")).schema
    return docs.select(*kept, "text").mapInArrow(run, schema)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The bits of each table, as signed longs: 2^(radius + 1) - 1 of them."""
    vectors = (1 << radius + 1) - 1
    masks = [
        sum(1 << i for i in range(64) if ((i % vectors + 1) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]
    return [_signed(m) for m in masks]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _ball(radius: int) -> list[int]:
    """All words of at most so many set bits, as signed longs."""
    words, ball = {0}, {0}
    for _ in range(radius):
        words = {w | 1 << i for w in words for i in range(64) if not w >> i & 1}
        ball |= words
    return sorted(_signed(w) for w in ball)


def _longs(values: list[int]):
    return F.array(*[F.lit(v).cast("long") for v in values])


def links(distinct: DataFrame, folder: str, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``src, dst``: links between distinct fingerprints (column ``fp``) within the radius.

    Between fingerprints of small buckets, all of them; between those of larger ones, enough to have
    the same components.
    """
    masks = covering_masks(radius)
    keyed = distinct.select("fp", F.posexplode(_longs(masks)).alias("table", "mask")).select(
        "fp", "table", F.col("fp").bitwiseAND(F.col("mask")).alias("key")
    )
    bucket = ["table", "key"]
    shared = stored(
        keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("held")).filter("held > 1"),
        folder,
        "buckets",
    )
    met = stored(keyed.join(shared, bucket), folder, "met")
    small = met.filter(F.col("held") <= max_bucket)
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius
    pairs = (
        small.select(*bucket, F.col("fp").alias("src"))
        .join(small.select(*bucket, F.col("fp").alias("dst")), bucket)
        .filter((F.col("src") < F.col("dst")) & near)
        .select("src", "dst")
        .distinct()
    )
    crowded = stored(
        met.filter(F.col("held") > max_bucket).select("fp").distinct(), folder, "crowded"
    )
    if crowded.isEmpty():
        return pairs
    inner, outer = _ball(radius // 2), _ball(radius - radius // 2)
    around = lambda ball: crowded.select(
        "fp", F.explode(_longs(ball)).alias("step")
    ).select("fp", F.col("fp").bitwiseXOR(F.col("step")).alias("z"))
    centres = stored(
        around(inner).groupBy("z").agg(F.min("fp").alias("centre")), folder, "centres"
    )
    stars = around(outer).join(centres, "z").filter("fp <> centre")
    return pairs.union(stars.select(F.col("fp").alias("src"), F.col("centre").alias("dst")))


def _rooted(prints: DataFrame, least: Column, folder: str, radius: int, max_bucket: int) -> DataFrame:
    """``fp``, ``least`` (the aggregate of its rows) and ``root`` of each distinct fingerprint."""
    distinct = stored(prints.groupBy("fp").agg(least.alias("least")), folder, "distinct")
    roots = components(links(distinct.select("fp"), folder, radius, max_bucket), folder)
    return stored(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        folder,
        "rooted",
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, max_bucket: int = MAX_BUCKET
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``, the smallest id reachable."""
    folder = shared_folder(docs.sparkSession)
    prints = stored(fingerprints(docs, shingle), folder, "prints")
    rooted = _rooted(prints, F.min("doc_id"), folder, radius, max_bucket)
    smallest = stored(
        rooted.groupBy("root").agg(F.min("least").alias("component_id")), folder, "smallest"
    )
    classes = stored(
        rooted.join(smallest, "root").select("fp", "component_id"), folder, "classes"
    )
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component, with all its columns."""
    folder = shared_folder(docs.sparkSession)
    digest = F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b""))
    marked = docs.withColumn("_llm_digest", digest)
    prints = stored(fingerprints(marked, carried=("_llm_digest",)), folder, "prints")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_llm_digest")
    rooted = _rooted(prints, F.min(rank), folder, RADIUS, MAX_BUCKET)
    # equal texts have equal fingerprints, so no id and digest is chosen for two components
    chosen = rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.*")
    return only_once(marked, chosen, ["doc_id", "_llm_digest"]).drop("_llm_digest")
