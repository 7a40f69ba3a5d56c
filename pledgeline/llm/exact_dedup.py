"""Exact duplicates by a minimal perfect hash over the distinct digests of a history.

The history's distinct SHA-256 digests are cut into shards by their first bytes. Each shard gets a
minimal perfect hash of its own: on every level a digest hashes into a bit array, digests that are
alone on their bit are settled, the others go on to the next level; the rank of the bit is the slot.
A slot holds the full digest and the locator of the winner (its id and the size of its group).

A lookup computes the slot and compares the full digest, byte for byte: a digest that is not in the
history also gets some slot, and only the comparison tells. Rows found are repeats of the history,
the rest (nonmembers) group among themselves.

Rows of documents travel as 32-byte digests, never as text. A shard looked up by many rows (one
digest may hold a third of them) is dealt to as many salted copies as its rows need, so that no task
reads more than ``ROWS_PER_LOOKUP`` rows and one shard.

Defined results: a null text counts as empty. Of equal rows (same id, same text) one stays. A null id
is smaller than any other; a group that has only null ids keeps one row, with a null ``keep_id``. An
empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import only_once, shared_folder, stored, text_or_empty

KEYS_PER_SHARD = 4096
ROWS_PER_LOOKUP = 16384
#: Bits per key on each level; more bits mean fewer levels.
BITS_PER_KEY = 2.0

INDEX = """shard long, n_bits array<int>, bits array<binary>, digests binary,
    keep_ids array<long>, group_sizes array<long>"""
FOUND = "doc_id long, digest binary, copies long, keep_id long, group_size long, member boolean"


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``digest`` (32 bytes) of each row."""
    return docs.select("doc_id", F.unhex(F.sha2(text_or_empty(), 256)).alias("digest"))


def winners(rows: DataFrame, copies: str = "copies") -> DataFrame:
    """Each distinct digest with the largest id of its group and the group's size."""
    return rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.sum(copies).alias("group_size")
    )


def _shard(shards: int):
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return F.floor(first * shards / F.lit(1 << 32)).cast("long")


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each digest (four words), another one on each level."""
    with np.errstate(over="ignore"):
        h = np.full(len(words), (level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
        for k in range(4):
            h = (h ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        return h


def _words(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<u8").reshape(-1, 4)


def perfect_hash(words: np.ndarray) -> list[np.ndarray]:
    """The bit arrays of a minimal perfect hash over distinct digests."""
    levels, left = [], np.arange(len(words))
    while len(left):
        size = max(8, math.ceil(BITS_PER_KEY * len(left)))
        at = (_mixed(words[left], len(levels)) % np.uint64(size)).astype(np.int64)
        held = np.bincount(at, minlength=size)
        levels.append(held == 1)
        left = left[held[at] > 1]
    return levels


def slots_of(words: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot of each digest; -1 where no level has a bit for it, which only nonmembers get."""
    slots = np.full(len(words), -1, np.int64)
    left, before = np.arange(len(words)), 0
    for level, bits in enumerate(levels):
        at = (_mixed(words[left], level) % np.uint64(len(bits))).astype(np.int64)
        rank, hit = np.cumsum(bits) - 1 + before, bits[at]
        slots[left[hit]] = rank[at[hit]]
        left, before = left[~hit], before + int(bits.sum())
    return slots


def _built(group: pa.Table) -> pa.Table:
    words = _words(group["digest"].to_pylist())
    levels = perfect_hash(words)
    order = np.argsort(slots_of(words, levels))
    in_order = group.take(pa.array(order))
    return pa.table(
        {
            "shard": group["shard"][:1],
            "n_bits": pa.array([[len(b) for b in levels]], pa.list_(pa.int32())),
            "bits": pa.array([[np.packbits(b).tobytes() for b in levels]], pa.list_(pa.binary())),
            "digests": pa.array([words[order].tobytes()], pa.binary()),
            "keep_ids": pa.array([in_order["keep_id"].to_pylist()], pa.list_(pa.int64())),
            "group_sizes": pa.array([in_order["group_size"].to_pylist()], pa.list_(pa.int64())),
        }
    )


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard from the distinct digests of a history (see ``winners``)."""
    rows = history.select(_shard(shards).alias("shard"), "digest", "keep_id", "group_size")
    return rows.groupBy("shard").applyInArrow(_built, INDEX)


def _looked_up(rows: pa.Table, index: pa.Table) -> pa.Table:
    n = rows.num_rows
    keep, size, member = [None] * n, [None] * n, np.zeros(n, bool)
    if n and index.num_rows:
        shard = index.slice(0, 1).to_pylist()[0]
        levels = [
            np.unpackbits(np.frombuffer(b, np.uint8), count=k).astype(bool)
            for b, k in zip(shard["bits"], shard["n_bits"])
        ]
        words = _words(rows["digest"].to_pylist())
        slots = slots_of(words, levels)
        held = np.frombuffer(shard["digests"], dtype="<u8").reshape(-1, 4)
        member = (slots >= 0) & (held[np.maximum(slots, 0)] == words).all(axis=1)
        for i in np.flatnonzero(member):
            keep[i], size[i] = shard["keep_ids"][slots[i]], shard["group_sizes"][slots[i]]
    return pa.table(
        {
            "doc_id": rows["doc_id"],
            "digest": rows["digest"],
            "copies": rows["copies"],
            "keep_id": pa.array(keep, pa.int64()),
            "group_size": pa.array(size, pa.int64()),
            "member": pa.array(member),
        }
    )


def look_up(rows: DataFrame, index: DataFrame, shards: int, folder: str) -> DataFrame:
    """Each row (``doc_id``, ``digest``, ``copies``) with its winner in the history, if it has one."""
    rows = rows.withColumn("shard", _shard(shards))
    salts = stored(
        rows.groupBy("shard").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(ROWS_PER_LOOKUP)).alias("salts")
        ),
        folder,
        "salts",
    )
    dealt = rows.join(salts, "shard").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.col("salts"))
    )
    copies = index.join(salts, "shard").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    )
    return (
        dealt.drop("salts")
        .groupBy("shard", "salt")
        .cogroup(copies.drop("salts").groupBy("shard", "salt"))
        .applyInArrow(_looked_up, FOUND)
    )


def exact_duplicates(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, digest, member``.

    ``history`` is a table of earlier documents; a document whose text is in it is a repeat
    (``member``), gets the history's winner as ``keep_id`` and is not kept. Without a history the
    documents are their own: all are members, and each group keeps its largest id. ``group_size``
    counts the rows of the history for members, and the new rows of the group for nonmembers.
    """
    folder = shared_folder(docs.sparkSession)
    rows = stored(
        digests(docs).groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")),
        folder,
        "rows",
    )
    if history is None:
        known = winners(rows)
    else:
        known = winners(digests(history).withColumn("copies", F.lit(1).cast("long")))
    known = stored(known, folder, "history")
    shards = max(1, math.ceil(known.count() / KEYS_PER_SHARD))
    index = stored(build_index(known, shards), folder, "index")
    found = stored(look_up(rows, index, shards, folder), folder, "found")
    members, others = found.filter("member"), found.filter("not member")
    grouped = stored(winners(others), folder, "grouped")
    apart = (
        others.drop("keep_id", "group_size")
        .join(grouped, "digest")
        .select(*found.columns)
        .withColumn("stays", F.lit(True))
    )
    both = members.withColumn("stays", F.lit(history is None)).unionByName(apart)
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1) & F.col("stays")
    return both.select("*", copy).select(
        "doc_id", "keep_id", "group_size", wins.alias("kept"), "digest", "member"
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_duplicates(docs).filter("kept").select("doc_id", F.hex("digest").alias("_llm_digest"))
    marked = docs.withColumn("_llm_digest", F.upper(F.sha2(text_or_empty(), 256)))
    return only_once(marked, kept, ["doc_id", "_llm_digest"]).drop("_llm_digest")
