"""Repeated passages, by seeds that are extended both ways.

Seeds: among the seeds (runs of ``SEED`` words) of a window, the one with the least hash, the first of
equal ones, is the window's anchor. Equal windows have the same anchor at the same place, so a repeat
of a whole window is always met at an anchor. The windows that share an anchor are consecutive, and
the words they cover are the anchor's stretch: what the anchor can be extended to, to the left and
right, before another anchor takes over.

Extend: documents are joined on anchors that occur more than once. Where a whole stretch is found
again, all its windows are repeats: within a long repeat these extensions run on from anchor to
anchor. At the ends of a repeat, stretches differ, and the extension goes word by word: one
representative of each distinct stretch of the anchor lists its windows, and equal ones are repeats.
The union of the repeated windows of a document is its maximal repeats.

An anchor that occurs n times makes n rows and at most one list of windows per distinct stretch,
never a row per pair. Joins are between written tables, so that adaptive execution splits hot anchors.

A hash of 64 bits finds candidates only among equal anchors; windows are compared by 128 bits.

Defined results: words are runs of characters other than ``\\x20\\x09-\\x0D``. A null text has none. Rows
with equal texts repeat each other, also if their ids are equal or null. Texts shorter than a window
keep all words. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import shared_folder, stored, text_or_empty

WINDOW = 35
SEED = 8
#: Documents in one batch that a task hands back.
BATCH = 128

#: A row is known by its id and this hash of its text, as ids may be null or occur twice.
KEY = ["doc_id", "text_hash"]
ANCHORS = "doc_id long, text_hash long, anchor long, stretch long, first int, last int"
WINDOWS = "doc_id long, text_hash long, at int, w1 long, w2 long"
KEPT = "doc_id long, n_words long, n_removed long, spans array<struct<begin:int,until:int>>, kept string"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Rolling:
    """Hashes of runs of words, each from two prefix sums (arithmetic modulo 2^64)."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        steps = np.full(n, base, np.uint64)
        steps[:1] = 1
        back = np.full(n, pow(base, -1, 1 << 64), np.uint64)
        back[:1] = 1
        self.back = np.cumprod(back)
        self.sums = np.concatenate(
            (np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(steps), dtype=np.uint64))
        )

    def runs(self, begin: np.ndarray, until: np.ndarray) -> np.ndarray:
        return _mix((self.sums[until] - self.sums[begin]) * self.back[begin])


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def anchors_of(hashes: np.ndarray, window: int, seed: int):
    """Anchor hash, stretch hash, first and last window of each anchor of a text."""
    n = len(hashes) - window + 1
    if n < 1:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    rolling = _Rolling(hashes, 0x9E3779B97F4A7C15)
    at = np.arange(len(hashes) - seed + 1)
    seeds = rolling.runs(at, at + seed)
    least = np.lib.stride_tricks.sliding_window_view(seeds, window - seed + 1).argmin(axis=1)
    where = at[:n] + least
    first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    place = where[first]
    stretch = rolling.runs(first, last + window)
    shape = ((place - first) * window + (last - first)).astype(np.uint64)
    return seeds[place], _mix(stretch + shape), first, last


def windows_of(hashes: np.ndarray, begin: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of the windows that begin at the given words."""
    one = _Rolling(hashes, 0x9E3779B97F4A7C15).runs(begin, begin + window)
    two = _Rolling(_mix(hashes + np.uint64(1)), 0xD1342543DE82EF95).runs(begin, begin + window)
    return one, two


def _anchors(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                found = [
                    anchors_of(_word_hashes(text.encode().split()), window, seed)
                    for text in part.column(2).to_pylist()
                ]
                rows = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                columns = [np.concatenate([f[k] for f in found]) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)),
                        part.column(1).take(pa.array(rows)),
                        pa.array(columns[0].view(np.int64)),
                        pa.array(columns[1].view(np.int64)),
                        pa.array(columns[2].astype(np.int32)),
                        pa.array(columns[3].astype(np.int32)),
                    ],
                    ["doc_id", "text_hash", "anchor", "stretch", "first", "last"],
                )

    return run


def _pairs(column: pa.ListArray, one: str, two: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two integer fields of each list of structs; empty for null lists."""
    result = []
    for row in column:
        held = row.values
        if held is None:
            result.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
        else:
            fields = [held.field(name).to_numpy(zero_copy_only=False) for name in (one, two)]
            result.append((fields[0].astype(np.int64), fields[1].astype(np.int64)))
    return result


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                begins, ones, twos = [], [], []
                ranges = _pairs(part.column(3), "first", "last")
                for text, (first, last) in zip(part.column(2), ranges):
                    held = last - first + 1
                    begin = np.repeat(first - np.cumsum(held) + held, held) + np.arange(held.sum())
                    one, two = windows_of(_word_hashes(text.as_py().encode().split()), begin, window)
                    begins.append(begin)
                    ones.append(one)
                    twos.append(two)
                rows = pa.array(np.repeat(np.arange(len(begins)), [len(b) for b in begins]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(rows),
                        part.column(1).take(rows),
                        pa.array(np.concatenate(begins).astype(np.int32)),
                        pa.array(np.concatenate(ones).view(np.int64)),
                        pa.array(np.concatenate(twos).view(np.int64)),
                    ],
                    ["doc_id", "text_hash", "at", "w1", "w2"],
                )

    return run


def _covered(n: int, begin: np.ndarray, until: np.ndarray) -> np.ndarray:
    steps = np.bincount(begin, minlength=n + 1) - np.bincount(until, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            rows = []
            spans = _pairs(part.column(2), "begin", "until")
            for doc_id, text, (begin, until) in zip(part.column(0), part.column(1), spans):
                words = text.as_py().encode().split()
                gone = _covered(len(words), begin, until)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                rows.append(
                    {
                        "doc_id": doc_id.as_py(),
                        "n_words": len(words),
                        "n_removed": len(words) - len(kept),
                        "spans": [
                            {"begin": b, "until": u}
                            for b, u in zip(edges[::2].tolist(), edges[1::2].tolist())
                        ],
                        "kept": b" ".join(kept).decode(),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, _KEPT_ARROW)


_KEPT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("until", pa.int32())]))),
        ("kept", pa.string()),
    ]
)


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _same_row(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["_doc_id"]) & (left["text_hash"] == right["_text_hash"])


def repeated_spans(
    docs: DataFrame, folder: str, window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """``doc_id, text_hash, begin, until``: runs of words whose every window occurs elsewhere too."""
    texts = _keyed(docs)
    anchors = stored(
        texts.mapInArrow(_anchors(window, seed), ANCHORS), folder, "anchors"
    )
    recurring = stored(
        anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"),
        folder,
        "recurring",
    )
    met = stored(anchors.join(recurring, "anchor"), folder, "met")
    # any occurrence may stand for its stretch
    stretches = stored(
        met.groupBy("anchor", "stretch").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.first(c).alias(c) for c in (*KEY, "first", "last")],
        ),
        folder,
        "stretches",
    )
    whole = stored(
        stretches.filter("n > 1").select("anchor", "stretch"), folder, "whole"
    )
    runs = met.join(whole, ["anchor", "stretch"], "left_semi").select(
        *KEY, F.col("first").alias("begin"), (F.col("last") + window).alias("until")
    )
    several = stored(
        stretches.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("anchor"),
        folder,
        "several",
    )
    lists = (
        stretches.join(several, "anchor")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
        .select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"), "ranges")
    )
    listed = stored(
        texts.join(lists.hint("shuffle_hash"), _same_row(texts, lists))
        .select(*KEY, "text", "ranges")
        .mapInArrow(_windows(window), WINDOWS),
        folder,
        "windows",
    )
    equal = stored(
        listed.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2"),
        folder,
        "equal",
    )
    ends = listed.join(equal, ["w1", "w2"], "left_semi").select(
        *KEY, F.col("at").alias("begin"), (F.col("at") + window).alias("until")
    )
    return runs.union(ends)


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, spans, kept``.

    ``spans`` are the maximal repeats (in words, end excluded), ``kept`` the other words, joined by
    one space.
    """
    folder = shared_folder(docs.sparkSession)
    spans = stored(
        repeated_spans(docs, folder, window, seed)
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("begin", "until")).alias("spans"))
        .select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"), "spans"),
        folder,
        "spans",
    )
    texts = _keyed(docs)
    return (
        texts.join(spans.hint("shuffle_hash"), _same_row(texts, spans), "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_kept, KEPT)
    )
