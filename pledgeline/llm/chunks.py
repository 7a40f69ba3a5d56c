"""Texts too long for one task step, as overlapping chunks that are spliced again without loss.

A chunk starts at a multiple of the chunk length and reads some characters into the next one. Where
tokens begin is decided from left to right, so two chunks that both begin a pre-token at the same
place agree on everything after it, as far as both see the same text. Each chunk therefore reports
the pre-token starts in its first overlap (``heads``) and in the overlap it shares with the next chunk
(``tails``, without a margin at its end, where the cut may still change a decision). The smallest
common one is the splice: the earlier chunk owns what lies before it and the later one the rest.

Texts are only cut in the task that holds them; their chunks are dealt to all tasks, one row each, and
read there. Neighbouring chunks meet by joins on their numbers, which carry heads and tails and no text,
so nothing gathers a text's chunks again.

Texts where some pair of chunks has no common start (one pre-token longer than the overlap) are cut
again with an overlap ``WIDEN`` times as wide, until nothing fails; in the end one chunk holds the
whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import stored

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
WIDEN = 8

#: A chunk: which text it is of (id and digest), its place, its characters.
PIECE = """of struct<doc_id: long, digest: string>, copies long, k long, start long, n_chars long,
    n_bytes long, piece string"""
#: What reading makes of it, before its own column.
READ = """of struct<doc_id: long, digest: string>, copies long, k long, start long, n_chars long,
    n_bytes long, heads array<long>, tails array<long>"""
_OF = pa.struct([("doc_id", pa.int64()), ("digest", pa.string())])

#: From the text of a chunk: the starts of its pre-tokens (within the chunk) and its own column.
Reader = Callable[[str], tuple[list[int], object]]


def long_texts(docs: DataFrame, chunk_chars: int) -> DataFrame:
    """Distinct (id, text) of the texts that need more than one chunk; ``copies`` counts rows."""
    return (
        docs.select("doc_id", "text")
        .filter(F.length("text") > chunk_chars)
        .groupBy("doc_id", "text")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("digest", F.sha2("text", 256))
    )


def pieces(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The chunks of all texts (see ``long_texts``), dealt to tasks of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc_id, text, copies, digest = (c[row].as_py() for c in batch.columns)
                n, n_bytes = len(text), len(text.encode())
                for k, start in enumerate(range(0, n, chunk)):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "of": pa.array([(doc_id, digest)], _OF),
                            **{
                                name: pa.array([value], pa.int64())
                                for name, value in (
                                    ("copies", copies),
                                    ("k", k),
                                    ("start", start),
                                    ("n_chars", n),
                                    ("n_bytes", n_bytes),
                                )
                            },
                            "piece": [text[start : start + chunk + overlap]],
                        }
                    )

    # of a fixed number, so that the chunks of one text are not put together again for being small
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.select("doc_id", "text", "copies", "digest").mapInArrow(run, PIECE)
    return rows.repartition(tasks, "of", "k")


def _read(reader: Callable[[], Reader], kind: str, chunk: int, overlap: int, margin: int):
    """Function for mapInArrow: what ``reader()`` finds in each chunk."""
    value_type = {"string": pa.string(), "array<long>": pa.list_(pa.int64())}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader()
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                start, n, piece = (row.column(c)[0].as_py() for c in ("start", "n_chars", "piece"))
                starts, value = read(piece)
                seen = n - start if start + len(piece) == n else len(piece) - margin
                heads = [start + s for s in starts if s <= overlap] if start else []
                tails = [start + s for s in starts if chunk <= s <= min(seen, chunk + overlap)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *row.columns[:-1],
                        pa.array([heads], pa.list_(pa.int64())),
                        pa.array([tails], pa.list_(pa.int64())),
                        pa.array([value], value_type),
                    ],
                    [*row.schema.names[:-1], "heads", "tails", "value"],
                )

    return run


def spliced(
    texts: DataFrame,
    reader: Callable[[], Reader],
    kind: str,
    margin: int,
    folder: str,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Chunks of ``texts`` (see ``long_texts``) with the span ``[begin, until)`` that each one owns.

    ``reader`` builds the reading function once per task; its second result is the column ``value``,
    of the Spark type ``kind``. ``margin`` is how many characters a decision may look ahead.
    """
    result, todo, attempt = None, texts, 0
    while True:
        rows = pieces(todo, chunk_chars, overlap_chars).mapInArrow(
            _read(reader, kind, chunk_chars, overlap_chars, margin), f"{READ}, value {kind}"
        )
        read = stored(rows, folder, f"chunks-{attempt}")
        ends = read.select("of", (F.col("k") + 1).alias("k"), F.col("tails").alias("_tails"))
        common = F.array_min(F.array_intersect("_tails", "heads"))
        begins = stored(
            read.select("of", "k", "heads")
            .join(ends.hint("merge"), ["of", "k"], "left")
            .select("of", "k", F.when(F.col("k") == 0, F.lit(0)).otherwise(common).alias("begin")),
            folder,
            f"splices-{attempt}",
        )
        failed = stored(
            begins.filter("begin is null").select("of").distinct(), folder, f"failed-{attempt}"
        )
        until = begins.select("of", (F.col("k") - 1).alias("k"), F.col("begin").alias("until"))
        good = (
            read.drop("heads", "tails")
            .join(begins.hint("merge"), ["of", "k"])
            .join(until.hint("merge"), ["of", "k"], "left")
            .withColumn("until", F.coalesce("until", "n_chars"))
            .join(failed.hint("merge"), "of", "left_anti")
            .select("of.*", "*")
            .drop("of")
        )
        result = good if result is None else result.unionByName(good)
        if failed.isEmpty():
            return result
        again = failed.select(F.col("of.digest").alias("digest"), F.col("of.doc_id").alias("_doc_id"))
        todo = texts.join(
            again.hint("merge").withColumnRenamed("digest", "_digest"),
            F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest")),
            "left_semi",
        )
        attempt, overlap_chars = attempt + 1, overlap_chars * WIDEN
        chunk_chars = max(chunk_chars, overlap_chars)
