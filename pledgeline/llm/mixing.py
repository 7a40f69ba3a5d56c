"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Targets: the sources, in code point order, share ``SHARE`` times all words by their weights; a source
gives at most ``MAX_PASSES`` times its size, and what it cannot give is shared anew by weight among the
others. That ends at one level: every target is the smaller of the cap and level times weight.

Blocks: each source's documents, shuffled by a hash of id and text, form one stream of words, cut into
blocks of ``BLOCK_WORDS`` words. Schedule: draw n of the mix has the point frac(n * golden ratio), which
lies in the share of one source on the cumulative targets; any run of draws holds each source about in
proportion. A source's draws are ranked, and the draw of rank r takes block r of its stream, from the
start again after the last, until the target is reached; the last one takes part of a block. Where the
points leave a source short, the missing slots are spread evenly between the draws, so that every target
is met to the word. Draw n has slot 2n, added slots have odd numbers.

All steps are DataFrame operations. A source may hold any share of the rows: its documents are cut
into runs by the leading digits of the hash, running sums go over runs first and then inside each, and
slots are ranked the same way. Equal rows (same id, source and text) go through all that as one row with
their number. Windows over whole sources see one row per run, and the single window over all sources one
row per source. Tables that grow with the documents are joined by sorting, never broadcast.

Defined results: a null text has no words. A null source is a source, the last one. Documents without
words, or of an empty table, are taken zero times. Rows are known by id (null or not), source and SHA-256
of the text, so equal ids of different texts keep apart. The order is that of the MD5 of id and that
digest, so reruns agree. Columns other than ``doc_id``, ``text`` and ``source`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgeline.llm.common import WORD, shared_folder, stored, text_or_empty

# Fixed values of the contract: weights of the sources in turn, the share of all words, the cap.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_PASSES = 2

BLOCK_WORDS = 1024
#: Documents of one source that one task orders, and slots that one task ranks, on average.
RUN_DOCS = 2048
RUN_SLOTS = 4096
#: Cells into which the cumulative targets are cut to find the source of a point.
CELLS = 1024
#: Fraction of the golden ratio, to 25 digits.
GOLDEN = "0.6180339887498948482045868"


def _digest() -> Column:
    """The SHA-256 of the text; empty for a null one."""
    return F.coalesce(F.sha2("text", 256), F.lit(""))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``digest``, ``size`` (the number of words) and how many ``copies``."""
    return (
        docs.select(
            "doc_id",
            "source",
            _digest().alias("digest"),
            F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        )
        .groupBy("doc_id", "source", "digest", "size")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _source_order() -> list[Column]:
    return [F.col("source").asc_nulls_last()]


def targets(measured: DataFrame) -> DataFrame:
    """Per source: ``source_size``, ``docs``, ``weight``, ``target``, and its ``low``..``high`` share."""
    per_source = measured.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    # one row per source: the only windows without a partition key
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(*_source_order())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]), F.pmod(place, F.lit(len(WEIGHTS))) + 1
    )
    cap = MAX_PASSES * F.col("source_size").cast("double")
    # sources in the order in which a rising level fills them
    filled = everything.orderBy(F.col("cap") / F.col("weight"), "place")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    spread = (
        per_source.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("all_words", SHARE * F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("all_words") - F.col("capped")) / F.sum("weight").over(rest))
        # the level rises with every source that it fills and falls with every one it wouldn't
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
    )
    in_order = everything.orderBy("place")
    total = F.sum("target").over(everything)
    running = F.sum("target").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        spread.withColumn("high", F.coalesce(F.try_divide(running, total), F.lit(0.0)))
        .withColumn("low", F.lag("high", 1, 0.0).over(in_order))
        .select("source", "source_size", "docs", "weight", "target", "low", "high")
    )


def _hashed() -> Column:
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "digest"))


def _ahead(words: str) -> Column:
    """The sum over the earlier runs of a source."""
    earlier = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(words).over(earlier), F.lit(0))


def streams(measured: DataFrame, per_source: DataFrame, folder: str) -> DataFrame:
    """A row per document with ``begin``, the words before it in its source's shuffled stream."""
    s = per_source.select(F.col("source").alias("_source"), F.col("docs").alias("_docs"))
    head = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long")
    runs = F.ceil(F.col("_docs") / F.lit(RUN_DOCS))
    dealt = stored(
        measured.join(s, measured["source"].eqNullSafe(s["_source"]))
        .withColumn("_hash", _hashed())
        .withColumn("run", F.floor(head * runs / F.lit(1 << 32)).cast("long"))
        .select("doc_id", "source", "digest", "size", "copies", "_hash", "run"),
        folder,
        "dealt",
    )
    words = F.col("size") * F.col("copies")
    # as one struct the keys are never null, and the window's exchange serves the join
    place = F.struct("source", "run").alias("_run")
    offsets = stored(
        dealt.groupBy("source", "run")
        .agg(F.sum(words).alias("words"))
        .select(place, _ahead("words").alias("_offset")),
        folder,
        "offsets",
    )
    inside = (
        Window.partitionBy("_run")
        .orderBy("_hash", "doc_id", "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("_copy")
    return (
        dealt.select("*", place)
        .withColumn("_inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
        .join(offsets.hint("merge"), "_run")
        .select("*", copy)
        .select(
            "doc_id",
            "source",
            "digest",
            "size",
            (F.col("_offset") + F.col("_inside") + F.col("_copy") * F.col("size")).alias("begin"),
        )
    )


def schedule(per_source: DataFrame, folder: str) -> DataFrame:
    """The slots of the mix: ``slot``, ``source``, ``rank``, ``pass``, ``block``, ``words``.

    ``pass`` is how often the source was gone through before, ``words`` how many words of the block the
    slot takes, from the block's start.
    """
    spark = per_source.sparkSession
    size, target = F.col("source_size"), F.least(
        F.round("target").cast("long"), MAX_PASSES * F.col("source_size")
    )
    blocks = F.ceil(size / F.lit(BLOCK_WORDS)).cast("long")
    quota = stored(
        per_source.filter("source_size > 0")
        .withColumn("target", target)
        .withColumn("blocks", blocks)
        .withColumn("passes", F.floor(F.col("target") / size).cast("long"))
        .withColumn(
            "slots",
            F.col("passes") * F.col("blocks")
            + F.ceil((F.col("target") - F.col("passes") * size) / F.lit(BLOCK_WORDS)).cast("long"),
        ),
        folder,
        "quota",
    )
    points = int(quota.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0])
    cells = quota.select(
        F.col("source").alias("source"),
        "low",
        "high",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * CELLS).cast("long"), F.floor(F.col("high") * CELLS).cast("long")
            )
        ).alias("cell"),
    )
    golden = F.lit(GOLDEN).cast("decimal(25,25)")
    product = F.col("id").cast("decimal(13,0)") * golden
    point = (product - F.floor(product)).cast("double")
    drawn = (
        spark.range(1, points + 1)
        .select(F.col("id").alias("slot"), point.alias("point"))
        .withColumn("cell", F.floor(F.col("point") * CELLS).cast("long"))
        .join(cells, "cell")
        .filter((F.col("low") <= F.col("point")) & (F.col("point") < F.col("high")))
        .select((2 * F.col("slot")).alias("slot"), "source")
    )
    drawn = stored(drawn, folder, "drawn")
    drawn_of = drawn.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_held"))
    missing = F.col("slots") - F.col("_held")
    added = (
        quota.join(drawn_of, quota["source"].eqNullSafe(drawn_of["_source"]), "left")
        .withColumn("_held", F.coalesce("_held", F.lit(0)))
        .filter("_held < slots")
        .select("source", missing.alias("_missing"), F.explode(F.sequence(F.lit(1), missing)).alias("_k"))
        # evenly between the draws
        .select(
            (F.expr(f"((2 * _k - 1) * {points}L) div (2 * _missing)") * 2 + 1).alias("slot"), "source"
        )
    )
    run = F.floor(F.col("slot") / (2 * RUN_SLOTS)).cast("long").alias("run")
    both = stored(drawn.unionByName(added).select("*", run), folder, "slots")
    place = F.struct("source", "run").alias("_run")
    before = stored(
        both.groupBy("source", "run")
        .agg(F.count(F.lit(1)).alias("held"))
        .select(place, _ahead("held").alias("_before")),
        folder,
        "runs",
    )
    within = Window.partitionBy("_run").orderBy("slot")
    slots = (
        both.select("*", place)
        .withColumn("_number", F.row_number().over(within) - 1)
        .join(before.hint("merge"), "_run")
        .select("slot", "source", (F.col("_before") + F.col("_number")).alias("rank"))
    )
    q = quota.select(
        F.col("source").alias("_source"), "source_size", "target", "blocks", "slots"
    )
    position = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + (
        F.col("block") * BLOCK_WORDS
    )
    held = F.least(F.lit(BLOCK_WORDS), F.col("source_size") - F.col("block") * BLOCK_WORDS)
    return (
        slots.join(q, slots["source"].eqNullSafe(q["_source"]))
        .filter("rank < slots")
        .withColumn("block", F.pmod("rank", "blocks"))
        .withColumn("pass", F.floor(F.col("rank") / F.col("blocks")).cast("long"))
        .withColumn("words", F.least(held, F.col("target") - position).cast("long"))
        .filter("words > 0")
        .select("slot", "source", "rank", "pass", "block", "words")
    )


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: what the mix takes of it, and where.

    ``doc_id, source, digest, size, begin`` (the words before it in its source's stream), ``source_size,
    target, taken`` (how many of its words the mix takes, counted as often as it takes them), ``first_slot``
    and ``last_slot`` (null if it takes none) and ``slots``, the first slot of each pass that takes it.
    """
    folder = shared_folder(docs.sparkSession)
    measured = stored(sizes(docs), folder, "sizes")
    per_source = stored(targets(measured), folder, "targets")
    stream = stored(streams(measured, per_source, folder), folder, "streams")
    slots = stored(schedule(per_source, folder), folder, "schedule")
    at_block = F.struct("source", "block").alias("_block")
    end = F.col("begin") + F.col("size")
    pieces = stream.filter("size > 0").select(
        "source",
        "begin",
        end.alias("_end"),
        F.explode(
            F.sequence(
                F.floor(F.col("begin") / BLOCK_WORDS).cast("long"),
                F.floor((end - 1) / BLOCK_WORDS).cast("long"),
            )
        ).alias("block"),
    )
    at = F.col("block") * BLOCK_WORDS
    shared = F.least(F.col("_end"), at + F.col("words")) - F.greatest(F.col("begin"), at)
    passes = [
        F.min(F.when(F.col("pass") == k, F.col("slot"))).alias(f"_slot_{k}") for k in range(MAX_PASSES)
    ]
    # a place in a stream is the place of one document that has words
    taken = (
        pieces.select("*", at_block)
        .join(slots.select("slot", "pass", "words", at_block).hint("merge"), "_block")
        .withColumn("_shared", shared)
        .filter("_shared > 0")
        .groupBy("source", "begin")
        .agg(
            F.sum("_shared").alias("taken"),
            F.min("slot").alias("first_slot"),
            F.max("slot").alias("last_slot"),
            *passes,
        )
        .select(F.struct("source", "begin").alias("_at"), "*")
        .drop("source", "begin")
    )
    at_word = F.when(F.col("size") > 0, F.struct("source", "begin")).alias("_at")
    s = per_source.select(F.col("source").alias("_of"), "source_size", "target")
    return (
        stream.select("*", at_word)
        .join(taken.hint("merge"), "_at", "left")
        .join(s, stream["source"].eqNullSafe(s["_of"]))
        .select(
            "doc_id",
            "source",
            "digest",
            "size",
            "begin",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            "first_slot",
            "last_slot",
            F.array(*[f"_slot_{k}" for k in range(MAX_PASSES)]).alias("slots"),
        )
    )


def taken_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents, with all their columns: each as often as the mix takes it, in slot order.

    A document that the end of a target cuts counts by the nearest whole number, so a source's words
    differ from its target by half a document at most. Of rows that are equal in id, source and text,
    one (the least by its other columns) stands for all, as often as the mix takes them together.
    """
    times = F.coalesce(F.round(F.try_divide("taken", "size")), F.lit(0)).cast("int")
    key = F.struct("doc_id", "source", "digest").alias("_llm_key")
    # a pass that takes less than half of a document comes last
    takes = (
        mix(docs)
        .filter("taken > 0")
        .select(key, "source", "begin", F.explode(F.slice("slots", 1, times)).alias("_llm_slot"))
        .select("_llm_key", "_llm_slot", F.col("source").alias("_llm_of"), F.col("begin").alias("_llm_begin"))
    )
    takes = stored(takes, shared_folder(docs.sparkSession), "takes")
    marked = docs.withColumn(
        "_llm_key", F.struct("doc_id", "source", _digest().alias("digest"))
    )
    unordered = ("map<", "variant")
    orderable = [
        f.name for f in docs.schema.fields if not any(u in f.dataType.simpleString() for u in unordered)
    ]
    least = Window.partitionBy("_llm_key").orderBy(*orderable)
    in_order = ["_llm_slot", "_llm_of", "_llm_begin"]
    return (
        marked.withColumn("_llm_place", F.row_number().over(least))
        .filter("_llm_place = 1")
        .join(takes.hint("merge"), "_llm_key")
        .repartitionByRange(*in_order)
        .sortWithinPartitions(*in_order)
        .select(*docs.columns)
    )
