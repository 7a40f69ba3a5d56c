"""Near duplicates by b-bit MinHash: links at a Jaccard similarity of 0.85 or more, confirmed on full sets.

Sets: the words of a text (A-Z lower-cased) give its distinct shingles of five words, each as its 64-bit
XXH64; a text of fewer words has one shingle, all its words. Documents of equal sets are one node.

Sketch: ``HASHES`` permutations of the shingles give as many minima. Bands of ``ROWS`` whole minima
make buckets for candidates; with 32 bands of 4, a pair at the threshold meets in no bucket with
probability 6e-11. Then only the lowest ``BITS`` bits of each (mixed) minimum are kept, packed into longs.
Two signatures agree in a share s of their places; since unequal minima agree by chance in one of
2^BITS cases, similarity is estimated as (s - 2^-BITS) / (1 - 2^-BITS). The number of agreeing places is
counted by ``bit_count``. Pairs whose estimate is so low that a pair at the threshold would show it with
probability 1e-9 at most are dropped; all others are decided by their full sets.

Groups of near copies: first every set meets the smallest set of its buckets only, which joins much of a
large group with work in proportion to its size. Then only buckets that still hold different components
go on. Of their sets, a shingle that no other of them has can be shared with nobody, so a set with too
many such shingles is alone and leaves, and the others bound the similarity of a pair. What is left falls
into clusters (sets connected over buckets). A cluster is compared in tasks of one or two blocks, which hold
the full sets: the bounds and the estimate choose pairs of different components, the most typical sets
first, full sets decide, and a link joins the components at once, so that pairs inside a component are
skipped and a task returns fewer links than it has sets. No pair of candidates ever becomes a row, no
bucket is cut and none is gathered in one task.

Defined results: a text that is null or has no words has an empty set, linked with nothing, and is its
own component. Rows with equal ids or texts each give a row. ``component_id`` ignores null ids; it is null
if all ids of a component are, and such a document is not ``kept``. An empty table gives an empty result.
Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import shared_folder, stored
from pledgeline.llm.components import components

SHINGLE = 5
#: Link at this many hundredths of the union.
PERCENT = 85
BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS
BITS = 4
LONGS = HASHES * BITS // 64
#: Sets, and shingles of sets, in a block of a cluster.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21
#: Shingles permuted at once.
SLICE = 1 << 12

SIGNATURE = [f"s{k}" for k in range(LONGS)]
SKETCH = "key binary, n long, bands array<long>, " + ", ".join(f"{s} long" for s in SIGNATURE)

# each permutation of 32-bit values is x -> factor * x + shift
_SEEDS = np.array([xxhash.xxh64_intdigest(b"", k) for k in range(HASHES)], np.uint64)
_FACTORS = (_SEEDS >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = _SEEDS.astype(np.uint32)


def _least_agreement(lost: float = 1e-9) -> int:
    """The agreeing places below which a pair at the threshold falls with probability ``lost`` at most."""
    agree = PERCENT / 100 + (1 - PERCENT / 100) / 2**BITS
    below, places = 0.0, 0
    while True:
        below += comb(HASHES, places) * agree**places * (1 - agree) ** (HASHES - places)
        if below > lost:
            return places
        places += 1


LEAST_AGREEMENT = _least_agreement()
#: The same as a similarity, corrected for agreement by chance.
LEAST_ESTIMATE = (LEAST_AGREEMENT / HASHES - 2**-BITS) / (1 - 2**-BITS)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text in order."""
    words = (text or "").encode().lower().split()  # of bytes: only A-Z, only ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(size, len(words)) - 1
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist())
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b]) for a, b in spans], np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each permutation."""
    folded = (hashes ^ hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(folded), SLICE):
        block = folded[k : k + SLICE, None] * _FACTORS + _SHIFTS
        np.minimum(least, block.min(axis=0), out=least)
    return least


def bands_of(least: np.ndarray) -> np.ndarray:
    """One hash for each band of whole minima."""
    rows = least.reshape(-1, BANDS, ROWS).astype(np.uint64)
    value = np.zeros(rows.shape[:2], np.uint64)
    for k in range(ROWS):
        value = (value ^ rows[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The lowest bits of the mixed minima, ``LONGS`` longs for each row."""
    mixed = least.reshape(-1, HASHES).copy()
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        mixed ^= mixed >> np.uint32(shift)
        mixed *= np.uint32(factor)
    mixed ^= mixed >> np.uint32(16)
    places = (mixed & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, LONGS, 64 // BITS)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(places << shifts, axis=2).view(np.int64)


def _listed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _key(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _sketch(texts: list[str | None]) -> list[pa.Array]:
    sets = [shingles(t) for t in texts]
    lengths = np.array([len(s) for s in sets])
    least = np.array([minima(s) for s in sets]).reshape(-1, HASHES)
    signature = packed(least)
    return [
        pa.array([_key(s) for s in sets], pa.binary()),
        pa.array(lengths, pa.int64()),
        _listed(bands_of(least[lengths > 0]).ravel(), np.where(lengths > 0, BANDS, 0)),
        *[pa.array(signature[:, k]) for k in range(LONGS)],
    ]


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id`` and, of its set, ``key`` (null if empty), size, bands and packed signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                columns = _sketch(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SKETCH}"
    names = ["doc_id", "key", "n", "bands", *SIGNATURE]
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, least: DataFrame, needed: DataFrame) -> DataFrame:
    """``key`` and ``hashes`` of the keys that are needed.

    Only the document of the smallest id of each key (``least``) is read again; the sets of all documents
    would take twice the room of their texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                sets = [shingles(t) for t in batch.column(0).slice(k, 512).to_pylist()]
                values = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
                keys = pa.array([_key(s) for s in sets], pa.binary())
                hashes = _listed(values, np.array([len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([keys, hashes], ["key", "hashes"])

    carriers = least.join(needed.hint("merge"), "key", "left_semi").select("least").distinct()
    texts = docs.select("doc_id", "text")
    read = texts.join(
        carriers.hint("merge"), texts["doc_id"].eqNullSafe(carriers["least"]), "left_semi"
    ).select("text")
    sets = read.mapInArrow(run, "key binary, hashes array<long>").dropDuplicates(["key"])
    # equal or missing ids bring other documents along
    return sets.join(needed.hint("merge"), "key", "left_semi")


def agreement(left: list[Column], right: list[Column]) -> Column:
    """In how many places two packed signatures agree."""
    lowest = sum(1 << k for k in range(0, 64, BITS))
    differ = F.lit(0)
    for a, b in zip(left, right):
        bits = a.bitwiseXOR(b)
        for shift in (1 << k for k in range(BITS.bit_length() - 1)):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        differ = differ + F.bit_count(bits.bitwiseAND(F.lit(lowest).cast("long")))
    return HASHES - differ


def estimate(agreeing: Column) -> Column:
    """Similarity from agreeing places, corrected for agreement by chance."""
    return (agreeing / HASHES - 2**-BITS) / (1 - 2**-BITS)


def _alike(m: Column, n: Column) -> Column:
    """Sizes of sets that can be similar enough."""
    return 100 * F.least(m, n) >= PERCENT * F.greatest(m, n)


def _side(table: DataFrame, end: str, *columns: str) -> DataFrame:
    """A table keyed by ``src`` or ``dst``, its other columns with that prefix; never broadcast."""
    renamed = [F.col(c).alias(f"{end}_{c}") for c in columns]
    return table.select(F.col("key").alias(end), *renamed).hint("merge")


def probable(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The pairs whose estimated similarity is not too low."""
    columns = ["n", *SIGNATURE]
    both = pairs.join(_side(distinct, "src", *columns), "src").join(
        _side(distinct, "dst", *columns), "dst"
    )
    agreeing = agreement(*[[F.col(f"{end}_{s}") for s in SIGNATURE] for end in ("src", "dst")])
    passes = _alike(F.col("src_n"), F.col("dst_n")) & (estimate(agreeing) >= LEAST_ESTIMATE - 1e-9)
    return both.filter(passes).select("src", "dst")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    shared = F.size(F.array_intersect("src_hashes", "dst_hashes"))
    union = F.size("src_hashes") + F.size("dst_hashes") - shared
    return (
        pairs.join(_side(sets, "src", "hashes"), "src")
        .join(_side(sets, "dst", "hashes"), "dst")
        .filter(100 * shared >= PERCENT * union)
        .select("src", "dst")
    )


def _own_shingles(sets: DataFrame) -> DataFrame:
    """``key`` and ``own``: how many of a set's shingles no other set has, where there are any."""
    once = (
        sets.select("key", F.explode("hashes").alias("hash"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("held"), F.min("key").alias("key"))
        .filter("held = 1")
    )
    return once.groupBy("key").agg(F.count(F.lit(1)).alias("own"))


def _pairs_of(signs, sizes, shared, component, left, right) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the left and the right that may be similar, by bounds and estimate, in parts."""
    lowest = np.uint64(sum(1 << k for k in range(0, 64, BITS)))
    for k in range(0, len(left), 64):
        rows = left[k : k + 64]
        most = np.minimum(shared[rows, None], shared[None, right])
        union = sizes[rows, None] + sizes[None, right] - most
        a, b = np.nonzero(
            (100 * most >= PERCENT * union) & (component[rows, None] != component[None, right])
        )
        bits = signs[rows[a]] ^ signs[right[b]]
        for shift in (1 << j for j in range(BITS.bit_length() - 1)):
            bits |= bits >> np.uint64(shift)
        agreeing = HASHES - np.bitwise_count(bits & lowest).sum(axis=1, dtype=np.int64)
        good = agreeing >= LEAST_AGREEMENT
        yield rows[a[good]], right[b[good]]


def _linked(group: pa.Table) -> pa.Table:
    """Links between the components of the clusters in a group, from one block or between two."""
    # the sets that differ least from the others first: they join most
    order = pc.sort_indices(group.append_column("part_own", pc.divide(
        pc.cast(group["own"], pa.float64()), group["n"])), [("cluster", "ascending"), ("part_own", "ascending")])
    group = group.take(order).combine_chunks()
    signs = np.column_stack([group[s].to_numpy() for s in SIGNATURE]).view(np.uint64)
    sizes = group["n"].to_numpy()
    shared = sizes - group["own"].to_numpy()
    numbered = lambda c: np.unique(
        np.array(group[c].to_pylist(), object).astype("S16"), return_inverse=True
    )[1]
    cluster, component = numbered("cluster"), numbered("component")
    own, low, high = (group[c].to_numpy() for c in ("block", "low", "high"))
    hashes = group["hashes"].chunk(0)
    values, begins = hashes.values.to_numpy().view(np.uint64), hashes.offsets.to_numpy()
    parent = list(range(int(component.max(initial=-1)) + 1))

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    src, dst = [], []
    edges = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1], True])
    for begin, end in zip(edges[:-1], edges[1:]):
        rows = np.arange(begin, end)
        left, right = rows[own[rows] == low[rows]], rows[own[rows] == high[rows]]
        for some, others in _pairs_of(signs, sizes, shared, component, left, right):
            for i, j in zip(some.tolist(), others.tolist()):
                a, b = root(component[i]), root(component[j])
                if a == b:
                    continue
                one, other = values[begins[i] : begins[i + 1]], values[begins[j] : begins[j + 1]]
                both = len(np.intersect1d(one, other, assume_unique=True))
                if 100 * both >= PERCENT * (len(one) + len(other) - both):
                    parent[a] = b
                    src.append(i)
                    dst.append(j)
    at = lambda rows: group["key"].take(pa.array(rows, pa.int64())).combine_chunks()
    return pa.table({"src": at(src), "dst": at(dst)})


def _within_clusters(
    members: DataFrame, folder: str, block: int, block_shingles: int
) -> DataFrame:
    """Links between different components of each cluster; ``members`` holds the full sets."""
    held = stored(
        members.groupBy(F.col("cluster").alias("key"))
        .agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
        .select(
            "key",
            "shingles",
            F.greatest(
                F.ceil(F.col("sets") / F.lit(block)), F.ceil(F.col("shingles") / F.lit(block_shingles))
            )
            .cast("int")
            .alias("blocks"),
        ),
        folder,
        "clusters",
    )
    # clusters of one block share tasks of about a block
    small = held.filter("blocks = 1").agg(F.sum("shingles")).first()[0] or 0
    tasks = 1 + small // block_shingles
    sized = held.select(F.col("key").alias("cluster"), "blocks").hint("merge")
    alone = F.col("blocks") == 1
    return (
        members.join(sized, "cluster")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .withColumn("task", F.when(alone, F.pmod(F.xxhash64("cluster"), F.lit(tasks))))
        .withColumn("of", F.when(~alone, F.col("cluster")))
        .groupBy("task", "of", "low", "high")
        .applyInArrow(_linked, "src binary, dst binary")
    )


def links(
    distinct: DataFrame,
    docs: DataFrame,
    least: DataFrame,
    folder: str,
    block: int = BLOCK,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``src, dst``: links between distinct sets, enough to have the components of all links.

    ``distinct`` has the sketch of each set, ``least`` the smallest id of the documents that have it.
    """
    bucket = ["band", "value"]
    banded = distinct.select("key", F.posexplode("bands").alias(*bucket))
    shared = stored(
        banded.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("held"), F.min("key").alias("centre"))
        .filter("held > 1")
        .drop("held"),
        folder,
        "buckets",
    )
    met = stored(banded.join(shared.hint("merge"), bucket), folder, "met")
    # every set with the smallest of its buckets' centres that it is probably similar to
    stars = met.filter("key <> centre").select(F.col("centre").alias("src"), F.col("key").alias("dst"))
    nearest = stored(
        probable(stars.distinct(), distinct).groupBy("dst").agg(F.min("src").alias("src")),
        folder,
        "nearest",
    ).select("src", "dst")
    needed = nearest.select(F.explode(F.array("src", "dst")).alias("key")).distinct()
    sets = stored(full_sets(docs, least, needed), folder, "nearest-sets")
    first = stored(confirmed(nearest, sets), folder, "nearest-links")
    roots = components(first, folder, "stars").withColumnRenamed("node", "key")
    placed = stored(
        met.drop("centre")
        .join(roots.hint("merge"), "key", "left")
        .withColumn("component", F.coalesce("root", "key"))
        .drop("root"),
        folder,
        "placed",
    )
    # written first, so that hot buckets can be split
    unsettled = stored(_of_several(placed, bucket), folder, "buckets-of-several")
    going_on = stored(placed.join(unsettled.hint("merge"), bucket), folder, "unsettled")
    sets = stored(
        full_sets(docs, least, going_on.select("key").distinct()), folder, "unsettled-sets"
    )
    own = stored(_own_shingles(sets), folder, "own")
    measured = (
        sets.withColumn("n", F.size("hashes").cast("long"))
        .join(own.hint("merge"), "key", "left")
        .withColumn("own", F.coalesce("own", F.lit(0).cast("long")))
        .filter(100 * (F.col("n") - F.col("own")) >= PERCENT * F.col("n"))
    )
    measured = stored(measured, folder, "measured")
    # a bucket may be settled by what has left it
    going_on = going_on.join(measured.select("key").hint("merge"), "key", "left_semi")
    going_on = stored(going_on, folder, "left")
    unsettled = stored(
        _of_several(going_on, bucket, F.min("key").alias("centre")), folder, "open-buckets"
    )
    going_on = stored(going_on.join(unsettled.hint("merge"), bucket), folder, "open")
    edges = going_on.select(F.col("centre").alias("src"), F.col("key").alias("dst"))
    clusters = components(edges, folder, "clusters-of").select(
        F.col("node").alias("key"), F.col("root").alias("cluster")
    )
    members = (
        measured.join(clusters.hint("merge"), "key")
        .join(distinct.select("key", *SIGNATURE).hint("merge"), "key")
        .join(going_on.select("key", "component").distinct().hint("merge"), "key")
    )
    members = stored(members, folder, "members")
    second = stored(_within_clusters(members, folder, block, block_shingles), folder, "second")
    return first.union(second)


def _of_several(placed: DataFrame, bucket: list[str], *more: Column) -> DataFrame:
    """The buckets that hold different components, with more of their measures."""
    return (
        placed.groupBy(*bucket)
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), *more)
        .filter("low <> high")
        .drop("low", "high")
    )


def near_duplicates(
    docs: DataFrame, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id reachable over links, ``kept`` tells whether it is the own id.
    """
    folder = shared_folder(docs.sparkSession)
    sketched = stored(sketches(docs), folder, "sketches")
    filled = sketched.filter("key is not null")
    distinct = stored(
        filled.select("key", "n", "bands", *SIGNATURE).dropDuplicates(["key"]), folder, "distinct"
    )
    least = stored(filled.groupBy("key").agg(F.min("doc_id").alias("least")), folder, "least")
    roots = components(links(distinct, docs, least, folder, block, block_shingles), folder)
    rooted = stored(
        least.join(roots.withColumnRenamed("node", "key").hint("merge"), "key", "left").select(
            "key", "least", F.coalesce("root", "key").alias("root")
        ),
        folder,
        "rooted",
    )
    smallest = stored(
        rooted.groupBy("root").agg(F.min("least").alias("component_id")), folder, "smallest"
    )
    classes = stored(
        rooted.join(smallest.hint("merge"), "root").select("key", "component_id"), folder, "classes"
    )
    found = sketched.filter("key is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    found = found.unionByName(
        filled.select("key", "doc_id", "n")
        .join(classes.hint("merge"), "key")
        .select("doc_id", "n", "component_id")
    )
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
