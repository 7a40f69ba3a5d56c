import hashlib
import random

import pytest
import xxhash
from llm_cases import bag, documents, no_documents, roots, rows, words_of

from pledgeline.llm import simhash
from pledgeline.llm.common import shared_folder
from pledgeline.llm.components import components


def naive(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = words_of(lower)
    if not words:
        return 0
    runs = [words[k : k + 3] for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(table):
    prints = [naive(r[1]) for r in table]
    nodes = sorted(set(prints))
    near = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3]
    root = roots(nodes, near)
    least = {}
    for row, fp in zip(table, prints):
        if row[0] is not None:
            least[root[fp]] = min(row[0], least.get(root[fp], row[0]))
    return bag((row[0], fp, least.get(root[fp])) for row, fp in zip(table, prints))


@pytest.mark.parametrize("max_bucket", [256, 1])
def test_against_all_pairs(spark, max_bucket):
    got = simhash.near_duplicates(documents(spark), max_bucket=max_bucket).collect()
    assert bag((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == expected(rows())


@pytest.mark.parametrize("max_bucket", [256, 2])
def test_links_of_dense_and_sparse_fingerprints(spark, max_bucket):
    draw = random.Random(3)
    seeds = [draw.getrandbits(64) for _ in range(12)]
    prints = {simhash._signed(s) for s in seeds}
    for s in seeds:
        for _ in range(25):
            flips = sum(1 << b for b in draw.sample(range(64), draw.randint(1, 5)))
            prints.add(simhash._signed(s ^ flips))
    folder = shared_folder(spark)
    distinct = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.links(distinct, folder, max_bucket=max_bucket)
    got = {tuple(r) for r in links.collect()}
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 3 for a, b in got)
    near = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3]
    assert roots(prints, got) == roots(prints, near)


def test_masks_cover_every_pair_within_the_radius():
    draw = random.Random(5)
    masks = simhash.covering_masks()
    assert len(masks) == 15
    for _ in range(3000):
        differing = sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3)))
        assert any(differing & m % (1 << 64) == 0 for m in masks)


def test_empty_and_kept(spark):
    assert simhash.near_duplicates(no_documents(spark)).count() == 0
    kept = simhash.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    # of each component the smallest id, by id and text: an id may stay for two components
    table = rows()
    prints = [naive(r[1]) for r in table]
    nodes = sorted(set(prints))
    near = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3]
    root, best = roots(nodes, near), {}
    for row, fp in zip(table, prints):
        digest = b"" if row[1] is None else hashlib.sha256(row[1].encode()).digest()
        rank = (row[0] is None, row[0] or 0, digest)
        best[root[fp]] = min(best.get(root[fp], (rank, row)), (rank, row), key=lambda r: r[0])
    expect = bag((row[0], row[1]) for _, row in best.values())
    assert bag((r.doc_id, r.text) for r in kept.collect()) == expect


def test_one_of_each_component_whatever_its_ids(spark):
    draw = random.Random(11)
    a, b, c, d, e, f = (" ".join(f"w{draw.randrange(9999)}" for _ in range(400)) for _ in range(6))
    near_b, near_c = b + " end", c + " end"
    assert [(naive(x) ^ naive(y)).bit_count() <= 3 for x, y in ((b, near_b), (c, near_c))] == [True, True]
    table = [
        # unrelated texts without an id, one of them twice
        *[(None, a), (None, d), (None, d)],
        # one id with three unrelated texts, of which one is a near copy
        *[(5, e), (5, f), (5, near_b), (3, b)],
        # near copies with and without an id, or with the same id
        *[(None, near_b), (9, c), (9, near_c), (None, None), (None, "")],
    ]
    least_c = min(c, near_c, key=lambda text: hashlib.sha256(text.encode()).digest())
    expect = bag([(None, a), (None, d), (5, e), (5, f), (3, b), (9, least_c), (None, None)])
    docs = spark.createDataFrame(table, "doc_id long, text string")
    for parts in (1, 3):
        assert bag(simhash.one_of_each(docs.repartition(parts)).collect()) == expect


def test_components(spark):
    draw = random.Random(1)
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 240)]
    mixed = [(draw.randrange(300, 400), draw.randrange(300, 400)) for _ in range(60)]
    edges = [*path, *star, *mixed, (5, 5), (None, 3), *path[:4]]
    df = spark.createDataFrame(edges, "src long, dst long").repartition(4)
    got = {r.node: r.root for r in components(df, shared_folder(spark)).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == roots({n for e in real for n in e}, real)
