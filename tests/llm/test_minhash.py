import random

import numpy as np
import pytest
from llm_cases import bag, documents, no_documents, roots, rows, words_of

from pledgeline.llm import minhash


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = words_of(lower)
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def expected(table):
    """By all pairs of distinct sets; nodes are places in the list of them."""
    sets = [frozenset(shingles(r[1])) for r in table]
    distinct = sorted({s for s in sets if s}, key=sorted)
    near = []
    for i, a in enumerate(distinct):
        for j in range(i):
            both = len(a & distinct[j])
            if 100 * both >= 85 * (len(a) + len(distinct[j]) - both):
                near.append((j, i))
    root = roots(range(len(distinct)), near)
    at = {s: root[i] for i, s in enumerate(distinct)}
    least = {}
    for row, s in zip(table, sets):
        if s and row[0] is not None:
            least[at[s]] = min(row[0], least.get(at[s], row[0]))
    component = [least.get(at[s]) if s else row[0] for row, s in zip(table, sets)]
    return bag(
        (row[0], len(s), c, row[0] is not None and row[0] == c)
        for row, s, c in zip(table, sets, component)
    )


def families():
    """Chains and stars of near copies around the threshold, and texts that share a long passage."""
    draw = random.Random(2)
    word = lambda: f"w{draw.randrange(5000)}"
    table = []
    for family in range(6):
        text = [word() for _ in range(draw.choice([6, 12, 80, 150, 300]))]
        for _ in range(30):
            table.append(" ".join(text))
            text = list(text)
            for _ in range(draw.randint(0, max(1, len(text) // 60))):
                text[draw.randrange(len(text))] = word()
    passage = [word() for _ in range(100)]
    for k in range(40):
        own = [word() for _ in range(draw.choice([10, 14, 18, 22, 60]))]
        table.append(" ".join(own + passage if k % 2 else passage + own))
    draw.shuffle(table)
    return [(k * 7 % 1009, text) for k, text in enumerate(table)]


def found(df):
    return bag((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_awkward_cases(spark):
    assert found(minhash.near_duplicates(documents(spark))) == expected(rows())
    assert minhash.near_duplicates(no_documents(spark)).count() == 0


@pytest.mark.parametrize("block, shingles", [(1024, 1 << 21), (5, 3000)])
def test_against_all_pairs(spark, block, shingles):
    table = families()
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    assert found(minhash.near_duplicates(docs, block, shingles)) == expected(table)


def test_estimate_is_near_the_similarity(spark):
    draw = np.random.default_rng(4)
    shared, least = [], []
    for _ in range(60):
        both = draw.integers(0, 1 << 63, draw.integers(20, 400), np.uint64)
        for _ in range(2):
            own = draw.integers(0, 1 << 63, draw.integers(1, 200), np.uint64)
            least.append(minhash.minima(np.concatenate([both, own])))
            shared.append((len(both), len(own)))
    signs = minhash.packed(np.array(least))
    table = [tuple(map(int, np.concatenate(signs[k : k + 2]))) for k in range(0, 120, 2)]
    names = [f"{end}{k}" for end in "ab" for k in range(minhash.LONGS)]
    df = spark.createDataFrame(table, ", ".join(f"{c} long" for c in names))
    half = minhash.LONGS
    agreeing = minhash.agreement([df[c] for c in names[:half]], [df[c] for c in names[half:]])
    got = [r[0] for r in df.select(minhash.estimate(agreeing)).collect()]
    true = [m / (m + a + b) for (m, a), (_, b) in zip(shared[::2], shared[1::2])]
    errors = np.array(got) - true
    assert abs(errors.mean()) < 0.02 and np.abs(errors).max() < 0.17
    assert 0.6 < minhash.LEAST_ESTIMATE < 0.7
