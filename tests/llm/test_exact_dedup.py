import hashlib

import numpy as np
import pytest
from llm_cases import SCHEMA, bag, documents, no_documents, rows

from pledgeline.llm import exact_dedup


def expected(table):
    groups = {}
    for row in table:
        groups.setdefault(row[1] or "", []).append(row[0])
    result = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for place, i in enumerate(sorted(ids, key=lambda i: (i != keep, repr(i)))):
            digest = hashlib.sha256(text.encode()).digest()
            result.append((i, keep, len(ids), place == 0, digest))
    return bag(result)


def found(df):
    return bag((r[0], r[1], r[2], r[3], bytes(r[4])) for r in df.collect())


def test_against_brute_force(spark):
    assert found(exact_dedup.exact_duplicates(documents(spark))) == expected(rows())


def test_many_shards_and_salts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "KEYS_PER_SHARD", 3)
    monkeypatch.setattr(exact_dedup, "ROWS_PER_LOOKUP", 2)
    assert found(exact_dedup.exact_duplicates(documents(spark))) == expected(rows())


def test_history(spark):
    old = spark.createDataFrame([(1, "seen"), (9, "seen"), (4, None)], "doc_id long, text string")
    new = spark.createDataFrame(
        [(20, "seen"), (21, "new"), (22, "new"), (23, ""), (9, "seen")], "doc_id long, text string"
    )
    got = {
        (r.doc_id): (r.keep_id, r.group_size, r.kept, r.member)
        for r in exact_dedup.exact_duplicates(new, old).collect()
    }
    assert got == {
        20: (9, 2, False, True),
        9: (9, 2, False, True),
        21: (22, 2, False, False),
        22: (22, 2, True, False),
        23: (4, 1, False, True),
    }


def test_empty(spark):
    empty = no_documents(spark)
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.exact_duplicates(documents(spark), empty).filter("kept").count() == len(
        {r[1] or "" for r in rows()}
    )


def test_documents_that_stay(spark):
    kept = exact_dedup.without_duplicates(documents(spark))
    assert kept.columns == documents(spark).columns
    assert bag((r.doc_id, r.text or "") for r in kept.collect()) == bag(
        (i, t)
        for t, i in {
            (r[1] or "", max((o[0] for o in rows() if (o[1] or "") == (r[1] or "") and o[0] is not None), default=None))
            for r in rows()
        }
    )
    assert SCHEMA.count(",") + 1 == len(kept.columns)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500, 5000])
def test_hash_is_minimal_and_perfect(n):
    draw = np.random.default_rng(n)
    words = draw.integers(0, 1 << 63, (n, 4)).astype(np.uint64)
    levels = exact_dedup.perfect_hash(words)
    assert sorted(exact_dedup.slots_of(words, levels).tolist()) == list(range(n))
    others = exact_dedup.slots_of(draw.integers(0, 1 << 63, (50, 4)).astype(np.uint64), levels)
    assert ((others >= -1) & (others < n)).all()
