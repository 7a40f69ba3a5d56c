import random

import pytest
from llm_cases import bag, documents, no_documents, rows, words_of

from pledgeline.llm import substring_dedup


def expected(table, window):
    found = {}
    lists = [words_of(r[1]) for r in table]
    for d, words in enumerate(lists):
        for k in range(len(words) - window + 1):
            found.setdefault(tuple(words[k : k + window]), []).append((d, k))
    gone = [set() for _ in table]
    for places in found.values():
        if len(places) > 1:
            for d, k in places:
                gone[d].update(range(k, k + window))
    return bag(
        (r[0], len(w), len(g), " ".join(x for k, x in enumerate(w) if k not in g))
        for r, w, g in zip(table, lists, gone)
    )


def found(df):
    return bag((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect())


def test_against_brute_force(spark):
    got = substring_dedup.without_repeats(documents(spark)).collect()
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == expected(rows(), 35)
    for r in got:
        assert sum(s.until - s.begin for s in r.spans) == r.n_removed


@pytest.mark.parametrize("window, seed", [(5, 2), (7, 7), (6, 3)])
def test_small_windows_over_few_words(spark, window, seed):
    draw = random.Random(window)
    table = []
    for k in range(60):
        n = draw.randint(0, 40)
        words = [draw.choice("abcd") for _ in range(n)]
        if k % 5 == 0:
            words = ["a"] * n
        if k % 3 == 0 and table:
            words += draw.choice(table)[1].split()[:15]
        table.append((k, " ".join(words)))
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    assert found(substring_dedup.without_repeats(df, window, seed)) == expected(table, window)


def test_empty(spark):
    assert substring_dedup.without_repeats(no_documents(spark)).count() == 0
