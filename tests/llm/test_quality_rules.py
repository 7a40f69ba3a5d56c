import numpy as np
from llm_cases import bag, documents, no_documents, rows, words_of

from pledgeline.llm import quality_rules

SF = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    words = words_of(text)
    lines = [line for line in text.split("\n") if words_of(line)]
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    repeated = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def base_failed(c):
    return c[0] < 20 or 100 * c[4] > 30 * c[0]


def test_counts_against_brute_force(spark):
    labels = spark.createDataFrame([(0, 1), (None, 0), (3, None)], "doc_id long, quality int")
    got = quality_rules.judge(documents(spark), labels).collect()
    expected = [(r[0], *counts(r[1])) for r in rows()]
    names = ["doc_id", *quality_rules.COUNTS]
    assert bag(tuple(r[n] for n in names) for r in got) == bag(expected)
    # labels of one kind: only the base rule
    assert all(r.kept == (not r.base_failed) and r.rule == 0 for r in got)
    assert bag((r.doc_id, r.base_failed) for r in got) == bag((e[0], base_failed(e[1:])) for e in expected)


def test_learned_list_against_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality_rules.judge(docs, labels).join(labels, "doc_id").collect()
    good = [r for r in judged if r.quality == 1 and not r.base_failed]
    bad = [r for r in judged if r.quality == 0]
    assert np.mean([r.kept for r in good]) > 0.99 and np.mean([r.kept for r in bad]) < 0.1


def test_rules_that_are_learned_and_their_conditions_agree(spark):
    draw = np.random.default_rng(0)
    values = {f: draw.random(3000) for f in quality_rules.FEATURES}
    bad = ((values["symbols_per_word"] > 0.8) & (values["mean_word"] > 0.3)) | (values["distinct_share"] < 0.1)
    rules = quality_rules.learn(values, bad, np.arange(3000) % 3 != 0)
    assert 1 <= len(rules) <= 6 and all(1 <= len(r.conditions) <= 4 for r in rules)
    first = np.zeros(3000, int)
    for number, rule in reversed(list(enumerate(rules, 1))):
        first[rule.covers(values, np.ones(3000, bool))] = number
    assert ((first > 0) == bad).mean() > 0.97
    df = spark.createDataFrame(list(zip(*[values[f].tolist() for f in quality_rules.FEATURES])), quality_rules.FEATURES)
    got = [r[0] for r in df.select(quality_rules.verdict(rules)).collect()]
    assert got == first.tolist()
    # noise teaches nothing
    assert quality_rules.learn(values, draw.random(3000) < 0.5, np.arange(3000) % 3 != 0) == []


def test_empty_and_kept(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.judge(no_documents(spark), labels).count() == 0
    kept = quality_rules.good_documents(documents(spark), labels)
    assert kept.columns == documents(spark).columns
    assert bag((r.doc_id, r.text) for r in kept.collect()) == bag(
        (r[0], r[1]) for r in rows() if not base_failed(counts(r[1]))
    )
