import itertools
import zlib

import numpy as np
from llm_cases import SCHEMA, no_documents, rows

from pledgeline.llm import language_id

SF = "/root/testdata/sf0.01"


def test_forward_backward_against_all_paths():
    draw = np.random.default_rng(2)
    lengths = np.array([4, 1, 3])
    scores, transitions = draw.normal(size=(8, 3)), draw.normal(size=(3, 3))
    marginals, expected = language_id.forward_backward(scores, lengths, transitions)
    brute, pairs, begin = np.zeros((8, 3)), np.zeros((3, 3)), 0
    for n in lengths:
        weights = {}
        for path in itertools.product(range(3), repeat=int(n)):
            score = sum(scores[begin + t, s] for t, s in enumerate(path))
            weights[path] = np.exp(score + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        total = sum(weights.values())
        for path, w in weights.items():
            for t, s in enumerate(path):
                brute[begin + t, s] += w / total
            for a, b in zip(path, path[1:]):
                pairs[a, b] += w / total
        begin += n
    assert np.allclose(marginals, brute) and np.allclose(expected, pairs)


def test_long_chains_stay_finite():
    scores = np.random.default_rng(1).normal(size=(64, 4)) * 30
    far = np.full((4, 4), -language_id.MOST_TRANSITION) + 24 * np.eye(4)
    marginals, _ = language_id.forward_backward(scores, np.array([64]), far)
    assert np.isfinite(marginals).all() and np.allclose(marginals.sum(axis=1), 1)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in language_id.languages(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert {d for d, r in got.items() if r.held_out} == set(held)
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_code_switched_words_are_told_apart():
    german = "der hund und die katze schlafen nicht auf dem sofa und der vogel singt sehr schön"
    french = "le chien et le chat ne dorment pas sur le canapé et les oiseaux chantent très bien"
    model = language_id.train([(german, "de"), (french, "fr")] * 3)
    words = (german.split()[:8]) + french.split()[:9]
    marginals, _ = language_id.forward_backward(
        model.evidence(words), np.array([len(words)]), model.transitions
    )
    best = [model.languages[k] for k in marginals.argmax(axis=1)]
    assert best == ["de"] * 8 + ["fr"] * 9


def test_awkward_documents(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = language_id.languages(df).collect()
    assert len(got) == len(rows())
    lettered = {r[0]: any(c.isalpha() for c in r[1] or "") for r in rows() if r[0] is not None}
    for r in got:
        if r.doc_id is not None and r.doc_id != 0:
            assert (r.lang_pred == "und") == (not lettered[r.doc_id])
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert language_id.languages(no_documents(spark)).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language_id.languages(df).collect()] == [("und", 0.0)]
    one = spark.createDataFrame([(1, "some words", "en")], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language_id.languages(one).collect()] == [("en", 1.0)]


def test_long_texts_take_bounded_memory():
    """Many short lines and one long one: the same rows as in any other blocks, in bounded memory."""
    import tracemalloc

    draw = np.random.default_rng(2)
    words = {"a": ["lorem", "ipsa", "dola"], "b": ["kuu", "mies", "ja"]}
    texts = [(" ".join(draw.choice(words[l], 40)), l) for l in "ab" for _ in range(20)]
    model = language_id.train(texts)
    lines = [str(w) for w in draw.choice(words["a"], 200_000)]
    text = "\n".join(lines) + "\n" + " ".join(draw.choice(words["b"], 3000))
    tracemalloc.start()
    got = language_id.label(model, [text, "kuu ja", text[:500]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    assert [g[0] for g in got] == ["a", "b", "a"]
    # in one grid
    scores = draw.normal(size=(500, 3))
    lengths = np.array([1, 64, 3, 200, 1, 1, 230])
    moves = draw.normal(size=(3, 3))
    whole = language_id._forward_backward(scores, lengths, moves, True)
    cells, language_id.CELLS = language_id.CELLS, 100
    try:
        parts = language_id.forward_backward(scores, lengths, moves)
    finally:
        language_id.CELLS = cells
    assert np.allclose(whole[0], parts[0], atol=1e-12) and np.allclose(whole[1], parts[1])
    # a text is cut between words only, wherever its parts end
    part, language_id.PART, size, language_id.BATCH_CHARS = language_id.PART, 7, language_id.BATCH_CHARS, 50
    try:
        again = language_id.label(model, [text[:5000], "kuu ja"])
    finally:
        language_id.PART, language_id.BATCH_CHARS = part, size
    tokens = [t for tokens, *_ in language_id._chained([text]) for t in tokens]
    assert tokens == text.split() and [g[0] for g in again] == ["a", "b"]
