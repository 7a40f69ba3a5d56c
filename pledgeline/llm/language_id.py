"""Language of a text by a linear-chain conditional random field over its words.

Each word has one label, a language. A word's own evidence is the sum of learned weights of its
features: affixes of up to three letters, n-grams of two and three letters with the word's ends, the
word itself if it is in the lexicon, and the languages whose lexicon has it. Learned transitions tie
neighbours together, so that a word that could be of any language follows its context, while a run of
words of another language is told apart. Forward-backward gives each word's probabilities; a text's
language is the one with the largest mean over its words, and the mean is the score.

A chain is a line of the text, or ``CHAIN`` words of a longer one. The texts are learned from as chains
of one language and as chains made of runs of different languages, as in code-switched text.

Only a sample is learned from: about ``SAMPLE_DOCS`` documents of each language, chosen by a hash of the
id, and of each a piece of ``SAMPLE_CHARS`` characters from a place chosen by the hash. Documents whose
crc32(id) leaves ``HELD_OUT`` modulo ``FOLDS`` are never learned from. Every whole text is labelled.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if
there is nothing to learn from. Ties go to the first language in code point order. A document without
an id counts as not held out and is not learned from. Rows with equal ids or texts each give a row.
Columns other than ``doc_id``, ``text`` and ``lang`` are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS = 300
SAMPLE_CHARS = 1200
LEXICON_WORDS = 2000
BUCKETS = 1 << 16
#: Letters of a block of words whose features are found at once.
BLOCK_LETTERS = 1 << 16
CHAIN = 64
STEPS = 30
RATE = 0.15
DECAY = 2e-3
#: Steps along a chain after which probabilities are scaled up again, long before they underflow.
RESCALED = 8
#: Transition weights are kept within this, so that no step scales down by more.
MOST_TRANSITION = 12.0
#: Words whose evidence a Python worker remembers.
REMEMBERED = 300_000
#: Cells (times x chains x languages) of a grid of chains that are worked on together.
CELLS = 1 << 20
#: Tokens of texts that are labelled at once; longer texts go in parts.
PART = 1 << 16
#: Documents in one batch that a task labels at once, and characters after which it is cut.
BATCH = 256
BATCH_CHARS = 1 << 21

UNKNOWN = "und"
LABELLED = "doc_id long, held_out boolean, lang_pred string, score double"


def letters_of(token: str) -> str:
    """The letters of a token, in lower case."""
    return token.lower() if token.isalpha() else "".join(filter(str.isalpha, token)).lower()


def _grams(words: list[str], width: int) -> np.ndarray:
    """Buckets of affixes and n-grams of words of at most ``width`` letters; ``BUCKETS`` for none."""
    n = len(words)
    letters = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), "<u4")
    length = np.array([len(w) for w in words])
    codes = np.zeros((n, width + 4), np.uint64)
    codes[:, 0] = ord("^")
    codes[:, 1 : width + 1] = letters.reshape(n, width)
    codes[np.arange(n), length + 1] = ord("$")
    at = np.arange(width + 1)
    found = []

    def add(kind: int, parts: list[np.ndarray], valid: np.ndarray) -> None:
        h = np.full(parts[0].shape, kind, np.uint64)
        for part in parts:
            h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        found.append(np.where(valid, (h % np.uint64(BUCKETS)).astype(np.int64), BUCKETS))

    for size in (2, 3):
        parts = [codes[:, j : j + width + 1] for j in range(size)]
        add(size, parts, at[None] + size <= length[:, None] + 2)
    for size in (1, 2, 3):
        add(10 + size, [codes[:, j + 1 : j + 2] for j in range(size)], length[:, None] >= size)
        tail = np.maximum(length - size, 0)[:, None] + 1 + np.arange(size)
        last = np.take_along_axis(codes, tail, axis=1)
        add(20 + size, [last[:, j : j + 1] for j in range(size)], length[:, None] >= size)
    return np.concatenate(found, axis=1)


@dataclass
class Lexicon:
    """Frequent words, each with its own feature, and the feature of its set of languages."""

    words: dict[str, int]
    sets: list[int]

    def __len__(self) -> int:
        return len(self.words) + max(self.sets, default=-1) + 1

    def features(self, words: list[str], none: int) -> np.ndarray:
        """Two features of each word, counted from ``BUCKETS + 1``; ``none`` if not in it."""
        place = np.array([self.words.get(w, -1) for w in words], np.int64)
        known = place >= 0
        sets = np.array([*self.sets, 0], np.int64)[place] + len(self.words)
        both = np.stack((place, sets), axis=1) + BUCKETS + 1
        return np.where(known[:, None], both, none)


def features(words: list[str], lexicon: Lexicon) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which words, and their features (rows of weights), in blocks of words of similar length."""
    widths = [max(8, 1 << (len(w) - 1).bit_length()) for w in words]
    order = np.argsort(widths, kind="stable")
    begin = 0
    while begin < len(order):
        width = widths[order[begin]]
        until = begin
        most = max(1, BLOCK_LETTERS // width)
        while until < len(order) and until - begin < most and widths[order[until]] == width:
            until += 1
        chosen = order[begin:until]
        block = [words[k] for k in chosen]
        yield chosen, np.concatenate((_grams(block, width), lexicon.features(block, BUCKETS)), axis=1)
        begin = until


@dataclass
class Model:
    languages: list[str]
    lexicon: Lexicon
    weights: np.ndarray  # feature x language; row BUCKETS, the missing feature, is zero
    transitions: np.ndarray  # language x language, as logarithms

    def evidence(self, words: list[str]) -> np.ndarray:
        result = np.zeros((len(words), len(self.languages)), np.float32)
        for chosen, rows in features(words, self.lexicon):
            result[chosen] = self.weights[rows].sum(axis=1)
        return result


def _packed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of each word in a time x chain grid, chains by falling length; chains alive per time."""
    order = np.argsort(-lengths, kind="stable")
    column = np.empty(len(lengths), np.int64)
    column[order] = np.arange(len(lengths))
    time = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    alive = np.bincount(time, minlength=int(lengths.max(initial=0)))
    return time, np.repeat(column, lengths), alive


def _alike(lengths: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The chains in blocks of similar length whose grid stays within ``CELLS``."""
    order = np.argsort(-lengths, kind="stable")
    begin = 0
    while begin < len(order):
        until = begin + max(1, CELLS // (k * int(lengths[order[begin]])))
        yield order[begin:until]
        begin = until


def forward_backward(
    scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, expect: bool = True
):
    """Each word's label probabilities, and the expected number of each transition if asked for.

    ``scores`` is word x label, the chains one after another; every length is positive.
    """
    k = scores.shape[1]
    starts = np.cumsum(lengths) - lengths
    marginals, expected = np.empty(scores.shape), np.zeros((k, k))
    for chosen in _alike(lengths, k):
        of = lengths[chosen]
        words = np.arange(of.sum()) + np.repeat(starts[chosen] - (np.cumsum(of) - of), of)
        marginals[words], moved = _forward_backward(scores[words], of, transitions, expect)
        expected += moved
    return marginals, expected


def _forward_backward(
    scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, expect: bool
) -> tuple[np.ndarray, np.ndarray]:
    """The same on one grid of times and chains."""
    k = scores.shape[1]
    time, column, alive = _packed(lengths)
    steps, chains = len(alive), len(lengths)
    evidence = np.ones((steps, chains, k))
    evidence[time, column] = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    ahead, behind = evidence.copy(), np.ones_like(evidence)
    for t in range(1, steps):
        n = alive[t]
        a = ahead[t - 1, :n] @ move
        if t % RESCALED == 0:
            a /= a.max(axis=1, keepdims=True)
        ahead[t, :n] *= a
    expected = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        n = alive[t + 1]
        after = evidence[t + 1, :n] * behind[t + 1, :n]
        if expect:
            pairs = ahead[t, :n, :, None] * move[None] * after[:, None, :]
            expected += (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = after @ move.T
        if t % RESCALED == 0:
            b /= b.max(axis=1, keepdims=True)
        behind[t, :n] = b
    ahead *= behind
    both = ahead[time, column]
    return both / both.sum(axis=1, keepdims=True), expected


def chains_of(text: str) -> list[list[str]]:
    """Words of letters, by line and in runs of at most ``CHAIN``."""
    result = []
    for line in text.split("\n"):
        words = [w for w in map(letters_of, line.split()) if w]
        result += [words[k : k + CHAIN] for k in range(0, len(words), CHAIN)]
    return result


def _training_chains(texts: list[tuple[str, str]]) -> tuple[list[list[str]], list[list[str]]]:
    """Chains of words and of their languages: the texts' own, and mixtures of runs of them."""
    words, labels = [], []
    for text, language in texts:
        for chain in chains_of(text):
            words.append(chain)
            labels.append([language] * len(chain))
    draw = np.random.default_rng(0)
    for _ in range(len(words) // 2):
        mixed, of = [], []
        for _ in range(int(draw.integers(2, 4))):
            k = int(draw.integers(len(words)))
            begin = int(draw.integers(max(1, len(words[k]) - 4)))
            size = int(draw.integers(4, 20))
            mixed += words[k][begin : begin + size]
            of += labels[k][begin : begin + size]
        words.append(mixed[:CHAIN])
        labels.append(of[:CHAIN])
    return words, labels


def _lexicon(texts: list[tuple[str, str]]) -> Lexicon:
    """The most frequent words of each language, and the languages each of them belongs to."""
    counts: dict[str, Counter] = {}
    for text, language in texts:
        counts.setdefault(language, Counter()).update(w for c in chains_of(text) for w in c)
    found: dict[str, list[str]] = {}
    for language in sorted(counts):
        frequent = sorted(counts[language].items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]
        for word, _ in frequent:
            found.setdefault(word, []).append(language)
    sets: dict[tuple[str, ...], int] = {}
    numbers = [sets.setdefault(tuple(of), len(sets)) for of in found.values()]
    return Lexicon({word: k for k, word in enumerate(found)}, numbers)


def train(texts: list[tuple[str, str]]) -> Model:
    """A model from (text, language) pairs, by gradient ascent on the chains' likelihood."""
    languages = sorted({language for _, language in texts})
    lexicon = _lexicon(texts)
    chains, of = _training_chains(texts)
    k, rows = len(languages), BUCKETS + 1 + len(lexicon)
    weights, transitions = np.zeros((rows, k), np.float32), np.zeros((k, k))
    model = Model(languages, lexicon, weights, transitions)
    if not chains or k < 2:
        return model
    place = {language: i for i, language in enumerate(languages)}
    vocabulary = {w: i for i, w in enumerate(sorted({w for c in chains for w in c}))}
    blocks = [(chosen[:, None], found) for chosen, found in features(list(vocabulary), lexicon)]
    kept = [found != BUCKETS for _, found in blocks]
    feature = np.concatenate([found[m] for (_, found), m in zip(blocks, kept)])
    owner = np.concatenate(
        [np.broadcast_to(chosen, found.shape)[m] for (chosen, found), m in zip(blocks, kept)]
    )
    words = np.array([vocabulary[w] for c in chains for w in c])
    truth = np.array([place[x] for c in of for x in c])
    lengths = np.array([len(c) for c in chains])
    chain = np.repeat(np.arange(len(chains)), lengths)
    inner = np.flatnonzero(chain[1:] == chain[:-1])
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[inner], truth[inner + 1]), 1)
    right = np.eye(k)[truth]

    def summed(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(index, values[:, j], n) for j in range(k)], axis=1)

    grads_w, grads_t = np.full((rows, k), 1e-8), np.full((k, k), 1e-8)
    for _ in range(STEPS):
        evidence = summed(owner, weights[feature], len(vocabulary))
        marginals, expected = forward_backward(evidence[words], lengths, transitions)
        miss = summed(words, right - marginals, len(vocabulary))
        step_w = summed(feature, miss[owner], rows) - DECAY * weights
        step_t = seen - expected - DECAY * transitions
        grads_w += step_w**2
        grads_t += step_t**2
        weights += (RATE * step_w / np.sqrt(grads_w)).astype(np.float32)
        transitions += RATE * step_t / np.sqrt(grads_t)
        np.clip(transitions, -MOST_TRANSITION, MOST_TRANSITION, out=transitions)
    return model


class _Evidence(dict):
    """Row of each token in a table of evidence; row 0 is for tokens without a letter."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.table = np.zeros((1, len(self.model.languages)), np.float32)

    def rows(self, tokens: list[str]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.forget()
        new = sorted(set(tokens).difference(self))
        words = [letters_of(t) for t in new]
        lettered = [w for w in words if w]
        place = iter(range(len(self.table), len(self.table) + len(lettered)))
        self.update((t, next(place) if w else 0) for t, w in zip(new, words))
        if lettered:
            self.table = np.concatenate((self.table, self.model.evidence(lettered)))
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def _chained(texts: list[str]) -> Iterator[tuple[list[str], list[int], list[int]]]:
    """Tokens, lengths of chains and the texts that these belong to, in parts of about ``PART`` tokens."""
    tokens, lengths, owners = [], [], []
    for number, text in enumerate(texts):
        begin = 0
        while begin < len(text):
            # a line, or a part of a long one that ends at white space
            until = text.find("\n", begin, begin + BATCH_CHARS)
            if until < 0:
                until = min(len(text), begin + BATCH_CHARS)
                while until < len(text) and not text[until].isspace():
                    until += 1
            words = text[begin:until].split()
            begin = until + 1
            tokens += words
            for k in range(0, len(words), CHAIN):
                lengths.append(min(CHAIN, len(words) - k))
                owners.append(number)
            if len(tokens) >= PART:
                yield tokens, lengths, owners
                tokens, lengths, owners = [], [], []
    if tokens:
        yield tokens, lengths, owners


def label(model: Model, texts: list[str], evidence: _Evidence | None = None):
    """(language, score) of each text."""
    evidence = _Evidence(model) if evidence is None else evidence
    k = len(model.languages)
    sums, held = np.zeros((len(texts), k)), np.zeros(len(texts))
    for tokens, lengths, owners in _chained(texts):
        lengths = np.array(lengths, np.int64)
        rows = evidence.rows(tokens)
        owner = np.repeat(np.array(owners, np.int64), lengths)
        # tokens without a letter are no part of a chain
        word = rows > 0
        chain = np.repeat(np.arange(len(lengths)), lengths)[word]
        lengths = np.bincount(chain, minlength=len(lengths))
        lengths = lengths[lengths > 0]
        if not len(lengths) or not k:
            continue
        scores = evidence.table[rows[word]]
        marginals, _ = forward_backward(scores, lengths, model.transitions, expect=False)
        held += np.bincount(owner[word], minlength=len(texts))
        for j in range(k):
            sums[:, j] += np.bincount(owner[word], marginals[:, j], len(texts))
    if not k:
        return [(UNKNOWN, 0.0)] * len(texts)
    return [
        (model.languages[b], min(1.0, float(sums[i, b] / held[i]))) if held[i] else (UNKNOWN, 0.0)
        for i, b in enumerate(sums.argmax(axis=1))
    ]


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS).cast("long"))


def training_texts(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """The sample to learn from, at most about ``per_language`` pieces of text each."""
    open_docs = docs.select("doc_id", "text", "lang").filter(fold() != HELD_OUT).dropna()
    counts = {r["lang"]: r["n"] for r in open_docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(
        *[F.lit(x) for l, n in sorted(counts.items()) for x in (l, int(min(1, per_language / n) * (1 << 30)))]
    )
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30).cast("long"))
    begin = F.pmod(
        F.xxhash64("doc_id", F.lit(1)),
        F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS).cast("long"),
    )
    rows = (
        open_docs.filter(chance < share[F.col("lang")])
        .select("doc_id", F.substring("text", begin.cast("int") + 1, F.lit(SAMPLE_CHARS)).alias("text"), "lang")
        .collect()
    )
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"]))]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text)
        if k + 1 - begin >= BATCH or held >= BATCH_CHARS or k + 1 == len(texts):
            yield begin, k + 1
            begin, held = k + 1, 0


def languages(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    model = docs.sparkSession.sparkContext.broadcast(train(training_texts(docs, per_language)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = _Evidence(model.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for begin, until in _slices(texts):
                found = label(model.value, texts[begin:until], evidence)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, until - begin),
                        batch.column(1).slice(begin, until - begin),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    held_out = F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select("doc_id", held_out, text).mapInArrow(run, LABELLED)
