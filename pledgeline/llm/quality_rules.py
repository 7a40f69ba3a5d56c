"""Quality rules: a decision list learned from labelled statistics, applied as Spark conditions.

One pass reads every whole text and measures it. Sequential covering learns on the measures of
labelled documents: a rule grows by the threshold that gains most information about the documents
still unexplained, until it covers no good one, and is pruned on documents it has not seen, as long as
that doesn't make it worse. Documents it covers are set aside, and the next rule is grown on the rest.
A rule that does not prove itself on the unseen documents ends the list; what no rule covers is good.
The list becomes one ``CASE WHEN`` over the measures, so the verdict is plain Spark and can be read.

Only a sample of the labelled documents is learned from, of about ``SAMPLE`` rows chosen by a hash of
the id. Everything else covers all rows.

Defined results: a null text has no words and fails the base rule. Words are runs of characters other
than ``\\x20\\x09-\\x0D``. Documents without an id cannot be labelled but are judged. Labels that are null
count as missing; a document labelled twice counts twice. Without labels of both kinds the list is
empty and only the base rule holds. Rows with equal ids or texts are judged each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import shared_folder, stored, text_or_empty

SAMPLE = 20_000
#: Base rule, fixed by contract: at least so many words, and at most so many percent repeated ones.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Words among which ``local_distinct`` counts different ones.
BLOCK = 64
#: What a rule has to show on the documents it has not seen, and how long a list and a rule may get.
MIN_PRECISION = 0.9
MIN_COVERED = 3
MAX_RULES = 24
MAX_CONDITIONS = 4
#: Thresholds that are tried for each measure: between quantiles of its values.
QUANTILES = 128
#: Documents in one batch that a task hands back.
BATCH = 256

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = [
    "mean_word",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "adjacent_share",
    "distinct_share",
    "local_distinct",
    "upper_share",
    "digit_share",
    "stops_per_word",
]
#: What the rules may test.
FEATURES = ["n_words", *MEASURES]
STATS = (
    "doc_id long, text_hash long, "
    + ", ".join(f"{c} long" for c in COUNTS)
    + ", "
    + ", ".join(f"{c} double" for c in MEASURES)
)


def _repeated_words(hashes: np.ndarray) -> int:
    n = len(hashes) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        windows = np.zeros(n, np.uint64)
        for k in range(REPEAT_WINDOW):
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
            windows ^= windows >> np.uint64(32)
    _, place, held = np.unique(windows, return_inverse=True, return_counts=True)
    begins = np.flatnonzero(held[place] > 1)
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, begins, 1)
    np.add.at(steps, begins + REPEAT_WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


def measure(text: str) -> list[float]:
    """The counts and the measures of one text, in the order of their names."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    word_chars = len(b"".join(words).decode())
    symbols = sum(text.count(s) for s in SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    repeats = _repeated_words(hashes)
    distinct = [len(set(words[k : k + BLOCK])) for k in range(0, n, BLOCK)]
    letters = np.frombuffer(raw, np.uint8)
    per_word, per_char = 1 / max(n, 1), 1 / max(word_chars, 1)
    return [
        n,
        word_chars,
        symbols,
        dup_lines,
        repeats,
        word_chars * per_word,
        symbols * per_word,
        dup_lines / max(len(lines), 1),
        repeats * per_word,
        int((hashes[1:] == hashes[:-1]).sum()) * per_word,
        len(set(words)) * per_word,
        sum(distinct) * per_word,
        int(((letters >= 65) & (letters <= 90)).sum()) * per_char,
        int(((letters >= 48) & (letters <= 57)).sum()) * per_char,
        sum(text.count(s) for s in ".!?") * per_word,
    ]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", *COUNTS, *MEASURES]
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            columns = zip(*[measure(text) for text in part.column(2).to_pylist()])
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], *[pa.array(c, k) for c, k in zip(columns, kinds)]], names
            )


def statistics(docs: DataFrame) -> DataFrame:
    """Counts and measures of each document, with the 64-bit hash of its text."""
    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text).mapInArrow(
        _measured, STATS
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        column = values[self.feature]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.4g}"


@dataclass
class Rule:
    """Covers the documents for which all conditions hold."""

    conditions: list[Condition] = field(default_factory=list)

    def covers(self, values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
        for condition in self.conditions:
            among = among & condition.holds(values)
        return among

    def column(self) -> Column:
        result = F.lit(True)
        for condition in self.conditions:
            result = result & condition.column()
        return result

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _candidates(values: dict[str, np.ndarray]) -> list[Condition]:
    found = []
    for feature in FEATURES:
        distinct = np.unique(values[feature])
        if len(distinct) > QUANTILES:
            distinct = np.unique(np.quantile(values[feature], np.linspace(0, 1, QUANTILES)))
        for threshold in ((distinct[1:] + distinct[:-1]) / 2).tolist():
            found += [Condition(feature, above, threshold) for above in (True, False)]
    return found


def _grown(candidates, holds, bad: np.ndarray, left: np.ndarray) -> Rule:
    rule, covered = Rule(), left
    while len(rule.conditions) < MAX_CONDITIONS and (covered & ~bad).any():
        p, n = (covered & bad).sum(), (covered & ~bad).sum()
        inside = holds[:, covered]
        p_after = inside @ bad[covered].astype(np.float64)
        n_after = inside @ (~bad[covered]).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = p_after * (np.log2(p_after / (p_after + n_after)) - np.log2(p / (p + n)))
        gain = np.where(p_after > 0, gain, -1)
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9:
            break
        rule.conditions.append(candidates[best])
        covered = covered & holds[best]
    return rule


def _worth(rule: Rule, values, bad: np.ndarray, among: np.ndarray) -> tuple[float, int]:
    covered = rule.covers(values, among)
    p = int((covered & bad).sum())
    return (p + 1) / (int(covered.sum()) + 2), p


def learn(values: dict[str, np.ndarray], bad: np.ndarray, grow: np.ndarray) -> list[Rule]:
    """Ordered rules that cover bad documents.

    ``grow`` marks the documents that rules are grown on; the others prune and judge them.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    candidates = _candidates({f: v[grow] for f, v in values.items()})
    if not candidates:
        return rules
    holds = np.array([c.holds(values) for c in candidates])
    while len(rules) < MAX_RULES and (left & grow & bad).any():
        rule = _grown(candidates, holds, bad, left & grow)
        if not rule.conditions:
            break
        unseen = left & ~grow
        while len(rule.conditions) > 1:
            shorter = Rule(rule.conditions[:-1])
            if _worth(shorter, values, bad, unseen) < _worth(rule, values, bad, unseen):
                break
            rule = shorter
        precision, covered = _worth(rule, values, bad, unseen)
        if covered < MIN_COVERED or precision * (covered + 2) < MIN_PRECISION * covered + 1:
            break
        seen = rule.covers(values, left)
        if (seen & bad).sum() < MIN_PRECISION * seen.sum():
            break
        rules.append(rule)
        left = left & ~seen
    return rules


def learn_rules(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules from the labels (``doc_id``, ``quality``: 0 is bad) of about ``sample`` documents."""
    known = labels.select("doc_id", F.col("quality").alias("_quality")).dropna()
    share = min(1.0, sample / max(1, known.count()))
    by_hash = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30).cast("long"))
    rows = (
        stats.join(known.filter(by_hash < int(share * (1 << 30))), "doc_id")
        .select("doc_id", "_quality", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)).alias("fold"), *FEATURES)
        .toPandas()
        .sort_values(["doc_id", "_quality"], kind="stable")
    )
    values = {f: rows[f].to_numpy(np.float64) for f in FEATURES}
    bad = rows["_quality"].to_numpy() == 0
    if bad.all() or not bad.any():
        return []
    return learn(values, bad, rows["fold"].to_numpy() != 0)


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that covers a document, from 1; 0 if none does."""
    result = None
    for number, rule in enumerate(rules, 1):
        result = (F if result is None else result).when(rule.column(), F.lit(number))
    return F.lit(0) if result is None else result.otherwise(F.lit(0))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Each document's statistics, ``base_failed``, ``rule`` (see ``verdict``) and ``kept``."""
    stats = stored(statistics(docs), shared_folder(docs.sparkSession), "statistics")
    rules = learn_rules(stats, labels, sample)
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def good_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are kept, with all their columns."""
    kept = (
        judge(docs, labels, sample)
        .filter("kept")
        .select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == kept["_kept_hash"]
    )
    return docs.join(kept, same, "left_semi")
