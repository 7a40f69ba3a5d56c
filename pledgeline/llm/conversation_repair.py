"""Conversation structure repair: the cheapest edits that give every conversation legal turns.

Rows are damaged first (a test of the repair, fixed by the hash of conversation and turn), then faults are
counted and the rows are edited until their role initials are nothing or ``s?(ua)+``. Edits: Keep 0, Rerole
to user or assistant 2, Delete 3 (forced for blank rows and duplicates), Insert an empty user or assistant
turn 2; a truncated row that is not deleted adds 1. ``audit`` is the string of the edits' initials; of the
cheapest edits the one with the least audit is taken.

Costs: a node is a place between rows and one of four states (nothing yet, system, user, assistant). Cost to
go is computed from the end to the front for all conversations of a batch at once. Path ranking: the arcs on
which costs agree are optimal. Every node is ranked by the first letter of its least audit, then, by pairs
of ranks over pointers of twice the length, by the first 2, 4, 8, ... letters; an edit's initial fixes
where it leads, so the least audit of each length ends in one node. Each node's arc is the one of least
letter and rank behind it, and the path is read off through the doubled pointers.

Order and size: equal rows are counted, not listed (all copies after the first are deleted, as one step of
many D). The others are sorted by conversation and turn over range partitions, so a conversation of any size
is spread over many tasks, and cut into blocks of ``BLOCK_ROWS`` rows. Conversations that lie in one block
are repaired at once. Of the others, each block gives its 4 x 4 matrix of least costs; one row per block goes
from the last to the first (costs behind each block) and back (the state in which the path enters it), then
all blocks are repaired in parallel and their pieces joined in order. Only the SHA-256 of one conversation
is by nature one stream.

Defined results: a null role or text, and a null in the hashed ``conv_id:turn``, reads as one space; rows
without ``conv_id`` are one conversation. Rows are ordered by turn (nulls first), equal turns by role and
text. Initials are the first characters of roles. A conversation that loses all rows has zeros and empty
strings' values. An empty table gives an empty result. Columns other than ``conv_id``, ``turn``, ``role``
and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import shared_folder, stored

BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 22
#: Rows whose costs and ranks are computed at once.
BATCH_ROWS = 1 << 16

# Fixed values of the contract: white space, sentence ends, costs, legal neighbours.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
CLASSES = "sua"
LEGAL = {(0, 1), (1, 2), (2, 1)}

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NONE, BLANK, DUPLICATE, CUT = range(4)
FAR = 1 << 60
#: The state behind a kept row by its class (s, u, a, other) and the state before it; -1: not legal.
KEPT = np.full((4, 4), -1)
KEPT[0, NOTHING] = SYSTEM
KEPT[1, [NOTHING, SYSTEM, ASSISTANT]] = USER
KEPT[2, USER] = ASSISTANT
#: The state behind a rerolled or inserted row by the state before it.
TURN = np.array([USER, USER, ASSISTANT, USER])
#: What is still to be paid behind the last row.
AT_END = [0, 2 * INSERT, INSERT, 0]
LETTERS = b" DIKR"
NEW_ROLE = {USER: "user", ASSISTANT: "assistant"}

ROWS = "conv_id, turn, role, text, copies, class, fault"
BLOCKS = """part int, block int, whole boolean, low long, high long, turns long, classes binary,
    faults binary, copies array<long>, roles array<string>, texts array<string>"""
RESULT = """gaps long, blank long, duplicate long, truncated long, illegal long, cost long,
    audit string, repaired_sha256 string"""
PIECE = """part int, block int, low long, high long, turns long, first int, last int, blank long,
    duplicate long, truncated long, illegal long, cost long, audit string, lines string, edits long"""
PLACE = ["conv_id", "part", "block"]


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``; a conversation's dropped rows leave one of 0 copies."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")
    )
    gone = F.col("kind") == 0
    text = (
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", f"[{ENDS}]", ""))
        .otherwise(F.col("text"))
    )
    return rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(text).alias("text"),
        F.when(gone, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def with_faults(rows: DataFrame, folder: str) -> DataFrame:
    """Equal rows as one with its ``copies``, with the role's class and the first copy's fault."""
    initial = F.substring("role", 1, 1)
    kind = F.lit(3)
    for number, letter in enumerate(CLASSES):
        kind = F.when(initial == letter, number).otherwise(kind)
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = stored(
        rows.groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
        .select("*", kind.alias("class"), end.alias("end"), said.alias("said")),
        folder,
        "rows",
    )
    again = (
        rows.filter("copies > 0 and end <> ''")
        .groupBy(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"))
        .agg(
            F.count(F.lit(1)).alias("times"),
            F.min("turn").alias("first"),
            F.bool_or(F.col("turn").isNull()).alias("unnumbered"),
        )
        .filter("times > 1")
        .drop("times")
    )
    again = stored(again, folder, "again").hint("merge")
    same = rows["conv_id"].eqNullSafe(again["_conv"]) & (rows["said"] == again["_said"])
    earlier = F.coalesce(
        F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("first"))), F.lit(False)
    )
    fault = (
        F.when(F.col("end") == "", BLANK)
        .when(earlier, DUPLICATE)
        .when(~F.col("end").isin(list(ENDS)), CUT)
        .otherwise(NONE)
    )
    return rows.join(again, same, "left").withColumn("fault", fault).select(*ROWS.split(", "))


@dataclass
class Block:
    """Rows of one conversation in order, without those of no copies."""

    conv_id: int | None
    number: int
    low: int | None = None
    high: int | None = None
    turns: int = 0
    chars: int = 0
    rows: list = field(default_factory=list)

    def add(self, turn, role, text, copies, kind, fault) -> None:
        if not copies:
            return
        self.rows.append((kind, fault, copies, role, text))
        self.chars += len(text)
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def values(self, part: int, whole: bool) -> tuple:
        kinds, faults, copies, roles, texts = map(list, zip(*self.rows)) if self.rows else ([],) * 5
        place = (self.conv_id, part, self.number, whole, self.low, self.high, self.turns)
        return (*place, bytes(kinds), bytes(faults), copies, roles, texts)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _schema(df: DataFrame, columns: str) -> tuple[str, pa.Schema]:
    """A result's columns behind ``conv_id``, for Spark and for Arrow."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "bigint": pa.int64(), "boolean": pa.bool_()}
    kinds |= {"binary": pa.binary(), "string": pa.string()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in kinds.items()}
    text = f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {columns}"
    fields = [f.split() for f in text.split(",")]
    return text, pa.schema([(name, kinds[kind]) for name, kind in fields])


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= BLOCK_CHARS or len(held) >= 4096:
            yield _batch(held, schema)
            held, total = [], 0
    yield _batch(held, schema)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Sorted rows as blocks; ``whole`` if one block surely has all rows of its conversation."""
    text, schema = _schema(rows, BLOCKS)

    def cut(part: int, stream: Iterator[tuple]) -> Iterator[tuple]:
        block, opened_by = None, 0  # how many conversations began in this partition
        for conv_id, *row in stream:
            if block is None or conv_id != block.conv_id:
                if block is not None:
                    # the first one of a partition may have begun in the partition before
                    yield block.values(part, block.number == 0 and opened_by > 1)
                block, opened_by = Block(conv_id, 0), opened_by + 1
            elif len(block.rows) >= block_rows or block.chars >= BLOCK_CHARS:
                yield block.values(part, False)
                block = Block(conv_id, block.number + 1)
            block.add(*row)
        if block is not None:
            yield block.values(part, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        yield from _in_batches(cut(part, _tuples(batches)), schema, lambda r: sum(map(len, r[-1])))

    order = ["conv_id", "turn", "role", "text"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, text)


class Steps:
    """The steps of many blocks side by side: each row's first copy, and its other copies as one."""

    def __init__(self, kinds: list[bytes], faults: list[bytes], copies: list[list[int]]):
        sizes = [len(k) for k in kinds]
        kind = np.frombuffer(b"".join(kinds), np.uint8).astype(np.int64)
        fault = np.frombuffer(b"".join(faults), np.uint8).astype(np.int64)
        more = np.concatenate([np.array(c, np.int64) for c in copies] + [np.empty(0, np.int64)]) - 1
        each = 1 + (more > 0)
        self.row = np.repeat(np.arange(len(kind)), each)
        is_run = np.r_[False, self.row[1:] == self.row[:-1]][: len(self.row)]
        self.kind = kind[self.row]
        forced = np.isin(fault, (BLANK, DUPLICATE))[self.row] | is_run
        self.weight = np.where(is_run, more[self.row], 1)
        self.kept = np.where(forced, FAR, TRUNCATED * (fault[self.row] == CUT))
        block = np.repeat(np.arange(len(sizes)), sizes)
        self.first_row = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.count = np.bincount(block[self.row], minlength=len(sizes))
        # levels are the places between steps: one more than steps in each block
        ends = np.cumsum(self.count + 1)
        self.begin = ends - self.count - 1
        self.levels = int(ends[-1])
        self.first_step = self.begin - np.arange(len(sizes))
        self.kind_of, self.fault_of, self.more, self.block = kind, fault, more, block

    def counts(self) -> list[np.ndarray]:
        """Blank, duplicate, truncated and illegal rows of each block."""
        size = len(self.count)
        add = lambda chosen, by: np.bincount(
            self.block[chosen], by[chosen], size
        ).astype(np.int64)
        copies = self.more + 1
        blank, cut = self.fault_of == BLANK, self.fault_of == CUT
        repeats = add(~blank, self.more) + add(self.fault_of == DUPLICATE, np.ones_like(copies))
        legal = np.zeros((4, 4), bool)
        legal[tuple(zip(*LEGAL))] = True
        bad = ~legal[self.kind_of[:-1], self.kind_of[1:]] & (self.block[:-1] == self.block[1:])
        bad = np.r_[False, bad][: len(self.block)].astype(np.int64)
        every = np.ones(len(copies), bool)
        return [add(blank, copies), repeats, add(cut, np.ones_like(copies)), add(every, self.more + bad)]

    def _ways(self, after: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs to go by Delete, Keep and Rerole of some steps, given the costs behind them."""
        behind = KEPT[self.kind[step]]
        at = np.arange(len(step))[:, None]
        kept = np.where(behind < 0, FAR, after[at, behind]) + self.kept[step, None]
        return (
            after + DELETE * self.weight[step, None],
            kept,
            after[:, TURN] + REROLE + self.kept[step, None],
        )

    def costs(self, after: np.ndarray) -> np.ndarray:
        """Cost to go at every level and state; ``after`` holds the costs behind each block."""
        cost = np.empty((self.levels, 4), np.int64)
        cost[self.begin + self.count] = after
        order = np.argsort(-self.count, kind="stable")
        longest = self.count[order]
        for t in range(1, int(longest[0]) + 1 if len(longest) else 1):
            active = order[: np.searchsorted(-longest, -t, side="right")]
            place = self.count[active] - t
            best = np.minimum.reduce(
                self._ways(cost[self.begin[active] + place + 1], self.first_step[active] + place)
            )
            inserted = best[:, TURN] + INSERT
            best = np.minimum.reduce([best, inserted, inserted[:, TURN] + INSERT])
            cost[self.begin[active] + place] = np.minimum(best, FAR)
        return cost

    def matrices(self) -> np.ndarray:
        """Least costs of each block from every state before it to every state behind it."""
        ends = np.full((4, 4), FAR)
        np.fill_diagonal(ends, 0)
        made = [self.costs(np.tile(e, (len(self.count), 1)))[self.begin] for e in ends]
        return np.stack(made, axis=2)

    def arcs(self, cost: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each node (level x 4 + state) and letter (D I K R): whether optimal, and the next node."""
        state = np.arange(4)
        level = np.arange(self.levels)
        is_end = np.zeros(self.levels, bool)
        is_end[self.begin + self.count] = True
        inner = level[~is_end]
        step = np.arange(len(inner))  # levels without the ends are the steps in order
        deleted, kept, rerolled = self._ways(cost[inner + 1], step)
        good = np.zeros((4, self.levels, 4), bool)
        there = np.tile(level[:, None] * 4 + state, (4, 1, 1))
        good[0, inner] = deleted == cost[inner]
        good[2, inner] = kept == cost[inner]
        good[3, inner] = rerolled == cost[inner]
        there[0, inner] += 4
        there[2, inner] = (inner[:, None] + 1) * 4 + KEPT[self.kind[step]]
        there[3, inner] = (inner[:, None] + 1) * 4 + TURN
        # behind the last row of a conversation turns are still inserted; a cut block leaves that to the next
        open_end = np.zeros(self.levels, bool)
        open_end[(self.begin + self.count)[last]] = True
        good[1] = (cost[:, TURN] + INSERT == cost) & (open_end | ~is_end)[:, None]
        there[1] = level[:, None] * 4 + TURN
        return good.reshape(4, -1), np.where(good, there, 0).reshape(4, -1)

    def ranked(self, good: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """The letter, the doubled pointers and the length of the least path of every node."""
        nodes = np.arange(good.shape[1])
        ends = ~good.any(axis=0)
        first = np.where(ends, 0, good.argmax(axis=0) + 1)  # letters in ASCII order, the end before all
        pointer = np.where(ends, nodes, there[np.maximum(first - 1, 0), nodes])
        rank = first
        while True:
            pairs = rank * (int(rank.max(initial=0)) + 1) + rank[pointer]
            rank = np.unique(pairs, return_inverse=True)[1]
            if (pointer[pointer] == pointer).all():
                break
            pointer = pointer[pointer]
        letter = np.arange(1, 5)[:, None] * (len(nodes) + 1)
        chosen = np.where(good, letter + rank[there], 5 * (len(nodes) + 1)).argmin(axis=0)
        pointer = np.where(ends, nodes, there[chosen, nodes])
        length, pointers = (~ends).astype(np.int64), [pointer]
        while not (pointer[pointer] == pointer).all():
            length = length + length[pointer]
            pointer = pointer[pointer]
            pointers.append(pointer)
        return np.where(ends, 0, chosen + 1), pointers, length


def _paths(letter, pointers, length, start) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the paths from some nodes, one after the other, and the paths' lengths."""
    steps = length[start]
    node = np.repeat(start, steps)
    place = np.arange(len(node)) - np.repeat(np.cumsum(steps) - steps, steps)
    for bit, pointer in enumerate(pointers):
        node = np.where(place >> bit & 1, pointer[node], node)
    return node, steps


def _pieces(rows: list[tuple]) -> Iterator[tuple]:
    """Repaired blocks, from (conv_id, part, block, ..., texts, entry, last, after) each."""
    conv, part, number, low, high, turns, kinds, faults, copies, roles, texts, entry, last, after = map(
        list, zip(*rows)
    )
    steps = Steps(kinds, faults, copies)
    cost = steps.costs(np.array(after))
    good, there = steps.arcs(cost, np.array(last))
    letter, pointers, length = steps.ranked(good, there)
    start = steps.begin * 4 + np.array(entry)
    node, sizes = _paths(letter, pointers, length, start)
    target = pointers[0][node]
    exit_cost = cost.ravel()[pointers[-1][start]]
    exit_cost = np.where(last, 0, exit_cost)
    paid = cost.ravel()[start] - exit_cost
    step = node // 4 - np.repeat(steps.begin - steps.first_step, sizes)
    counts = [c.tolist() for c in steps.counts()]
    letters = letter[node]
    weight = np.where(letters == 1, steps.weight[np.minimum(step, len(steps.weight) - 1)], 1) if len(
        steps.weight
    ) else np.ones(len(node), np.int64)
    begin = 0
    for b in range(len(rows)):
        own = slice(begin, begin + int(sizes[b]))
        begin = own.stop
        codes = np.frombuffer(LETTERS, np.uint8)[np.repeat(letters[own], weight[own])]
        lines = []
        for code, k, state in zip(letters[own].tolist(), step[own].tolist(), (target[own] % 4).tolist()):
            row = int(steps.row[k] - steps.first_row[b]) if code > 2 else -1
            if code == 3:
                lines.append(f"{roles[b][row]}:{texts[b][row]}")
            elif code == 4:
                lines.append(f"{NEW_ROLE[state]}:{texts[b][row]}")
            elif code == 2:
                lines.append(f"{NEW_ROLE[state]}:")
        ends = (kinds[b][0], kinds[b][-1]) if kinds[b] else (None, None)
        yield (
            *(conv[b], part[b], number[b], low[b], high[b], turns[b], *ends),
            *(c[b] for c in counts),
            *(int(paid[b]), codes.tobytes().decode(), "\n".join(lines), len(lines)),
        )


class Joined:
    """A conversation's result from its pieces in order."""

    def __init__(self, conv_id):
        self.conv_id, self.low, self.high, self.turns, self.last = conv_id, None, None, 0, None
        self.counts, self.audit = np.zeros(5, np.int64), []
        self.digest, self.empty = hashlib.sha256(), True

    def add(self, low, high, turns, first, last, *rest) -> None:
        *counts, audit, lines, edits = rest
        self.counts += np.array(counts)
        if first is not None:
            # the pair across the cut
            self.counts[3] += self.last is not None and (self.last, first) not in LEGAL
            self.last = last
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high
        self.audit.append(audit)
        if edits:
            self.digest.update(("" if self.empty else "\n").encode() + lines.encode())
            self.empty = False

    def values(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.counts.tolist(), "".join(self.audit), self.digest.hexdigest())


def _chunks(stream: Iterator[tuple], kinds: int) -> Iterator[list[tuple]]:
    held, total = [], 0
    for row in stream:
        held.append(row)
        total += len(row[kinds]) + 1
        if total >= BATCH_ROWS:
            yield held
            held, total = [], 0
    if held:
        yield held


def _by_place(df: DataFrame, ascending: bool) -> DataFrame:
    """One conversation's blocks in one task, in order: one row for each ``BLOCK_ROWS`` rows."""
    order = [F.col(c) if ascending else F.col(c).desc() for c in PLACE]
    return df.repartition("conv_id").sortWithinPartitions(*order)


def _at_place(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.select(*[F.col(c).alias("_" + c) for c in PLACE], *right.columns[3:]).hint("merge")
    same: Column = left["conv_id"].eqNullSafe(other["_conv_id"])
    for c in PLACE[1:]:
        same = same & (left[c] == other["_" + c])
    return left.join(other, same).drop(*["_" + c for c in PLACE])


def _entered(cut: DataFrame, folder: str) -> DataFrame:
    """Blocks of cut conversations: the ``entry`` state of the path, whether ``last``, costs ``after``."""
    narrow = cut.select(*PLACE, "classes", "faults", "copies")

    def matrices(batches):
        for rows in _chunks(_tuples(batches), 3):
            made = Steps(*map(list, list(zip(*rows))[3:])).matrices().reshape(-1, 16)
            yield _batch([(*r[:3], m) for r, m in zip(rows, made.tolist())], matrix_schema)

    def backwards(batches):
        def each(stream):
            conv, after = object(), None
            for conv_id, part, block, matrix in stream:
                last = conv_id != conv
                if last:
                    conv, after = conv_id, np.array(AT_END)
                yield conv_id, part, block, last, after.tolist()
                after = (np.array(matrix).reshape(4, 4) + after).min(axis=1)

        yield from _in_batches(each(_tuples(batches)), after_schema, lambda r: 1)

    def exits(batches):
        for rows in _chunks(_tuples(batches), 3):
            *_, kinds, faults, copies, last, after = map(list, zip(*rows))
            steps = Steps(kinds, faults, copies)
            arcs = steps.arcs(steps.costs(np.array(after)), np.array(last))
            ends = steps.ranked(*arcs)[1][-1]
            there = (ends[steps.begin[:, None] * 4 + np.arange(4)] % 4).tolist()
            found = [(*r[:3], *r[6:], e) for r, e in zip(rows, there)]
            yield _batch(found, exit_schema)

    def forwards(batches):
        def each(stream):
            conv, state = object(), NOTHING
            for conv_id, part, block, last, after, there in stream:
                if conv_id != conv:
                    conv, state = conv_id, NOTHING
                yield conv_id, part, block, state, last, after
                state = there[state]

        yield from _in_batches(each(_tuples(batches)), entry_schema, lambda r: 1)

    at = "part int, block int, "
    matrix, matrix_schema = _schema(cut, at + "matrix array<long>")
    after, after_schema = _schema(cut, at + "last boolean, after array<long>")
    there, exit_schema = _schema(cut, at + "last boolean, after array<long>, there array<long>")
    entry, entry_schema = _schema(cut, at + "entry int, last boolean, after array<long>")
    made = stored(narrow.mapInArrow(matrices, matrix), folder, "matrices")
    behind = stored(_by_place(made, False).mapInArrow(backwards, after), folder, "behind")
    led = stored(_at_place(narrow, behind).mapInArrow(exits, there), folder, "exits")
    return stored(_by_place(led, True).mapInArrow(forwards, entry), folder, "entries")


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: ``conv_id`` and the columns of ``RESULT``."""
    folder = shared_folder(conversations.sparkSession)
    rows = stored(with_faults(damaged(conversations), folder), folder, "faults")
    held = stored(blocks(rows, block_rows), folder, "blocks")
    result, schema = _schema(conversations, RESULT)
    piece, piece_schema = _schema(conversations, PIECE)

    def joined(stream: Iterator[tuple]) -> Iterator[tuple]:
        now = None
        for conv_id, _, _, *rest in stream:
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now.values()
                now = Joined(conv_id)
            now.add(*rest)
        if now is not None:
            yield now.values()

    def repaired(batches):
        for chunk in _chunks(_tuples(batches), 6):
            yield _batch(list(_pieces(chunk)), piece_schema)

    def finished(batches):
        for chunk in _chunks(_tuples(batches), 6):
            yield _batch(list(joined(_pieces(chunk))), schema)

    def in_order(batches):
        yield from _in_batches(joined(_tuples(batches)), schema, lambda r: len(r[-2]))

    whole = held.filter("whole").drop("whole").select(
        "*",
        F.lit(NOTHING).alias("entry"),
        F.lit(True).alias("last"),
        F.array(*[F.lit(c).cast("long") for c in AT_END]).alias("after"),
    )
    cut = held.filter("not whole").drop("whole")
    pieces = stored(_at_place(cut, _entered(cut, folder)).mapInArrow(repaired, piece), folder, "pieces")
    return whole.mapInArrow(finished, result).union(_by_place(pieces, True).mapInArrow(in_order, result))
