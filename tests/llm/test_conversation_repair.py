import hashlib
import random
import zlib
from functools import cache

import pytest
from llm_cases import bag
from pyspark.sql import functions as F

from pledgeline.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, n int, part int, block int, cost string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """The rows of each conversation in order."""
    found = {}
    for conv_id, turn, role, text, *_ in rows:
        held = found.setdefault(conv_id, [])
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        held += [(turn, role, text)] * (2 if kind == 3 else 1)
    for held in found.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return found


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        said = text.strip(SPACE)
        if not said:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """By trying every edit: cost, audit and lines of the best way."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @cache
    def best(k, state, inserted):
        ways = [(0, "", ())] if k == len(rows) and state in ("", "a") else []

        def add(cost, letter, line, then):
            if then:
                ways.append((cost + then[0], letter + then[1], (*line, *then[2])))

        for to, name in names.items():
            if inserted < 2 and (state, to) in after:
                add(2, "I", [name + ":"], best(k, after[state, to], inserted + 1))
        if k < len(rows):
            _, role, text = rows[k]
            add(3, "D", [], best(k + 1, state, 0))
            if found[k] not in ("blank", "duplicate"):
                more = found[k] == "truncated"
                if (state, role[:1]) in after:
                    add(more, "K", [f"{role}:{text}"], best(k + 1, after[state, role[:1]], 0))
                for to, name in names.items():
                    if (state, to) in after:
                        add(2 + more, "R", [f"{name}:{text}"], best(k + 1, after[state, to], 0))
        return min(ways, default=None)

    for k in range(len(rows), -1, -1):  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(k, state, 0)
    return best(0, "", 0)


def expected(table):
    result = []
    for conv_id, rows in damaged(table).items():
        found = faults(rows)
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(tuple(rows), found)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        result.append((conv_id, gaps, *counts, illegal, cost, audit, digest))
    return bag(result)


def conversations(count, length):
    draw = random.Random(count)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "u", None]
    texts = ["Yes.", "No", "What?\n", "so it is! ", "\x1c", "", " \n", "étude…", "ok.", None]
    table = []
    for conv in range(count):
        n = draw.randint(1, length)
        for turn in range(n):
            at = draw.choice([turn, turn, turn, turn * 3 - 5, None])
            role = roles[turn % 2] if draw.random() < 0.6 else draw.choice(roles)
            text = draw.choice(texts) if draw.random() < 0.4 else f"t{draw.randrange(30)}."
            table.append((conv if conv % 9 else None, at, role, text, 1, 2, 3, "c"))
    table += table[:40]  # repeated rows
    draw.shuffle(table)
    return table


@pytest.mark.parametrize("block_rows, length", [(4096, 9), (2, 12), (3, 60)])
def test_against_every_edit(spark, block_rows, length):
    table = conversations(600 // length, length)
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = cr.repair(df, block_rows)
    assert got.columns[0] == "conv_id"
    assert bag(got.collect()) == expected(table)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_hot_row_and_conversation(spark):
    """A row repeated many times, and a conversation that holds nearly all rows."""
    turns = spark.range(3000).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("line "), F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    copies = spark.range(2000).select(
        F.lit(2).cast("long"), F.lit(5).cast("long"), F.lit("user"), F.lit("same.")
    )
    df = turns.union(copies)
    got = cr.repair(df, 64).collect()
    table = [tuple(r) for r in df.collect()]
    assert bag(got) == expected(table)


def test_empty_and_lost(spark):
    assert cr.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    # one conversation of which damage drops the only row
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "a.", 0, 0, 0, "")], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in cr.repair(df).collect()] == [(lost, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_ranks_order_nodes_by_their_least_audit():
    draw = random.Random(8)
    kinds = [bytes(draw.randrange(4) for _ in range(draw.randrange(40))) for _ in range(20)]
    fault = [bytes(draw.randrange(4) for _ in k) for k in kinds]
    steps = cr.Steps(kinds, fault, [[1] * len(k) for k in kinds])
    costs = steps.costs([cr.AT_END] * len(kinds))
    arcs = steps.arcs(costs, [True] * len(kinds))
    letter, pointers, length = steps.ranked(*arcs)
    for node in range(0, len(letter), 7):
        path, _ = cr._paths(letter, pointers, length, [node])
        assert letter[path].all() and letter[pointers[-1][node]] == 0
        # no optimal arc of a node has a smaller letter than the one taken
        assert all(arcs[0][: letter[k] - 1, k].sum() == 0 for k in path)
