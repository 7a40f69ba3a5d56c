"""Documents with every awkward case, and small brute-force tools."""

from __future__ import annotations

import random

#: Other columns, some of which have names that the operators use inside.
SCHEMA = """doc_id long, text string, lang string, source string, n_chars long,
    size long, digest binary, run string, begin double, `n_words` string, fp string"""


def words_of(text: str | None) -> list[str]:
    found, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                found.append(word)
            word = ""
        else:
            word += c
    return found


def texts() -> list[str | None]:
    draw = random.Random(7)
    vocabulary = "der die das und the of and to un une les él años niño straße ÉTÉ Ünder a1 b2 x".split()
    prose = [
        " ".join(draw.choice(vocabulary) for _ in range(n)) for n in (1, 2, 3, 5, 30, 60, 90, 200, 700)
    ]
    passage = " ".join(f"w{draw.randrange(50)}" for _ in range(60))
    return [
        *prose,
        prose[7],
        prose[7].replace("der", "dem", 1),
        prose[8] + " end",
        None,
        None,
        "",
        " \t\n ",
        "  \x1c",
        "one word",
        "Und " * 120,
        passage,
        "before " + passage + " after it",
        passage + " " + passage,
        "x\n\ny\nx\n y\nx\n\n" * 9,
        "a" * 3000,
        "日本語のテキスト。" * 120,
        "it's we'll   they're\t\tI'd  'll  end \n\n x " * 60,
        "<|endoftext|> a<|endoftext|><|endof text|> b <|endoftext|>" * 30,
        "12 345 678 ٣٤ ²  \x85 \U0001f600\U0001f600 é " * 40,
        "#*$%&|<> #x" * 20,
    ]


def rows() -> list[tuple]:
    sources = ["b", "a", None, "b", "ä", "b", "Z", ""]
    langs = ["de", "en", None, "fr"]
    found = []
    for k, text in enumerate(texts()):
        found.append((k * 3, text, langs[k % 4], sources[k % 8], len(text or "")))
    # repeated rows, a repeated id with another text, and rows without an id
    found += [found[6], found[6], (0, "another text of id zero " * 5, "en", "b", 1)]
    found += [(None, found[5][1], None, None, None), (None, "no id here " * 9, "en", "a", 0)]
    return [(*row, 5, b"x", "r", 1.5, "many", "f") for row in found]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)


def roots(nodes, edges) -> dict:
    """Smallest node of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
