import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import bag, documents, no_documents, rows
from tokenizers import Tokenizer

from pledgeline.llm import bpe, token_count
from pledgeline.llm.queries import RANKS, TOKENIZER

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tik():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def hugging():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


# chunks of 64 characters are spliced everywhere; the texts without spaces need wider overlaps
@pytest.mark.parametrize("chunk, overlap", [(1 << 16, 1 << 10), (64, 16)])
def test_ids_are_those_of_the_library(spark, tik, chunk, overlap):
    encoded = bpe.encode(documents(spark), PATH, PATTERN, chunk, overlap)
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    decoded = bpe.decode(encoded, PATH, PATTERN).collect()
    got = bag((r.doc_id, r.n_tokens, bytes(r.ids)) for r in encoded.collect())
    ids = [(r[0], tik.encode_ordinary(r[1] or "")) for r in rows()]
    assert got == bag((i, len(t), np.array(t, "<u4").tobytes()) for i, t in ids)
    assert bag((r.doc_id, bytes(r.decoded)) for r in decoded) == bag(
        (r[0], (r[1] or "").encode()) for r in rows()
    )


def test_digests(spark, tik):
    got = bpe.round_trip(documents(spark), PATH, PATTERN).collect()
    text = rows()[8][1]
    row = next(r for r in got if r.doc_id == rows()[8][0])
    ids = np.array(tik.encode_ordinary(text), "<u4").tobytes()
    assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("chunk, overlap", [(1 << 16, 1 << 10), (96, 32)])
def test_counts_are_those_of_the_library(spark, hugging, chunk, overlap):
    path = public_tokenizers.path(TOKENIZER)
    got = token_count.token_counts(documents(spark), path, 100, chunk, overlap).collect()
    expected = []
    for row in rows():
        n = len(hugging.encode(row[1] or "", add_special_tokens=False))
        expected.append((row[0], len((row[1] or "").encode()), n, n > 100))
    assert bag(got) == bag(expected)


def test_parts_of_random_texts(spark, tik, hugging):
    draw = random.Random(11)
    alphabet = [*"ab'sretvlmd19 .,-\n\t", "  ", " ", " ", " ", "\x1c", "\x85", "é", "日", "ß", " ", "'re", "²"]
    alphabet += ["<|endoftext|>", "<|end", "oftext|>"]
    codec = bpe.Vocabulary(spark, PATH, PATTERN).open()
    counter = token_count.TokenizerFile(spark, public_tokenizers.path(TOKENIZER)).open()
    for _ in range(1500):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(1, 40)))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == tik.encode_ordinary(text), repr(text)
        assert counter.count(text) == len(hugging.encode(text, add_special_tokens=False)), repr(text)


def test_white_space_of_the_pattern_is_white_space_here(tik):
    # a character that the library takes for white space and Python doesn't would make cuts unsafe
    for c in map(chr, [*range(0x3100), 0xFEFF, *range(0xFFF0, 0xFFFE)]):
        if 0xD800 <= ord(c) < 0xE000 or c.isspace():
            continue
        whole, parts = f"a{c} b", [f"a{c}", " b"]
        assert tik.encode_ordinary(whole) == [i for p in parts for i in tik.encode_ordinary(p)], repr(c)


def test_chunks_of_one_text_are_read_by_several_tasks(spark, tik):
    from pyspark.sql import functions as F

    from pledgeline.llm import chunks

    draw = random.Random(5)
    text = " ".join(f"word{draw.randrange(10**6)}" for _ in range(200_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    dealt = chunks.pieces(chunks.long_texts(docs, 1 << 14), 1 << 14, 1 << 8)
    tasks = dealt.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == -(-len(text) // (1 << 14))
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = bpe.encode(docs, PATH, PATTERN, 1 << 14, 1 << 8).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == tik.encode_ordinary(text)


def test_other_patterns_are_refused(spark):
    with pytest.raises(ValueError, match="pattern"):
        bpe.encode(no_documents(spark), PATH, r"\w+|\W+")


def test_empty_and_foreign_tokenizers(spark):
    empty = no_documents(spark)
    assert bpe.round_trip(empty, PATH, PATTERN).count() == 0
    assert token_count.token_counts(empty, public_tokenizers.path(TOKENIZER)).count() == 0
    with pytest.raises(ValueError, match="byte-level"):
        token_count.TokenizerFile(spark, public_tokenizers.path("word_bpe_49k.json"))
