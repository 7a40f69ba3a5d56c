import hashlib
import sys

import pytest
from llm_cases import bag
from pyspark.sql import functions as F
from test_exact_dedup import expected as exact_expected
from test_mixing import expected as mix_expected
from test_quality_rules import base_failed, counts
from test_simhash import expected as near_expected
from test_tokens import tik  # noqa: F401

import __spark_entry__ as registry
import corpus_pipeline
from check import compare
from pledgeline.llm import quality_rules, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and the output of each stage, as lists of rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # with an empty and a repeated text, and another row without an id
    extra = docs.limit(3).withColumn("doc_id", F.col("doc_id") + 5000).unionByName(
        docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")})
    )
    docs = docs.unionByName(extra)
    found = [docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        found.append(docs.collect())
    return found


def test_columns_of_documents(stages):
    for before, after in zip(stages[:-1], stages[1:-1]):
        assert after[0].asDict().keys() == before[0].asDict().keys()
        assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_quality(spark, stages):
    docs = spark.createDataFrame(stages[0])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stats = quality_rules.statistics(docs)
    rules = quality_rules.learn_rules(stats, labels)
    covered = {
        r.doc_id for r in stats.withColumn("rule", quality_rules.verdict(rules)).filter("rule > 0").collect()
    }
    assert bag(stages[1]) == bag(
        r for r in stages[0] if not base_failed(counts(r.text)) and r.doc_id not in covered
    )


def test_exact(stages):
    kept = {r[0] for r in exact_expected([tuple(r) for r in stages[1]]) if r[3]}
    assert bag(stages[2]) == bag(r for r in stages[1] if r.doc_id in kept)


def test_near(stages):
    table = [(r.doc_id, r.text) for r in stages[2]]
    kept = {r[2] for r in near_expected(table)}
    assert bag(stages[3]) == bag(r for r in stages[2] if r.doc_id in kept)


def test_mix(stages):
    table = [(r.doc_id, r.text, r.lang, r.source) for r in stages[3]]
    times = {r[0]: int(r[4] / r[1] + 0.5) for r in mix_expected(table)}
    assert bag(stages[4]) == bag(r for r in stages[3] for _ in range(times[r.doc_id]))


def test_encoded(stages, tik):  # noqa: F811
    assert bag(stages[5]) == bag(
        (
            r.doc_id,
            len(ids := tik.encode_ordinary(r.text)),
            hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
            hashlib.sha256(r.text.encode()).hexdigest(),
        )
        for r in stages[4]
    )


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_registered_queries(spark):
    names = [n for n in registry.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14))
    assert "pipeline" in registry.queries()
    with_sql = list(queries.oracle_sql())
    assert compare(spark, SF, with_sql) == {n: "" for n in with_sql}


def test_nothing_else_imports_the_subpackage():
    import pathlib

    root = pathlib.Path(registry.__file__).parent
    users = [
        str(p.relative_to(root))
        for p in [*root.glob("*.py"), *(root / "pledgeline").rglob("*.py")]
        if "pledgeline.llm" in p.read_text() and "llm" not in p.parts
    ]
    assert sorted(users) == ["__spark_entry__.py", "corpus_pipeline.py"]
    assert sys.modules["pledgeline.llm"]
