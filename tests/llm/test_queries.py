"""The registered queries: SQL where it can tell, and the pipeline against the
stages' own rules in plain Python."""

import os
import re

import pytest

import __spark_entry__ as E
import corpus_pipeline
from tabflow.llm.minhash import Similarity
from tabflow.llm.oracle import ORACLE_SQL
from tabflow.llm.queries import QUERIES
from tabflow.llm.quality_rules import quality_rules
from tests.llm.fixtures import awkward, rows
from tests.llm.test_near_and_match import _brute, _distance
from tests.llm.test_text_operators import _line_dedup
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    problems, _, _ = compare(spark, duck(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert not problems, problems


def test_every_query_covers_its_table(spark):
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name in set(QUERIES) - {"op1_decontamination", "op6_token_counts", "op10_packing", "op12_spelling"}:
        assert rows(QUERIES[name](spark, SMALL).select("doc_id")) == rows(docs.select("doc_id")), name


def test_decontamination_finds_every_item_by_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    plain = lambda s: re.sub(r"\s+", " ", s.lower())
    items = {r["item_id"]: plain(r["text"]).strip() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op1_decontamination"](spark, SMALL).collect()}
    assert {(d, i) for d, t in docs.items() for i, item in items.items() if item in plain(t)} <= found
    for d, i in found:
        assert _distance(items[i], plain(docs[d]), True) <= 0.1 * len(items[i])


def test_pipeline_matches_plain_python(spark):
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    benchmark = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    stages, docs, made = dict(corpus_pipeline.STAGES), source, {}
    for name in list(stages)[:-1]:
        docs = corpus_pipeline.materialize(stages[name](spark, docs, SMALL), name)
        assert docs.columns == source.columns and docs.dtypes == source.dtypes
        made[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    assert set(made["quality_rules"]) == {r["doc_id"] for r in quality_rules(source).where("kept").collect()}
    assert made["line_dedup"] == {i: t for i, _, _, t in _line_dedup(made["quality_rules"].items())}
    assert set(made["near_dedup"]) == {i for i, _, _, kept in _brute(made["line_dedup"].items(), Similarity()) if kept}
    plain = lambda s: re.sub(r"\s+", " ", s.lower())
    gone = set(made["near_dedup"]) - set(made["decontamination"])
    holds = {i for i, t in made["near_dedup"].items() if any(plain(b).strip() in plain(t) for b in benchmark)}
    assert holds <= gone
    for i in gone - holds:
        assert any(_distance(plain(b).strip(), plain(made["near_dedup"][i]), True) <= 0.1 * len(b.strip()) for b in benchmark)
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in packed} == set(made["decontamination"])


def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            left = stage(spark, frame, SMALL)
            assert left.columns == docs.columns, name
            assert left.count() <= frame.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()
