"""The pipeline on a small table, stage by stage against the operators' plain versions; the registered queries."""

import os
import sys

import corpus_pipeline
import duckdb
import pytest
import test_llm_operators as plain_versions
from test_shingles import jaccard, plain_set

import __spark_entry__ as entrypoint
from tidemark.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import compare  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, small):
    return small


def test_every_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    from tidemark.llm.common import kept

    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, kept(stage(spark, docs, folder), f"test-{name}")
        seen[name] = (before.collect(), docs.collect())
        assert docs.columns == names or name == "encode"
    given, left = seen["quality"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = {r["doc_id"] for r in given} - {r["doc_id"] for r in left}
    assert out and all(labels.get(i, 0) == 0 for i in out) and set(map(tuple, left)) <= set(map(tuple, given))

    given, left = seen["near_duplicates"]
    sets = {r["doc_id"]: plain_set(r["text"]) for r in given}
    label = {i: i for i in sets}
    near = [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed, label[a], label[b] = changed or label[a] != label[b], low, low
    assert near and sorted(r["doc_id"] for r in left) == sorted(set(label.values()))

    given, left = seen["personal_data"]
    texts = {r["doc_id"]: r["text"] for r in given}
    changed = [r for r in left if r["text"] != texts[r["doc_id"]]]
    assert len(given) == len(left) and changed
    for r in changed:
        for value in plain_versions.re.findall(r"\S+@\S+\.com|AKIA\w{16}|\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}", texts[r["doc_id"]]):
            assert (value in r["text"]) == (len(value) == 16 and not plain_versions.luhn(value))

    given, left = seen["mix"]
    taken = sum(r["taken"] for r in corpus_pipeline.mixture.mix(spark.createDataFrame(given)).collect())
    assert sum(len(plain_versions.words(r["text"])) for r in left) == taken

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    given, left = seen["encode"]
    expected = sorted((r["doc_id"], tokenizer.encode(r["text"], add_special_tokens=False).ids) for r in given)
    assert sorted((r["doc_id"], r["ids"]) for r in left) == expected
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, left))


def test_stages_on_odd_and_empty_tables(spark, five, folder):
    for start in (five, five.filter("false")):
        frame = start
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, folder)
        assert frame.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
        found = frame.collect()
        assert bool(found) == (start is five) and all(len(r["ids"]) == r["n_tokens"] for r in found)


def test_registration():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entrypoint.queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    verdict, _, _ = compare.compare(spark, db, name, folder)
    assert verdict.startswith("ok"), verdict
