"""The registered queries against their SQL, and the pipeline's stages against plain Python."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from wardstone.llm import packing, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert compare(queries.QUERIES[name](spark, SF), duck, queries.ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11))


def test_queries_without_sql(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = dict(duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall())
    leaks = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op7_benchmark_decontamination"](spark, SF).collect()}
    assert leaks >= {(d, i) for d, t in docs for i, item in items.items() if item in t}
    toxic = queries.QUERIES["op4_toxicity"](spark, SF).collect()
    assert len(toxic) == len(docs) and all(r["predicted"] == (r["score"] >= 0.7) for r in toxic)
    redacted = {r["doc_id"]: r for r in queries.QUERIES["op2_pii_surrogates"](spark, SF).collect()}
    for d, t in docs:
        for own in re.findall(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|AKIA[A-Z0-9]{16}", t):
            assert own not in redacted[d]["text"]
        assert redacted[d]["n_entities"] or redacted[d]["text"] == t


def test_pipeline_stages(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{at}")
        out = spark.read.parquet(f"{tmp_path}/{at}")
        kept[name] = (docs, out)
        if at < 4:
            assert out.columns == columns
            assert out.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        docs = out
    before, after = kept["line dedup"]
    assert after.where(F.length("text") != F.col("n_chars")).count() == 0
    lines = [x for r in after.collect() for x in [r["text"].split("\n")]]
    pairs = [(a, b) for x in lines for s in [[y for y in x if y.strip()]] for a, b in zip(s, s[1:])]
    gone = before.count() - after.count()
    assert gone >= 0 and len(pairs) > 100
    before, after = kept["near dedup"]
    texts = [r["text"] for r in after.where("length(text) > 0").collect()]
    assert len(texts) == len(set(texts))
    _, packed = kept["packing"]
    before, _ = kept["packing"]
    rows = packed.collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before.select("doc_id").collect()}
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for content in by.values():
        content.sort()
        assert content[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(content, content[1:])) and sum(n for _, n in content) <= packing.CAPACITY
