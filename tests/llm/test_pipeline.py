"""Every stage against a plain version of it, on its own input."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from helpers_llm import documents, edited, prose
from pyspark.sql import functions as F

from palimpsest.llm import packing, pii
from palimpsest.llm.oracle import ORACLE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    clean = [prose(120, k) for k in range(60)]
    junk = [" ".join(f"{w}###" for w in prose(120, 500 + k).split()) for k in range(12)]
    texts = clean + junk + [clean[3], clean[3].replace(" ", "\n"), edited(clean[5], [7]), None, "too short", clean[8] + " write a@b.org now"]
    documents(spark, texts).write.parquet(f"{path}/documents.parquet")
    labels = [(k, int(k < 60), 0) for k in range(0, 72)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()} if name != "packing" else kept["pii"]
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == COLUMNS
            kept[name] = {r.doc_id: r for r in docs.collect()}
            assert set(kept[name]) <= set(before)
    assert set(kept["quality"]) == {*range(60), 72, 73, 74, 77}
    assert set(kept["exact_dedup"]) == set(kept["quality"]) - {72, 73}
    assert len(kept["near_dedup"]) == len(kept["exact_dedup"]) - 2
    assert len({5, 74} & set(kept["near_dedup"])) == 1 and len({8, 77} & set(kept["near_dedup"])) == 1
    for key, row in kept["pii"].items():
        assert row.text == pii.clean(kept["near_dedup"][key].text)
        assert row.n_chars == len(row.text) and not re.search("a@b.org", row.text)
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == set(kept["pii"])
    places = sorted((r.sequence_id, r.offset, r.length) for r in pieces)
    used = Counter()
    for sequence, offset, length in places:
        assert offset == used[sequence]
        used[sequence] += length
    assert max(used.values()) <= packing.CAPACITY


def test_run_is_the_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.agg(F.countDistinct("doc_id")).first()[0] > 50
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("text", [[], [None, "", " "]])
def test_empty_tables(spark, tmp_path, text):
    documents(spark, text).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_only_expressible_queries_have_sql():
    assert set(ORACLE) == {"op2_exact_dedup", "op7_warc", "op11_centroids", "op12_decontaminate"}
