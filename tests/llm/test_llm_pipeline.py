from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pytest
from llm_cases import edge_docs, no_docs
from test_llm_rows import base_spans, measures
from test_llm_similar import brute
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import TESTDATA
from millrace.llm.common import written
from millrace.llm.toxicity import TERMS


def stages(spark, docs, folder):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), f"test-{name.replace(' ', '-')}")
        out.append(docs)
    return out


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("source", ["tables", "edges"])
def test_stages_equal_plain_versions(spark, source):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet") if source == "tables" else edge_docs(spark)
    quality, tame, single, clean, packed = stages(spark, docs, TESTDATA)
    assert all(s.columns == docs.columns for s in (quality, tame, single, clean))
    text = docs.columns.index("text")
    assert plain(quality) == sorted((tuple(r) for r in docs.collect() if measures(r["text"])[-1]), key=str)
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{TESTDATA}/labels.parquet").where("toxic = 1").collect()}
    gone = {r["doc_id"] for r in quality.collect()} - {r["doc_id"] for r in tame.collect()}
    known = {r["doc_id"] for r in spark.read.parquet(f"{TESTDATA}/labels.parquet").collect()}
    assert set(plain(tame)) <= set(plain(quality)) and gone & known <= toxic
    assert all(TERMS & set(re.findall(r"\w+", r["text"].lower())) for r in quality.collect() if r["doc_id"] in gone)
    component = {(doc, found) for doc, _, found in brute([(r["doc_id"], r["text"]) for r in tame.collect()], 5, 80)}
    assert plain(single) == sorted((r for r in plain(tame) if r[0] is None or (r[0], r[0]) in component), key=str)
    assert len(plain(clean)) == len(plain(single))
    for before, after in zip(plain(single), plain(clean), strict=True):
        assert base_spans(after[text]) == []
        assert ("[SECRET]" in after[text]) or after[text] == before[text]
        assert "[SECRET]" in after[text] or not base_spans(before[text])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sum(len(library.encode(r[text], add_special_tokens=False).ids) + 1 for r in plain(clean))
    rows = packed.collect()
    assert sum(r["length"] for r in rows) == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= int(np.ceil(want / 2048)) + 2


def test_run_and_empty_table(spark):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, TESTDATA).count() > 0
    assert all(s.isEmpty() for s in stages(spark, no_docs(spark), TESTDATA))
