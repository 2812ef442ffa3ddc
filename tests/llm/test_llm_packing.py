from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import edge_docs, edge_rows, no_docs, prose
from millrace.llm.chunk_tokens import ChunkEncoder, segments
from millrace.llm.packing import PackedCorpus, pack_lengths
from tokenizers import Tokenizer

WORD = public_tokenizers.path("word_bpe_49k.json")
FILES = {True: public_tokenizers.path("byte_bpe_50k.json"), False: WORD}
ENCODERS = {k: ChunkEncoder(path, k) for k, path in FILES.items()}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n  'stre.,!19é|<>"), st.characters(codec="utf-8")), max_size=60), st.booleans())
def test_ids_equal_the_library(text, blanks):
    e = ENCODERS[blanks]
    assert list(e.encode(text)) == e.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blanks", [True, False])
def test_ids_of_many_texts(blanks, monkeypatch):
    monkeypatch.setattr("millrace.llm.chunk_tokens.SEGMENT_CHARS", 500)
    monkeypatch.setattr("millrace.llm.chunk_tokens.CACHED_PIECES", 300)
    texts = [prose(200, k) for k in range(5)] + ["", None, "  a  b \n\n c ", "<|endoftext|> x", prose(400, 9) + "  "]
    e = ChunkEncoder(FILES[blanks], blanks)
    assert [list(g) for g in e.encode_all(texts)] == [e.library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert "".join(segments(texts[0], 100)) == texts[0]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.data())
def test_plan_fills_every_bin_without_gaps(capacity, data):
    counts = data.draw(st.dictionaries(st.integers(1, capacity), st.integers(0, 40), max_size=20))
    plan = pack_lengths(counts, capacity)
    bins, seen = defaultdict(list), defaultdict(int)
    for length, low, high, per_bin, first, offset in plan.slots:
        assert low == seen[length]
        seen[length] = high
        for r in range(high - low):
            bins[first + r // per_bin].append((offset + r % per_bin * length, length))
    assert dict(seen) == {n: c for n, c in counts.items() if c}
    assert sorted(bins) == list(range(plan.bins))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2


def test_plan_is_close_to_the_least():
    rng = random.Random(5)
    counts = {rng.randint(1, 2048): rng.randint(1, 10**6) for _ in range(900)}
    plan = pack_lengths(counts)
    assert plan.bins * 2048 <= 1.12 * sum(n * c for n, c in counts.items())
    small = {n: c for n, c in counts.items() if n < 500}
    assert pack_lengths(small).bins * 2048 <= 1.002 * sum(n * c for n, c in small.items())


def test_packed_documents(spark):
    packed = PackedCorpus(edge_docs(spark), WORD, capacity=512)
    rows = [r.asDict() for r in packed.placed("ids").collect()]
    library = Tokenizer.from_file(WORD)
    want = sorted((str(i), tuple([*library.encode(t or "", add_special_tokens=False).ids, 0])) for i, t, *_ in edge_rows())
    by_doc = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] and r["start"] == 512 * r["piece"]
        by_doc[str(r["doc_id"]), r["piece"]].append(tuple(ids.tolist()))
    starts = sorted((doc, p) for (doc, piece), parts in by_doc.items() if piece == 0 for p in parts)
    assert [(d, ids[:512]) for d, ids in want] == starts
    assert sum(r["length"] for r in rows) == sum(len(ids) for _, ids in want)
    at = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
    assert max(at.values()) <= 512
    assert {r["sequence_id"]: r["n_tokens"] for r in packed.sequences().collect()} == dict(at)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in packed.sequences().collect())


def test_many_equal_lengths_are_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr("millrace.llm.packing.RANKED_TOGETHER", 7)
    df = spark.range(200).selectExpr("id AS doc_id", "'one two three' AS text")
    rows = PackedCorpus(df, WORD, capacity=9).placed().collect()
    assert sorted((r["sequence_id"], r["offset"]) for r in rows) == [(s, o) for s in range(100) for o in (0, 4)]


def test_no_documents(spark):
    assert PackedCorpus(no_docs(spark), WORD).placed().collect() == []


def test_places_start_no_second_kind_of_workers(spark):
    assert "ExistingRDD" not in plan_of(PackedCorpus(edge_docs(spark), WORD).placed())
