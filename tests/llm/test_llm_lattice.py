from __future__ import annotations

import math
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import edge_docs, edge_rows, no_docs
from millrace.llm.lattice import SampledEncoder, Vocabulary, decoded, sample_ids

MODEL = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = Vocabulary(MODEL)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tabe.é"), st.characters(codec="utf-8")), max_size=40), max_size=5), st.integers(0, 9))
def test_decoding_is_lossless_and_batches_do_not_matter(texts, seed):
    encoder = SampledEncoder(VOCABULARY, seed)
    ids = encoder.encode(range(len(texts)), texts)
    assert [VOCABULARY.decode(i) for i in ids] == texts
    assert [encoder.encode([k], [t])[0].tolist() for k, t in enumerate(texts)] == [i.tolist() for i in ids]


def test_segmentations_follow_the_lattice():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = {model.id_to_piece(k): k for k in range(model.get_piece_size())}

    def paths(text):
        if not text:
            yield (), 0.0
        for n in range(1, len(text) + 1):
            if text[:n] in pieces:
                for rest, weight in paths(text[n:]):
                    yield (pieces[text[:n]], *rest), weight - math.log1p(max(0.0, -model.get_score(pieces[text[:n]])))

    chance = {ids: math.exp(w) for ids, w in paths("▁there")}
    total, n = sum(chance.values()), 40_000
    drawn = Counter(tuple(i.tolist()) for i in SampledEncoder(VOCABULARY, 7).encode(range(n), [" there"] * n))
    assert set(drawn) <= set(chance)
    assert max(abs(drawn[ids] / n - c / total) for ids, c in chance.items()) < 0.012


def test_rows(spark):
    sampled = sample_ids(edge_docs(spark), MODEL, seed=3)
    rows = sampled.select("doc_id", "text", "ids", decoded(sampled.ids, MODEL).alias("back")).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in rows) == sorted((str(i), t or "") for i, t, *_ in edge_rows())
    assert all(r["back"] == (r["text"] or "") for r in rows)
    keyed = {}
    for r in rows:
        assert keyed.setdefault((r["doc_id"], r["text"]), r["ids"]) == r["ids"]
    assert keyed[1, rows[0]["text"]] != keyed[2, rows[0]["text"]]
    again = {(r["doc_id"], r["text"]): r["ids"] for r in sample_ids(edge_docs(spark).repartition(3), MODEL, seed=3).collect()}
    assert again == keyed
    assert sample_ids(no_docs(spark), MODEL).collect() == []


def test_byte_pieces_stand_for_unknown_characters():
    ids = SampledEncoder(VOCABULARY).encode([None], ["\ue000"])[0]
    assert ids.tolist() == VOCABULARY.byte_ids[list("\ue000".encode())].tolist()
    assert isinstance(ids, np.ndarray)
