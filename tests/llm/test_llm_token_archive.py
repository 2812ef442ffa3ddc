from __future__ import annotations

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import edge_docs, edge_rows, no_docs
from millrace.llm.id_coder import decode_blocks, encode_blocks
from millrace.llm.token_archive import ArchiveReader, ArchiveWriter, read_token_archives, write_token_archives
from tokenizers import Tokenizer

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 5)), max_size=80), max_size=6))
def test_blocks_round_trip(blocks):
    arrays = [np.array(b, np.uint32) for b in blocks]
    back = decode_blocks(encode_blocks(arrays), [len(b) for b in arrays])
    assert [b.tolist() for b in back] == blocks


def test_blocks_do_not_depend_on_their_neighbours():
    rng = np.random.default_rng(3)
    blocks = [rng.zipf(1.4, n) % 65536 for n in (700, 20, 900, 1, 300)]
    assert [encode_blocks([b])[0] for b in blocks] == encode_blocks(blocks)


def test_repetition_is_predicted():
    block = np.tile(np.array([5, 900, 40_000, 7, 12_345]), 400)
    assert len(encode_blocks([block])[0]) * 8 < 0.4 * len(block)
    with pytest.raises(ValueError, match="65536"):
        encode_blocks([np.array([70_000])])


def test_file_holds_documents_across_blocks(monkeypatch):
    monkeypatch.setattr("millrace.llm.token_archive.BLOCK_IDS", 16)
    monkeypatch.setattr("millrace.llm.token_archive.LANES", 3)
    rng = np.random.default_rng(4)
    docs = [(None, rng.integers(0, 999, 40)), (4, np.zeros(0, np.int64)), (4, rng.integers(0, 999, 200)), (9, rng.integers(0, 65536, 1))]
    buffer = io.BytesIO()
    buffer.close = lambda: None
    writer = ArchiveWriter(buffer)
    for doc, ids in docs:
        writer.add(doc, ids.astype(np.uint32))
    writer.close()
    data = buffer.getvalue()
    got = [(d, s, np.concatenate([*parts, np.zeros(0, np.uint32)]).tolist()) for d, s, parts in ArchiveReader(io.BytesIO(data), len(data)).documents()]
    assert got == [(d, s, ids.tolist()) for (d, ids), s in zip(docs, (0, 40, 40, 240), strict=True)]
    for place in (40, len(data) - 60):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            [[*parts] for _, _, parts in ArchiveReader(io.BytesIO(bytes(broken)), len(data)).documents()]


def test_documents_read_back(spark):
    files = write_token_archives(edge_docs(spark), BYTE, end_id=2)
    rows = read_token_archives(files, with_ids=True).collect()
    library = Tokenizer.from_file(BYTE)
    want = sorted((str(i), [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, *_ in edge_rows())
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == want
    place = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == place and r["ids_crc32"] == zlib.crc32(r["ids"])
        place += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_no_documents(spark):
    assert read_token_archives(write_token_archives(no_docs(spark), BYTE, end_id=2)).collect() == []
