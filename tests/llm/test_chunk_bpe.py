"""Chunked encoding against the tokenizers library on whole texts."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barflow.llm import chunk_bpe as module
from barflow.llm.chunk_bpe import CERTAIN, body, chunks, cuts, encode_chunks
from barflow.llm.queries import LLM_QUERIES, json_tokenizer

peer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _ids(text):
    return peer.encode(text or "", add_special_tokens=False).ids


def _check(df, texts):
    found = {r["doc_id"]: r for r in df.collect()}
    assert len(found) == len(texts)
    for i, t in texts.items():
        r = found[i]
        assert np.frombuffer(r["ids"], "<u4").tolist() == _ids(t) and r["n_tokens"] == len(_ids(t)), repr((t or "")[:80])
        assert r["decoded"] == peer.decode(_ids(t), skip_special_tokens=False)


def _corpus(seed):
    rng = random.Random(seed)
    words = ["the", "don't", "naïve", "12", "x1y2", "中文字符。", "🎉", "<|endoftext|>", "a  b", "\n\n", "end.", "'s", "é", "\t", "  ", "ab" * 40]
    passages = [" ".join(rng.choices(words, k=400)) for _ in range(6)]
    texts = {}
    for i in range(60):
        parts = [rng.choice(passages)[rng.randrange(3) :] for _ in range(rng.randrange(1, 5))]
        texts[i] = rng.choice(["", " ", "\n", "w", "'"]).join(parts) + rng.choice(["", " ", "tail", "\n "])
    return texts


@pytest.mark.parametrize("bits", [4, 7])
def test_shared_passages(spark, docs_of, monkeypatch, bits):
    monkeypatch.setattr(module, "CUT_BITS", bits)
    monkeypatch.setattr(module, "SHORTEST", 16)
    texts = _corpus(bits)
    _check(encode_chunks(docs_of(list(texts.items())), json_tokenizer()), texts)


def test_nulls_repeats_long_and_clashing_names(spark):
    texts = ["", None, " ", "same text " * 300, "same text " * 300, "<|endoftext|>", "a<|endoftext|>" * 500, "x" * 60_000, "字" * 9_000, "q w " * 60_000, "\n" * 5000]
    rows = [(i, t, 5, "y", [1]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, IDS int, doc string, pieces array<int>")
    got = encode_chunks(df, json_tokenizer())
    assert got.columns == ["doc_id", "doc", "pieces", "ids", "n_tokens", "decoded"]
    _check(got, dict(enumerate(texts)))
    assert encode_chunks(df.limit(0), json_tokenizer()).count() == 0
    same = spark.createDataFrame([(None, "again and again " * 200)] * 5, "doc_id bigint, text string")
    assert encode_chunks(same, json_tokenizer()).distinct().count() == 1


def test_a_wrong_chunk_is_found_out(spark, docs_of, monkeypatch):
    """All chunks under one hash: what is put together is wrong, so those texts are encoded whole."""
    monkeypatch.setattr(module, "SHORTEST", 16)
    monkeypatch.setattr(module, "_cut", _one_hash)
    texts = _corpus(3)
    _check(encode_chunks(docs_of(list(texts.items())), json_tokenizer()), texts)


_real_cut = module._cut


def _one_hash(tokenizer):
    real = _real_cut(tokenizer)

    def run(batches):
        for b in real(batches):
            yield b.set_column(0, "chunk", pa.array(np.zeros(b.num_rows, np.int64)))

    return run


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1 \n'.,中。\t", max_size=80), st.text(alphabet="st'l1 \n.é", max_size=40))
def test_certain_places_cut_every_text(a, b):
    """Encoding the two sides of a certain place apart gives the ids of the whole."""
    text = (a + b).encode()
    for m in CERTAIN.finditer(text):
        left, right = text[: m.start()].decode(), text[m.start() :].decode()
        assert _ids(left) + _ids(right) == _ids(text.decode())


def test_cuts_depend_on_content_alone(monkeypatch):
    rng = np.random.default_rng(1)
    shared, head = rng.integers(97, 123, 9000, np.uint8), rng.integers(97, 123, 1234, np.uint8)
    monkeypatch.setattr(module, "CUT_BITS", 6)
    one, two = cuts(shared), cuts(np.concatenate([head, shared])) - len(head)
    assert len(one) > 50 and set(one[one >= 32]) == set(two[two >= 32])
    monkeypatch.setattr(module, "STEP", 100)
    assert cuts(shared).tolist() == one.tolist()
    spans = chunks(bytes(9000), one)
    assert spans[0][0] == 0 and spans[-1][1] == 9000 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert all(e - s <= module.LONGEST for s, e in chunks(bytes(90_000), np.empty(0, np.int64)))
    assert body(b"nothing" * 50, 0, 350) is None


def test_vocabularies_beyond_two_bytes():
    assert module._packing(50_257) == "<u2" and module._packing(70_000) == "<u4"
    assert module._literals(json.dumps({"added_tokens": []})) is None


def test_query(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = LLM_QUERIES["op11_chunk_bpe"](spark, small).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = _ids(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
