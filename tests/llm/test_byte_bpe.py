import base64
import hashlib
import os

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from barflow.llm.byte_bpe import Encoder, PerfectHash, Vocabulary, decode, encode, slot_owner
from barflow.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.from_ranks(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def peer():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 64, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = [f"k{i}".encode() for i in range(n)]
    h = PerfectHash(keys)
    shift, owner = h.shift.tolist(), h.owner.tolist()
    assert sorted(owner) == list(range(n))
    assert [slot_owner(k, shift, owner, h.seed) for k in keys] == list(range(n))


def test_perfect_hash_refuses_equal_keys():
    with pytest.raises(ValueError):
        PerfectHash([b"a", b"a"])


TEXTS = ["", " ", "  a", "a  ", "a\n \nb", "a \nb", "don't 's", "x" * 3000, "é" * 500, "🎉 ²½ 123\t4", "a\x1cb\x85c", "\n\n\n", "<|endoftext|>"]


def test_against_tiktoken(spark, vocabulary, peer):
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS)] + [(99, None, "extra")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = {r["doc_id"]: r for r in decode(encode(df, vocabulary), vocabulary).collect()}
    for i, t in enumerate(TEXTS):
        assert found[i]["ids"] == peer.encode_ordinary(t), repr(t)
        assert bytes(found[i]["decoded"]) == t.encode()
    assert found[99]["ids"] == [] and bytes(found[99]["decoded"]) == b""
    assert encode(df.limit(0), vocabulary).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="ab \n\t.1'sé", max_size=60))
def test_any_text(vocabulary, peer, text):
    from barflow.llm.byte_bpe import encode_batches
    import pyarrow as pa

    plain = _PLAIN.setdefault("v", vocabulary.plain())
    (found,) = encode_batches(iter([pa.array([text, text + " " + text])]), plain)
    assert found.to_pylist() == [peer.encode_ordinary(text), peer.encode_ordinary(text + " " + text)]


_PLAIN = {}


def test_memory_bound_changes_nothing(vocabulary, peer, monkeypatch):
    import pyarrow as pa

    from barflow.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "REMEMBERED_BYTES", 900)
    monkeypatch.setattr(byte_bpe, "STEP", 4)
    texts = [f"word{i} other{i * 7} the end" for i in range(40)]
    (found,) = byte_bpe.encode_batches(iter([pa.array(texts)]), vocabulary.plain())
    assert found.to_pylist() == [peer.encode_ordinary(t) for t in texts]


def test_one_step_in_small_lots_equals_two(spark, vocabulary, monkeypatch):
    from barflow.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "BATCH_BYTES", 20)
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate([*TEXTS, None, *TEXTS])], "doc_id bigint, text string, decoded int")
    one = {r["doc_id"]: r for r in encode(df, vocabulary, decoded="decoded").collect()}
    two = {r["doc_id"]: r for r in decode(encode(df, vocabulary), vocabulary).collect()}
    assert one == two and len(one) == df.count()
    assert encode(df.limit(0), vocabulary, decoded="decoded").count() == 0


def test_bad_input(spark, vocabulary):
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode(spark.createDataFrame([([60_000],)], "ids array<int>"), vocabulary).collect()
    with pytest.raises(ValueError):
        Encoder([b"a"], ".+", [-1], [0]).merge(b"bc")


def test_null_ids_decode_to_null(spark, vocabulary):
    df = spark.createDataFrame([([1],), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in decode(df, vocabulary).collect()] == [b'"', None, b""]


def test_query(spark, small, peer):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(os.path.join(small, "documents.parquet")).collect()}
    found = LLM_QUERIES["op3_byte_bpe"](spark, small).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = peer.encode_ordinary(docs[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()


def test_a_word_of_one_pre_token_is_remembered_once(vocabulary, peer):
    """It was kept twice, as a word and as a pre-token, which took twice the memory."""
    import pyarrow as pa

    from barflow.llm import byte_bpe

    held = vocabulary.plain()
    texts = ["start " + " ".join(f"word{chr(97 + i)}" for i in range(20)), "start wordc, wordd. don't 12345 wordc"]
    (got,) = byte_bpe.encode_batches(iter([pa.array(texts)]), held)
    assert got.to_pylist() == [peer.encode_ordinary(t) for t in texts]
    memory = held["memory"]
    assert len(memory) >= 20 and not any(f" {word}" in memory.pieces for word in memory)


def test_short_pre_tokens_without_a_heap(vocabulary, peer, monkeypatch):
    """Pre-tokens of a few bytes went through the heap, and plain words through the pattern, which took op3 over its budget."""
    import random

    import pyarrow as pa

    from barflow.llm import byte_bpe

    rng = random.Random(3)
    encoder = Encoder(*(vocabulary.plain()[k] for k in ("tokens", "pattern", "shift", "owner", "seed")))
    for alphabet in ("ab", "thereinaton", "aé漢🙂 "):
        for _ in range(200):
            piece = "".join(rng.choices(alphabet, k=rng.randint(1, 60))).encode()
            assert encoder.merge_short(piece) == encoder.merge(piece)
    with pytest.raises(ValueError):
        Encoder([b"a"], ".+", [-1], [0]).merge_short(b"bc")
    monkeypatch.setattr(Encoder, "merge", lambda *a: 1 / 0)
    monkeypatch.setattr(byte_bpe, "REMEMBERED_BYTES", 4000)
    texts = [" ".join(rng.choice(["don't", "it's.", "Ünd,", "x1,", "thstinnt", "Onhalyti,", "'s,", ",", "é.", "a..", "a,b", "ſ's"]) for _ in range(80)) for _ in range(30)]
    (got,) = byte_bpe.encode_batches(iter([pa.array(texts)]), vocabulary.plain())
    assert got.to_pylist() == [peer.encode_ordinary(t) for t in texts]
