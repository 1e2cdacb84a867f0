import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barflow.llm import range_coder
from barflow.llm.queries import LLM_QUERIES
from barflow.llm.range_coder import _ENTRY, Words, decode_blocks, encode_blocks, join_crc, read_ids, seal, unseal, write_ids

JSON = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 131_071) | st.integers(0, 3), min_size=1, max_size=80), min_size=1, max_size=12))
def test_round_trip(blocks):
    blocks = [np.array(b) for b in blocks]
    back = decode_blocks(encode_blocks(blocks), [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))


def test_blocks_are_independent_and_repeats_are_cheap():
    rng = np.random.default_rng(3)
    noise, cycle = rng.integers(0, 131_072, 2048), np.arange(2048) % 50
    a, b = encode_blocks([noise, cycle])
    assert encode_blocks([cycle]) == [b] and encode_blocks([noise]) == [a]
    assert len(b) < 600 and len(a) > 2048 * 1.5


def test_checksum():
    entry = np.array([(1, 0, 0, 0, 3, 1)], _ENTRY)
    block = seal(entry, b"xyz", 3)
    dirs, coded, n = unseal(block)
    assert coded == b"xyz" and n == 3 and dirs["doc"][0] == 1
    for k in (0, 10, len(block) - 1):
        with pytest.raises(ValueError):
            unseal(block[:k] + bytes([block[k] ^ 1]) + block[k + 1 :])
    with pytest.raises(ValueError):
        unseal(b"")


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_joined_checksums(a, b):
    assert join_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text(alphabet="ab \n\t.1'sé", max_size=40), max_size=6))
def test_words_equal_the_library_on_whole_texts(texts):
    if "words" not in _MADE:
        with open(JSON, encoding="utf-8") as f:
            _MADE["words"] = Words(f.read())
        _MADE["whole"] = Tokenizer.from_file(JSON)
        _MADE["whole"].encode_special_tokens = True
    expected = [e.ids for e in _MADE["whole"].encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in _MADE["words"].ids(texts)] == expected


_MADE = {}


def _expected(rows):
    whole = Tokenizer.from_file(JSON)
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files(spark, docs_of, tmp_path, monkeypatch):
    monkeypatch.setattr(range_coder, "BLOCK_IDS", 100)
    monkeypatch.setattr(range_coder, "LANES", 7)
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(60, 0, -1)] + [(500, "long ! " * 3000), (None, "no id"), (70, None)]
    path = str(tmp_path / uuid.uuid4().hex)
    with open(JSON, encoding="utf-8") as f:
        write_ids(docs_of(rows).repartition(3), f.read(), path)
    assert sorted(map(tuple, read_ids(spark, path).collect()), key=str) == sorted(_expected(rows), key=str)


def test_no_documents(spark, docs_of, tmp_path):
    with open(JSON, encoding="utf-8") as f:
        write_ids(docs_of([]), f.read(), str(tmp_path / "x"))
    assert read_ids(spark, str(tmp_path / "x")).count() == 0


def test_query(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = LLM_QUERIES["op9_token_ids"](spark, small).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == sorted(_expected(rows))


END = "<|endoftext|>"
HELD = [END, f"hello {END} you", f"a{END}b", f" {END}", f"{END} ", f"a\n{END}\nb", f"a  {END}  b", f"{END}{END} x", f"x {END[:-1]} y", f"{END} ! {END}"]


def test_literals_of_added_tokens_equal_the_untouched_library():
    whole = Tokenizer.from_file(JSON)
    with open(JSON, encoding="utf-8") as f:
        words = Words(f.read())
    expected = [whole.encode(t, add_special_tokens=False).ids for t in HELD]
    assert expected[1] == [31373, 220, 50256, 345]
    assert [x.tolist() for x in words.ids(HELD)] == expected
    plain = ["x ! y", "hello you a b"]  # after words of texts with literals are remembered
    assert [x.tolist() for x in words.ids(plain)] == [whole.encode(t, add_special_tokens=False).ids for t in plain]


def test_files_with_literals_of_added_tokens(spark, docs_of, tmp_path):
    rows = list(enumerate([*HELD, "plain text behind them"]))
    with open(JSON, encoding="utf-8") as f:
        write_ids(docs_of(rows), f.read(), str(tmp_path / "x"))
    assert sorted(map(tuple, read_ids(spark, str(tmp_path / "x")).collect())) == sorted(_expected(rows))
