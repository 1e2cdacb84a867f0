import base64
from collections import Counter

import public_tokenizers
import tiktoken

from barflow.llm.queries import LLM_QUERIES
from barflow.llm.token_counts import Rollup, count_tokens, revised, signed, tokenizer_version

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _counted(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, tokenizer string, tokens bigint")


def _totals(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


def test_signed_batches_commit_once(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0 and rollup.batches().count() == 0
    rows = _counted(spark, [("a", "en", "v1", 5), ("a", "en", "v1", 7), (None, "de", "v1", 2)])
    assert rollup.commit("one", signed(rows, 1)) and not rollup.commit("one", signed(rows, 1))
    assert _totals(rollup) == {("a", "en", "v1"): (2, 12), (None, "de", "v1"): (1, 2)}
    old, new = _counted(spark, [("a", "en", "v1", 5)]), _counted(spark, [("a", "en", "v2", 4)])
    assert rollup.commit("revised", revised(old, new))
    assert rollup.commit("deleted", signed(_counted(spark, [(None, "de", "v1", 2)]), -1))
    assert rollup.commit("empty", signed(_counted(spark, []), 1))
    again = Rollup(spark, str(tmp_path / "r"))
    assert _totals(again) == {("a", "en", "v1"): (1, 7), ("a", "en", "v2"): (1, 4)}
    assert sorted(r[0] for r in again.batches().collect()) == ["deleted", "empty", "one", "revised"]


def test_a_half_written_version_does_not_count(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    rows = signed(_counted(spark, [("a", "en", "v1", 5)]), 1)
    rollup.commit("one", rows)
    rows.write.parquet(str(tmp_path / "r/totals/2"))
    assert _totals(rollup) == {("a", "en", "v1"): (1, 5)}
    assert rollup.commit("two", rows) and _totals(rollup) == {("a", "en", "v1"): (2, 10)}


def test_counts_nulls_and_clashes(spark, docs_of):
    docs = docs_of([(1, "hello world"), (2, None), (3, ""), (4, "x " * 50_000)]).withColumnRenamed("token", "Tokens")
    got = {r["doc_id"]: r["tokens"] for r in count_tokens(docs, PATH, public_tokenizers.PATTERN).collect()}
    assert got == {1: 2, 2: 0, 3: 0, 4: 50_001}
    assert count_tokens(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, small):
    """Every document once, labelled ones by the second vocabulary."""
    paths = {labelled: public_tokenizers.path(f"byte_bpe_{'multi_' if labelled else ''}50k.tiktoken") for labelled in (False, True)}
    encode = {}
    for labelled, path in paths.items():
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode[labelled] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    marked = {r[0] for r in spark.read.parquet(f"{small}/labels.parquet").select("doc_id").collect()}
    expected = Counter()
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        labelled = r["doc_id"] in marked
        key = r["source"], r["lang"], tokenizer_version(paths[labelled])
        expected[(*key, "documents")] += 1
        expected[(*key, "tokens")] += len(encode[labelled](r["text"] or ""))
    found = Counter()
    for r in LLM_QUERIES["op8_token_counts"](spark, small).collect():
        for m in ("documents", "tokens"):
            found[r["source"], r["lang"], r["tokenizer"], m] += r[m]
    assert found == expected and len({k[2] for k in found}) == 2


def test_labels_of_any_number_are_joined_the_same_way(spark):
    """Few labels were broadcast and more of them shuffled with the texts, so the shuffle grew faster than the input."""
    from barflow.llm.queries import labelled_texts

    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "doc_id bigint, text string")
    found = labelled_texts(docs, spark.createDataFrame([(2,)], "doc_id bigint"))
    assert [tuple(r) for r in found.collect()] == [(2, "b")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
