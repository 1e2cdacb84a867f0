"""Registered queries of the subpackage against their SQL, and the pipeline."""

import hashlib
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from barflow.llm.queries import LLM_ORACLES, LLM_QUERIES
from barflow.llm.toxicity import train
from test_minhash import _brute
from test_mixing import WORD, _fill
from test_toxicity import severity_by_hand

TABLES = ("documents", "labels", "pages", "embeddings", "conversations")


def _plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    df = LLM_QUERIES[name](spark, small)
    found = con.execute(LLM_ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(tuple(_plain(r[c]) for c in sorted(columns)) for r in df.collect())
    at = [columns.index(c) for c in sorted(columns)]
    assert got == sorted(tuple(_plain(r[i]) for i in at) for r in found.fetchall())


def test_one_query_per_operator():
    for n in range(1, 14):
        assert len([q for q in LLM_QUERIES if q.startswith(f"op{n}_")]) == 1
    assert LLM_QUERIES.keys() <= entry_points.queries().keys() and "pipeline" in entry_points.queries()


def test_pipeline_stage_by_stage(spark, small):
    """Every stage against a plain reckoning over the rows that the stage before it left."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, small).cache()
        kept[name] = docs.count()
        if name != "byte_bpe":
            assert docs.columns == columns
        if name == "toxicity":
            model = train(before, spark.read.parquet(f"{small}/labels.parquet"))
            clean = [r["doc_id"] for r in before.collect() if severity_by_hand(model, r["text"])[1] == 0]
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(clean)
        if name == "exact_dedup":
            last = {}
            for r in before.collect():
                last[r["text"] or ""] = max(r["doc_id"], last.get(r["text"] or "", r["doc_id"]))
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(last.values())
        if name == "near_dedup":
            expected = [i for i, _, _, stays in _brute([(r["doc_id"], r["text"]) for r in before.collect()], 80) if stays]
            assert sorted(r["doc_id"] for r in docs.collect()) == expected
        if name == "mixing":
            rows = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in before.collect()]
            sizes = Counter()
            for _, source, size in rows:
                sizes[source] += size
            aims = _fill(sizes)
            expected = Counter()
            for source, aim in aims.items():
                mark = int(hashlib.md5(("mix/" + ("null" if source is None else f"={source}")).encode()).hexdigest()[:8], 16) / 4294967296
                rate = aim / sizes[source] if sizes[source] else 0.0
                own = sorted((size, i) for i, s, size in rows if s == source)
                for place, (size, i) in enumerate(own, 1):
                    copies = math.floor(mark + place * rate) - math.floor(mark + (place - 1) * rate)
                    expected[i] += copies if size else 1
            assert Counter(r["doc_id"] for r in docs.collect()) == +expected
        if name == "byte_bpe":
            texts = {r["doc_id"]: r["text"] for r in before.collect()}
            for r in docs.collect():
                assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
                assert r["n_tokens"] == len(r["ids"])
    assert kept["toxicity"] >= 0.8 * spark.read.parquet(f"{small}/documents.parquet").count()
    assert kept["byte_bpe"] == kept["mixing"]


def test_pipeline_keeps_rows_without_id_and_extra_columns(spark, docs_of):
    docs = docs_of([(1, "a b c d e f"), (1, "a b c d e f"), (None, "g h"), (3, "A b c d e f"), (4, None)])
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, "")
        assert {"node", "rank", "size"} <= set(docs.columns)
        assert {r["size"] for r in docs.collect()} <= {6} and {r["keep_id"] for r in docs.collect()} <= {3}
    # A document without words adds nothing to the mix and stays as it is.
    assert {r["doc_id"] for r in docs.collect()} <= {1, None, 4} and [r["doc_id"] for r in docs.collect()].count(4) == 1


def test_pipeline_runs(spark, small):
    found = corpus_pipeline.run(spark, small)
    assert found.count() > 0 and {"doc_id", "ids", "n_tokens"} <= set(found.columns)
