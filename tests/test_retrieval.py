import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.functions import vectors as V
from barflow.operators import cells as C
from barflow.operators import retrieval as R
from barflow.operators import tokens


def _vectors(spark, matrix, key):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], f"{key} bigint, vec array<float>")


def _brute(docs, queries, k, metric):
    d = docs / np.where(np.linalg.norm(docs, axis=1, keepdims=True) == 0, 1, np.linalg.norm(docs, axis=1, keepdims=True))
    q = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    out = {}
    for i, row in enumerate(q):
        s = np.round(d @ row, 9) if metric == "cosine" else np.round(((d - row) ** 2).sum(1), 9)
        order = sorted(range(len(d)), key=lambda j: (-s[j] if metric == "cosine" else s[j], j))[:k]
        out[i] = [(j, s[j]) for j in order]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    docs = rng.normal(size=(300, 8)).astype(np.float32)
    docs[100:200] = docs[0]  # a third of the documents are copies
    docs[250] = 0
    queries = rng.normal(size=(7, 8)).astype(np.float32)
    queries[0] = docs[0]
    return docs, queries, _vectors(spark, docs, "doc_id").repartition(5), _vectors(spark, queries, "query_id")


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("cells", [1, 5, 64])
def test_search_equals_brute_force(data, metric, cells, monkeypatch):
    monkeypatch.setattr(C, "TILE_DOCS", 40)
    monkeypatch.setattr(C, "TILE_QUERIES", 3)
    monkeypatch.setattr(C, "SCORED_AT_ONCE", 2)
    docs, queries, d, q = data
    got = R.search_flat(d, q, 6, metric, cells=cells).toPandas().sort_values(["query_id", "rank"])
    for i, want in _brute(docs.astype(float), queries.astype(float), 6, metric).items():
        part = got[got.query_id == i]
        assert part.doc_id.tolist() == [j for j, _ in want]
        np.testing.assert_allclose(part.score, [s for _, s in want], atol=1e-6)


def test_fewer_documents_than_k_and_no_queries(data, spark):
    _, _, d, q = data
    few = R.search_flat(d.where("doc_id < 3"), q, 5)
    assert few.groupBy("query_id").count().select("count").distinct().first()[0] == 3
    assert R.search_flat(d, q.where("query_id < 0"), 5).count() == 0
    assert R.search_flat(d.where("doc_id < 0"), q, 5).count() == 0


def test_probing_all_cells_is_exact_and_few_cells_recall_most(data, monkeypatch):
    monkeypatch.setattr(C, "TILE_DOCS", 40)
    _, _, d, q = data
    cells, centroids = R.train_cells(d, 6, iterations=5)
    exact = R.search_flat(d, q, 5, "l2").toPandas()
    full = R.search_ivf(cells, centroids, q, 5, probes=6).toPandas()
    key = ["query_id", "rank"]
    pd.testing.assert_frame_equal(exact.sort_values(key).reset_index(drop=True), full.sort_values(key).reset_index(drop=True))
    some = R.search_ivf(cells, centroids, q, 5, probes=3).toPandas()
    hits = set(zip(exact.query_id, exact.doc_id)) & set(zip(some.query_id, some.doc_id))
    assert len(hits) >= len(exact) * 0.5


def test_unknown_metric_and_method(data):
    _, _, d, q = data
    with pytest.raises(ValueError):
        R.search(d, q, metric="manhattan")
    with pytest.raises(ValueError):
        R.search(d, q, method="tree")


def test_normalisation_keeps_zero_vectors(spark):
    df = _vectors(spark, [[3, 4], [0, 0]], "doc_id")
    rows = [r[0] for r in df.orderBy("doc_id").select(V.l2_normalize("vec")).collect()]
    np.testing.assert_allclose(rows, [[0.6, 0.8], [0, 0]], rtol=1e-6)


def test_embeddings(spark):
    df = spark.createDataFrame([("a b a",), ("",), (None,), ("B a",)], "text string")
    rows = [np.array(r[0]) for r in df.select(V.hash_embedding("text", 32)).collect()]
    assert np.isclose(np.linalg.norm(rows[0]), 1) and np.isclose(sorted(rows[0])[-1], 2 / 5**0.5)
    assert not rows[1].any() and not rows[2].any()
    assert np.count_nonzero(rows[3]) == 2
    own = df.select(V.custom_embedding("text", lambda ts: np.array([[len(t), 1.0] for t in ts]))).collect()
    assert [r[0][0] for r in own] == [5.0, 0.0, 0.0, 3.0]


def test_added_documents_get_new_ids(spark, tmp_path):
    path = str(tmp_path / "collection")
    docs = spark.createDataFrame([("one",), ("two",)], "text string")
    embed = lambda c: V.hash_embedding(c, 8)
    assert R.add_documents(spark, path, docs.where("text = 'one'").coalesce(1), embed) == 0
    assert R.add_documents(spark, path, docs.coalesce(1), embed) == 1
    assert R.add_documents(spark, path, docs.where("text = ''"), embed) > 1
    table = spark.read.parquet(path)
    assert table.count() == table.select("doc_id").distinct().count() == 3
    assert table.where("size(metadata) = 0").count() == 3


def test_documents_from_news_and_fundamentals(spark):
    news = spark.createDataFrame([("a", "2024-01-01", "t", None, "s", 0.5)], "symbol string, date string, title string, content string, source string, sentiment double")
    row = R.news_documents(news).first()
    assert row["text"] == "t " and row["metadata"]["type"] == "news" and row["metadata"]["sentiment"] == "0.5"
    f = spark.createDataFrame([("a", "tech", None, 1.5, None, 0.1)], "symbol string, sector string, industry string, market_cap double, pe_ratio double, revenue_growth double")
    assert R.fundamental_documents(f).first()["text"] == (
        "Symbol: a Sector: tech Industry:  Market Cap: 1.5 P/E Ratio:  Revenue Growth: 0.1"
    )


@pytest.mark.parametrize("length", [0, 1, 10, 11, 16, 17, 100])
def test_chunks_cover_the_whole_text(spark, length):
    text = "".join(chr(97 + i % 26) for i in range(length))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    chunks = [r["text"] for r in R.chunk_text(df, 10, 4).orderBy("chunk").collect()]
    joined = chunks[0] + "".join(c[4:] for c in chunks[1:])
    assert joined == text and all(len(c) <= 10 for c in chunks)
    with pytest.raises(ValueError):
        R.chunk_text(df, 4, 4)


def test_headers_and_footers_go_but_inner_lines_stay(spark):
    rows = [(i, "s", f"Header\nbody {i}  x\nHeader\nFoot") for i in range(4)] + [(9, "t", "Header\nonly")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = {r["doc_id"]: r["text"] for r in R.clean_documents(df, 0.5).collect()}
    assert got[0] == "body 0 x Header" and got[9] == "Header only"


def test_context_budget_threshold_and_text(spark):
    rows = [(1, 1, "aaaa", 0.9), (1, 2, "bbb", 0.8), (1, 3, "c", 0.1), (2, 1, "too long", 0.7)]
    hits = spark.createDataFrame(rows, "query_id bigint, rank int, text string, score double")
    kept = R.within_budget(hits, 7)
    assert {(r["query_id"], r["rank"]) for r in kept.collect()} == {(1, 1), (1, 2)}
    assert {r["query_id"]: r["context"] for r in R.context_text(hits).collect()} == {1: "aaaa bbb c", 2: "too long"}
    assert R.above_threshold(hits, 0.7).count() == 3


def test_contexts_for_all_samples(spark):
    docs = spark.createDataFrame([(1, "a 2024 news", {}), (2, "other words", {})], "doc_id bigint, text string, metadata map<string,string>")
    docs = docs.withColumn("vec", V.hash_embedding("text", 256))
    samples = spark.createDataFrame([(5, "a", "2024")], "sample_id bigint, symbol string, date string")
    assert R.retrieve_contexts(samples, docs, 1, 256).first()["context"] == "a 2024 news"
    assert R.retrieve_contexts(samples, docs.where("doc_id > 9"), 1, 256).first()["context"] == ""


def test_index_round_trip_and_stats(data, spark, tmp_path):
    _, _, d, q = data
    R.save_index(d.withColumn("cell", (F.col("doc_id") % 3).cast("int")), str(tmp_path / "i"), {"metric": "l2"})
    docs, config = R.load_index(spark, str(tmp_path / "i"))
    assert config.first()["config"] == {"metric": "l2"} and docs.count() == 300
    assert docs.where("cell = 1").count() == 100
    assert R.index_stats(docs).first()["embedding_dim"] == 8


def test_tokens_are_truncated_padded_and_unknown_words_marked(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "c a b b a"), (3, ""), (4, None)], "id bigint, text string")
    vocab = tokens.vocabulary(df, "text", 2)
    assert {r["token"]: r["token_id"] for r in vocab.collect()} == {"a": 2, "b": 3}
    got = {r["id"]: (r["input_ids"], r["attention_mask"]) for r in tokens.tokenize(df, "id", "text", vocab, 4).collect()}
    assert got[1] == ([2, 3, 2, 0], [1, 1, 1, 0])
    assert got[2] == ([1, 2, 3, 3], [1, 1, 1, 1])
    assert got[3] == got[4] == ([0, 0, 0, 0], [0, 0, 0, 0])


def test_bounds_prune_cells_and_lose_nothing(spark):
    """Clustered vectors: most cells are out of reach after the first round, and the result is that of brute force."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 6))
    docs = (centres[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 6)) * 0.02).astype(np.float32)
    queries = docs[::100] + np.float32(0.001)
    queries[3] = 0
    d, q = _vectors(spark, docs, "doc_id"), _vectors(spark, queries, "query_id")
    cells = C.cut_cells(d, 40)
    met = []
    real = C.meet
    C.meet = lambda docs, visits, k, metric: met.append(visits.count()) or real(docs, visits, k, metric)
    try:
        for metric in ("cosine", "l2"):
            got = C.search_exact(cells, q, 5, metric).toPandas().sort_values(["query_id", "rank"])
            unit = np.where(np.linalg.norm(queries, axis=1, keepdims=True) == 0, 1, np.linalg.norm(queries, axis=1, keepdims=True))
            for i, want in _brute(docs.astype(float), queries.astype(float) / unit + (0 if metric else 0), 5, metric).items():
                if i == 3:  # a zero query is as near to all
                    continue
                assert got[got.query_id == i].doc_id.tolist() == [j for j, _ in want]
    finally:
        C.meet = real
    assert sum(met) < 0.5 * 2 * len(queries) * len(cells.centres)
    plan = C.search_exact(cells, q, 5)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_an_index_grows_is_idempotent_and_prunes(data, spark, tmp_path):
    _, _, d, q = data
    path = str(tmp_path / "grown")
    C.create_index(spark, path, C.sample_centres(d, 10), {"metric": "cosine"}, V.fit_idf(spark.createDataFrame([("a b",)], "text string"), dim=8))
    with pytest.raises(ValueError):
        C.open_index(spark, path)
    assert C.append_documents(spark, path, d.where("doc_id < 90"), "one")
    assert C.open_index(spark, path).counts.sum() == 90
    # Files of an attempt that was never committed are not seen, and are replaced when it is made again.
    left_over = C.nearest_centre(d.where("doc_id >= 90 AND doc_id < 120"), C.open_index(spark, path).centres)
    left_over.write.partitionBy("cell").parquet(f"{path}/docs/batch=two")
    assert C.index_documents(spark, path).count() == 90
    assert C.append_documents(spark, path, d.where("doc_id >= 90"), "two")
    assert not C.append_documents(spark, path, d, "two")
    index = C.open_index(spark, path)
    assert index.counts.sum() == 300 == C.index_documents(spark, path).count()
    key = ["query_id", "rank"]
    want = R.search_flat(d, q, 5).toPandas().sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(C.search_exact(index, q, 5).toPandas().sort_values(key).reset_index(drop=True), want)
    full = C.search_probed(index, q, 5, len(index.centres), "cosine").toPandas().sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(full, want)
    plan = index.docs.where(F.col("cell").isin(1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert C.index_idf(spark, path).count() == 8


def test_recall_of_four_of_ten_cells(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").selectExpr("vec_id AS doc_id", "embedding AS vec").cache()
    q = e.where("doc_id % 10 = 0").selectExpr("doc_id AS query_id", "vec")
    cells, centroids = R.train_cells(e, 10)
    exact = {(r[0], r[2]) for r in R.search_flat(e, q, 5, "l2").collect()}
    some = {(r[0], r[2]) for r in R.search_ivf(cells, centroids, q, 5, probes=4).collect()}
    assert len(exact & some) >= 0.6 * len(exact), len(exact & some) / len(exact)


def test_idf_and_weights(spark):
    df = spark.createDataFrame([("a b a",), ("a",), (None,), ("",)], "text string")
    idf = {r["bucket"]: (r["texts"], r["idf"]) for r in V.fit_idf(df, dim=16).collect()}
    assert len(idf) == 16 and sorted(t for t, _ in idf.values())[-2:] == [1, 2]
    weights = V.idf_weights(V.fit_idf(df, dim=16))
    assert np.isclose(max(weights), np.log(5)) and np.isclose(min(weights), np.log(5 / 3))
    rows = [np.array(r[0]) for r in df.select(V.hash_embedding("text", 16, weights)).collect()]
    assert np.isclose(np.linalg.norm(rows[0]), 1) and not rows[2].any()
    assert np.isclose(sorted(rows[0])[-1], 2 * np.log(5 / 3) / np.hypot(2 * np.log(5 / 3), np.log(5 / 2)), atol=1e-6)
    with pytest.raises(ValueError):
        V.hash_embedding("text", 16, [1.0])


def test_embedding_in_doubles_hashes_words_once_per_text(spark, small):
    from barflow.plans import QUERIES

    docs = spark.createDataFrame([(1, "one two two"), (2, ""), (3, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["v"] for r in docs.select("doc_id", V.hash_embedding("text", 8, kind="double").alias("v")).collect()}
    assert sorted(x for x in got[1] if x) in ([1 / 5**0.5, 2 / 5**0.5], [1.0]) and not any(got[2]) and not any(got[3])
    plan = QUERIES["h04_idf_embedding"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1 and "posexplode" not in plan


def test_texts_are_embedded_once_per_search(spark, tmp_path):
    """The centres and the cells read stored vectors."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<float>")
    def embed(i):
        seen.add(1)
        return [float(i % 7), 1.0]

    docs = spark.range(50).select(F.col("id").alias("doc_id"), embed.asNondeterministic()("id").alias("vec"))
    queries = spark.createDataFrame([(0, [1.0, 1.0])], "query_id bigint, vec array<float>")
    assert R.search_flat(docs, queries, 3).count() == 3
    assert seen.value == 50
