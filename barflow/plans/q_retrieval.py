"""Registered queries: documents, vector search, context."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from barflow.functions.vectors import custom_embedding, embed_buckets, fit_idf, hash_embedding, idf_weights, l2_norm, l2_normalize, word_buckets
from barflow.operators import cells as C
from barflow.operators import retrieval as R
from barflow.plans import inputs as I
from barflow.plans.inputs import sql
from barflow.plans.registry import query
from barflow.session import materialize, shared_dir

DIM = 64
# Scores of hashed texts are compared at this many digits.
TEXT_DIGITS = 5


def _metadata(df, *keys):
    return df.select("text", *[F.col("metadata")[k].alias(k) for k in keys])


@query(
    "h01_news_documents",
    sql("SELECT title || ' ' || content AS text, symbol, CAST(date AS VARCHAR) AS date, source, CAST(sentiment AS VARCHAR) "
        "AS sentiment, 'news' AS type FROM news", "news"),
)
def news_documents(spark, folder):
    return _metadata(R.news_documents(I.news(spark, folder)), "symbol", "date", "source", "sentiment", "type")


_FUND_TEXT = (
    "'Symbol: ' || symbol || ' Sector: ' || sector || ' Industry: ' || industry || ' Market Cap: ' || CAST(market_cap AS VARCHAR) "
    "|| ' P/E Ratio: ' || coalesce(CAST(pe_ratio AS VARCHAR), '') || ' Revenue Growth: ' || coalesce(CAST(revenue_growth AS VARCHAR), '')"
)


@query(
    "h02_fundamental_documents",
    sql(f"SELECT {_FUND_TEXT} AS text, symbol, sector, industry, 'fundamental' AS type FROM fundamentals", "fundamentals"),
)
def fundamental_documents(spark, folder):
    return _metadata(R.fundamental_documents(I.fundamentals(spark, folder)), "symbol", "sector", "industry", "type")


@query(
    "h03_add_documents",
    sql("SELECT 'news' AS type, count(*) AS docs, count(*) AS ids, 0::BIGINT AS first_id, count(*) - 1 AS last_id, 2::BIGINT AS batches FROM news "
        "UNION ALL SELECT 'fundamental', count(*), count(*), (SELECT count(*) FROM news), (SELECT count(*) FROM news) + count(*) - 1, 2 "
        "FROM fundamentals", "news", "fundamentals"),
)
def add_documents(spark, folder):
    """Two batches into one collection; ids have no gaps and go on from one batch to the next."""
    path = f"{shared_dir(spark)}/collection-{uuid.uuid4().hex}"
    first = R.add_documents(spark, path, R.news_documents(I.news(spark, folder)), lambda c: hash_embedding(c, DIM))
    second = R.add_documents(
        spark, path, R.fundamental_documents(I.fundamentals(spark, folder)), lambda c: hash_embedding(c, DIM)
    )
    table = spark.read.parquet(path)
    batch = F.when(F.col("doc_id") < second, first).otherwise(second)
    groups = table.groupBy(F.col("metadata")["type"].alias("type")).agg(
        F.count(F.lit(1)).alias("docs"), F.countDistinct("doc_id").alias("ids"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
    )
    return groups.withColumn("batches", table.agg(F.countDistinct(batch)).scalar())


_BUCKET = f"('0x' || substr(md5(w), 1, 8))::BIGINT % {DIM}"
_WORDS = "regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')"


def _hashed(source: str, key: str, text: str) -> dict[str, str]:
    """Sparse unit vectors (key, bucket, x) of the texts of a table."""
    return {
        f"{source}_tf": f"SELECT {key} AS id, {_BUCKET} AS bucket, count(*) AS tf FROM (SELECT {key}, "
        f"unnest({_WORDS.format(text=text)}) AS w FROM {source}) GROUP BY 1, 2",
        f"{source}_vec": f"SELECT id, bucket, tf / sqrt(sum(tf * tf) OVER (PARTITION BY id)) AS x FROM {source}_tf",
    }


def _entries(docs, weights=None):
    """One row per bucket that occurs in a text. Words are hashed once per text, and only these buckets' numbers become rows."""
    texts = docs.select("doc_id", word_buckets("text", DIM).alias("words"))
    vectors = texts.select("doc_id", F.array_distinct("words").alias("own"), embed_buckets("words", DIM, weights, "double").alias("vec"))
    vec = F.col("vec")
    rows = vectors.select("doc_id", F.explode(F.transform("own", lambda b: F.struct(b.alias("bucket"), vec[b].alias("x")))).alias("e"))
    return rows.select("doc_id", F.col("e.bucket").cast("bigint").alias("bucket"), I.rounded("e.x", 4).alias("x"))


@query(
    "h04_hash_embedding",
    sql("SELECT id AS doc_id, bucket, round(x, 4) AS x FROM documents_vec", extra=_hashed("documents", "doc_id", "text")),
)
def embed_text(spark, folder):
    return _entries(I.documents(spark, folder))


_IDF = {
    **_hashed("documents", "doc_id", "text"),
    "df": "SELECT bucket, count(*) AS texts FROM documents_tf GROUP BY bucket",
    "idf": f"SELECT CAST(b AS INT) AS bucket, coalesce(texts, 0) AS texts, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (coalesce(texts, 0) + 1)) "
    f"AS idf FROM (SELECT unnest(range({DIM})) AS b) LEFT JOIN df ON b = bucket",
    "weighted": "SELECT id, t.bucket, tf * idf AS w FROM documents_tf t JOIN idf USING (bucket)",
}


@query("h04_fit_idf", sql("SELECT bucket, texts, round(idf, 9) AS idf FROM idf", extra=_IDF))
def fit_weights(spark, folder):
    return fit_idf(I.documents(spark, folder), dim=DIM).withColumn("idf", F.round("idf", 9))


@query(
    "h04_idf_embedding",
    sql("SELECT id AS doc_id, bucket, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 4) AS x FROM weighted", extra=_IDF),
)
def embed_weighted(spark, folder):
    docs = I.documents(spark, folder)
    return _entries(docs, idf_weights(fit_idf(docs, dim=DIM)))


def _letters(texts):
    """An encoder of one's own: code points, blanks and digits of a text."""
    return np.array([[len(t), t.count(" "), sum(c in "0123456789" for c in t)] for t in texts], dtype=np.float64)


@query(
    "h04_custom_embedding",
    "SELECT doc_id, length(coalesce(text, '')) AS chars, len(regexp_extract_all(coalesce(text, ''), ' ')) AS blanks, "
    "len(regexp_extract_all(coalesce(text, ''), '[0-9]')) AS digits FROM documents",
)
def embed_custom(spark, folder):
    vec = I.documents(spark, folder).select("doc_id", custom_embedding("text", _letters).alias("v"))
    return vec.select("doc_id", *[F.col("v")[i].cast("bigint").alias(c) for i, c in enumerate(("chars", "blanks", "digits"))])


@query(
    "h04_word_buckets",
    sql("SELECT id AS doc_id, bucket, tf FROM documents_tf", extra=_hashed("documents", "doc_id", "text")),
)
def bucket_counts(spark, folder):
    docs = I.documents(spark, folder)
    words = docs.select("doc_id", F.explode(word_buckets("text", DIM)).alias("bucket"))
    return words.groupBy("doc_id", F.col("bucket").cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).alias("tf"))


@query(
    "h05_l2_normalize",
    sql("SELECT doc_id, round(3 * vec[1] / sqrt(9 * list_dot_product(vec, vec)), 4) AS first, "
        "1.0::DOUBLE AS norm FROM vectors", "vectors"),
)
def normalize_vectors(spark, folder):
    scaled = I.vectors(spark, folder).withColumn("vec", F.transform("vec", lambda x: (x * 3).cast("float")))
    unit = scaled.withColumn("vec", l2_normalize("vec"))
    return unit.select("doc_id", F.round(F.col("vec")[0].cast("double"), 4).alias("first"), F.round(l2_norm("vec"), 4).alias("norm"))


_UNIT = "list_dot_product(d.vec, q.vec) / sqrt(list_dot_product(d.vec, d.vec) * list_dot_product(q.vec, q.vec))"


def _topk(metric: str, k: int = 5) -> str:
    score = f"round({_UNIT}, 10)" if metric == "cosine" else f"round(greatest(2 - 2 * {_UNIT}, 0), 10)"
    order = "DESC" if metric == "cosine" else "ASC"
    return sql(
        f"SELECT query_id, rank, doc_id, round(score, 6) AS score FROM (SELECT query_id, doc_id, {score} AS score, "
        f"CAST(row_number() OVER (PARTITION BY query_id ORDER BY {score} {order}, doc_id) AS INT) AS rank "
        f"FROM vectors d, vector_queries q) WHERE rank <= {k}",
        "vector_queries",
    )


def _rounded(hits, digits=6):
    return hits.withColumn("score", F.round("score", digits))


@query("h06_search_cosine", _topk("cosine"))
def search_cosine(spark, folder):
    return _rounded(R.search_flat(I.vectors(spark, folder), I.vector_queries(spark, folder)))


@query("h06_search_cosine_blocks", _topk("cosine"))
def search_cosine_blocks(spark, folder):
    """The same search over a few large cells."""
    return _rounded(R.search_flat(I.vectors(spark, folder), I.vector_queries(spark, folder), cells=3))


@query("h07_search_l2", _topk("l2"))
def search_l2(spark, folder):
    return _rounded(R.search_flat(I.vectors(spark, folder), I.vector_queries(spark, folder), metric="l2"))


_APART = "greatest(2 - 2 * list_dot_product(a.vec, b.vec) / sqrt(list_dot_product(a.vec, a.vec) * list_dot_product(b.vec, b.vec)), 0)"
_CELLED = {
    "centres": "SELECT CAST(row_number() OVER (ORDER BY query_id) - 1 AS INT) AS cell, vec FROM vector_queries",
    "in_cell": f"SELECT a.doc_id, a.vec, min(struct_pack(far := round(sqrt({_APART}), 8), cell := b.cell)).cell AS cell FROM vectors a, centres b GROUP BY ALL",
    "probed": f"SELECT query_id, b.cell, row_number() OVER (PARTITION BY query_id ORDER BY round(sqrt({_APART}), 8), b.cell) AS turn "
    "FROM vector_queries a, centres b",
    "hits": f"SELECT query_id, doc_id, round(greatest(2 - 2 * {_UNIT}, 0), 10) AS score FROM in_cell d JOIN probed USING (cell) "
    "JOIN vector_queries q USING (query_id) WHERE turn <= 4",
}


@query(
    "h08_search_ivf",
    sql(
        "SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, doc_id) AS INT) AS rank, doc_id, round(score, 6) AS score "
        "FROM hits QUALIFY rank <= 5",
        "vector_queries", extra=_CELLED,
    ),
)
def search_ivf(spark, folder):
    """Four of the cells around the label means, which are the queries too."""
    queries = I.vector_queries(spark, folder)
    cell = F.row_number().over(Window.orderBy("query_id")) - 1
    centroids = materialize(queries.select(cell.cast("int").alias("cell"), "vec"))
    cells = R.assign_cells(I.vectors(spark, folder), centroids)
    return _rounded(R.search_ivf(cells, centroids, queries, probes=4))


@query("h08_ivf_all_cells_is_exact", _topk("l2"))
def ivf_all_cells(spark, folder):
    """Probing every cell must give the exact result."""
    cells, centroids = R.train_cells(I.vectors(spark, folder), 10, iterations=3)
    return _rounded(R.search_ivf(cells, centroids, I.vector_queries(spark, folder), probes=10))


@query("h09_persistent_store", _topk("l2"))
def persistent_store(spark, folder):
    path = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    R.save_index(I.vectors(spark, folder), path, {"vector_store": "persistent", "metric": "l2"})
    stored, _ = R.load_index(spark, path)
    return _rounded(R.search(stored, I.vector_queries(spark, folder), metric="l2"))


@query("a10_append_and_search", _topk("cosine"))
def append_and_search(spark, folder):
    """An index that is created, gets two batches, one of them twice, and is searched exactly after loading."""
    path = f"{shared_dir(spark)}/grown-{uuid.uuid4().hex}"
    vectors = I.vectors(spark, folder)
    C.create_index(spark, path, C.sample_centres(vectors, 12), {"metric": "cosine"})
    for batch, part in (("even", "label % 2 = 0"), ("odd", "label % 2 <> 0 OR label IS NULL"), ("even", "label % 2 = 0")):
        C.append_documents(spark, path, vectors.where(part), batch)
    return _rounded(C.search_exact(C.open_index(spark, path), I.vector_queries(spark, folder), 5))


@query("h10_search_dispatch", _topk("cosine", 3))
def search_dispatch(spark, folder):
    return _rounded(R.search(I.vectors(spark, folder), I.vector_queries(spark, folder), 3, "flat", "cosine"))


@query(
    "a10_save_and_load_index",
    sql("SELECT doc_id, label, 'flat' AS store FROM vectors", "vectors"),
)
def save_and_load(spark, folder):
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    R.save_index(I.vectors(spark, folder), path, {"vector_store": "flat"})
    docs, config = R.load_index(spark, path)
    store = config.select(F.col("config")["vector_store"]).scalar()
    return docs.select("doc_id", "label", store.alias("store"))


# --- text search and context ---------------------------------------------------------------------

def _news_vectors(spark, folder):
    """News as documents under their given ids."""
    return I.news(spark, folder).select(
        "doc_id",
        F.col("content").alias("text"),
        hash_embedding("content", DIM).alias("vec"),
        F.create_map(F.lit("symbol"), F.col("symbol")).alias("metadata"),
    )


def _samples(spark, folder):
    b = I.bars_1d(spark, folder).select("symbol", "date", "Close")
    slot = F.array_position(F.array(*[F.lit(s) for s in I.EVENT_SYMBOLS]), F.col("symbol"))
    return b.withColumn("sample_id", slot * 1000 + F.dayofmonth("date"))


_SAMPLE_ID = "list_position(['click','error','purchase','signup','view'], symbol) * 1000 + day(date)"
_SAMPLES = {
    "samples": f"SELECT symbol, date, {_SAMPLE_ID} AS sample_id, "
    "symbol || ' ' || CAST(date AS VARCHAR) || ' financial data' AS text FROM bars_1d"
}


@query(
    "h11_best_scores_of_samples",
    sql(
        f"SELECT sample_id, round(score, {TEXT_DIGITS - 1}) AS score FROM (SELECT query_id AS sample_id, score, row_number() OVER (PARTITION BY query_id "
        "ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank = 1",
        "news", "bars_1d",
        extra={
            **_SAMPLES, **_hashed("news", "doc_id", "content"), **_hashed("samples", "sample_id", "text"),
            "scores": "SELECT q.id AS query_id, d.id AS doc_id, sum(q.x * d.x) AS score FROM news_vec d JOIN samples_vec q USING (bucket) GROUP BY 1, 2",
        },
    ),
)
def best_scores(spark, folder):
    """Best similarity found for the query text of every bar, in one batch search."""
    docs = _news_vectors(spark, folder)
    queries = _samples(spark, folder).select(F.col("sample_id").alias("query_id"), R.retrieval_query().alias("text"))
    hits = R.search_text(docs, queries, 1, lambda c: hash_embedding(c, DIM))
    return hits.select(F.col("query_id").alias("sample_id"), F.round("score", TEXT_DIGITS - 1).alias("score"))


@query("h11_contexts_of_samples")
def contexts_of_samples(spark, folder):
    """Bars with the joined texts of their best documents."""
    return R.retrieve_contexts(_samples(spark, folder), _news_vectors(spark, folder), 3, DIM)


@query(
    "h12_index_stats",
    sql("SELECT count(*) AS total_documents, 'flat' AS vector_store_type, 'given' AS embedding_model, "
        "CAST(max(len(vec)) AS INT) AS embedding_dim, count(vec) AS index_size FROM vectors", "vectors"),
)
def index_stats(spark, folder):
    return R.index_stats(I.vectors(spark, folder), "flat", "given")


_THRESHOLD = 0.3


@query(
    "h13_similarity_threshold",
    f"SELECT * FROM ({_topk('cosine', 20)}) WHERE score >= {_THRESHOLD}",
)
def similarity_threshold(spark, folder):
    hits = _rounded(R.search_flat(I.vectors(spark, folder), I.vector_queries(spark, folder), 20))
    return R.above_threshold(hits, _THRESHOLD)


@query(
    "h14_chunk_text",
    "SELECT doc_id, CAST(pos // 462 AS INT) AS chunk, substr(text, CAST(pos AS INT) + 1, 512) AS text FROM (SELECT doc_id, text, "
    "unnest(range(0, greatest(length(text) - 50, 1), 462)) AS pos FROM documents)",
)
def chunk_text(spark, folder):
    return R.chunk_text(I.documents(spark, folder))


_EDGE = {
    "ends": "SELECT DISTINCT doc_id, source, line FROM (SELECT doc_id, source, ls[1] AS line FROM sp UNION ALL "
    "SELECT doc_id, source, ls[-1] FROM sp) WHERE trim(line) <> ''",
    "boiler": "SELECT source, line, count(*) AS n FROM ends GROUP BY 1, 2",
    "found": "SELECT source, line, n FROM boiler JOIN (SELECT source, count(*) AS docs FROM documents GROUP BY 1) USING (source) "
    "WHERE n >= 2 AND n >= docs * 0.02::DOUBLE",
}
_SPLIT = {"sp": "SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents"}


@query("h15_boilerplate_lines", sql("SELECT source, line, n FROM found", extra={**_SPLIT, **_EDGE}))
def boilerplate_lines(spark, folder):
    return R.boilerplate_lines(I.documents(spark, folder), 0.02)


@query(
    "h15_clean_documents",
    sql(
        "SELECT doc_id, trim(regexp_replace(array_to_string(list_transform(list_filter(list_zip(ls, range(len(ls))), lambda z: "
        "NOT ((z[2] < 1 OR z[2] >= len(ls) - 1) AND list_contains(coalesce(bad, []), z[1]))), lambda z: z[1]), ' '), "
        "'[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS text FROM sp LEFT JOIN (SELECT source, list(line) AS bad FROM found GROUP BY 1) USING (source)",
        extra={**_SPLIT, **_EDGE},
    ),
)
def clean_documents(spark, folder):
    return R.clean_documents(I.documents(spark, folder).select("doc_id", "source", "text"), 0.02).select("doc_id", "text")


@query(
    "h16_context_budget",
    "SELECT conv_id AS query_id, turn AS rank, used FROM (SELECT conv_id, turn, CAST(sum(length(text)) OVER (PARTITION BY conv_id "
    "ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS used FROM conversations) WHERE used <= 2048",
)
def context_budget(spark, folder):
    hits = I.table(spark, folder, "conversations").select(
        F.col("conv_id").alias("query_id"), F.col("turn").alias("rank"), "text"
    )
    return R.within_budget(hits).select("query_id", "rank", "used")
