"""Documents, vector top-k search, context assembly."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.functions.prompts import plain, retrieval_query
from barflow.functions.vectors import DEFAULT_DIM, hash_embedding
from barflow.operators.cells import CELLS, FIT_ROWS, Cells, checked, cut_cells, nearest_centre, search_exact, search_probed, unit
from barflow.operators.numbering import number_rows
from barflow.session import materialize
from barflow.sources.store import path_exists

TOP_K = 5
SIMILARITY_THRESHOLD = 0.7
CONTEXT_BUDGET = 2048
CHUNK_SIZE, CHUNK_OVERLAP = 512, 50
LISTS = 100
METHODS = ("flat", "ivf")

# --- documents -----------------------------------------------------------------------------------


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _metadata(columns: Sequence[str], kind: str) -> Column:
    pairs: list[Column] = []
    for c in columns:
        pairs += [F.lit(c), F.col(c).cast("string")]
    return F.create_map(*pairs, F.lit("type"), F.lit(kind))


def news_documents(news: DataFrame) -> DataFrame:
    """``(text, metadata)``: title and content; symbol, date, source and sentiment kept as metadata."""
    return news.select(
        F.concat(_text("title"), F.lit(" "), _text("content")).alias("text"),
        _metadata(["symbol", "date", "source", "sentiment"], "news").alias("metadata"),
    )


# Label and column of each part of a fundamentals text.
FUNDAMENTAL_TEXT = (
    ("Symbol", "symbol"),
    ("Sector", "sector"),
    ("Industry", "industry"),
    ("Market Cap", "market_cap"),
    ("P/E Ratio", "pe_ratio"),
    ("Revenue Growth", "revenue_growth"),
)


def fundamental_documents(fundamentals: DataFrame) -> DataFrame:
    """``(text, metadata)``: the labelled values, doubles without an exponent; symbol, sector and industry kept as metadata."""
    real = {f.name for f in fundamentals.schema if isinstance(f.dataType, T.DoubleType)}
    said = {c: F.coalesce(plain(c), F.lit("")) if c in real else _text(c) for _, c in FUNDAMENTAL_TEXT}
    parts = [F.concat(F.lit(f"{label}: "), said[c]) for label, c in FUNDAMENTAL_TEXT]
    return fundamentals.select(
        F.concat_ws(" ", *parts).alias("text"),
        _metadata(["symbol", "sector", "industry"], "fundamental").alias("metadata"),
    )


def number_documents(docs: DataFrame, start: int = 0) -> DataFrame:
    """Add a ``doc_id`` from ``start`` up, without gaps, in the order of a digest of the text and the metadata: the same
    documents get the same ids however they are dealt to tasks."""
    said = [F.coalesce(F.col("text"), F.lit(""))]
    if "metadata" in docs.columns:
        said.append(F.to_json(F.map_from_entries(F.array_sort(F.map_entries("metadata")))))
    digest = F.sha2(F.concat_ws("\n", *said), 256)
    return number_rows(docs, [digest], "doc_id", start)


def add_documents(
    spark: SparkSession, path: str, docs: DataFrame, embed: Callable[[str], Column] | None = None
) -> int:
    """Embed documents and append them to the stored collection; returns the first new id.

    Ids continue after the stored maximum, so batches never collide; one writer at a time. Empty input changes nothing.
    """
    start = 0
    if path_exists(spark, path):
        top = spark.read.parquet(path).agg(F.max("doc_id")).first()[0]
        start = 0 if top is None else top + 1
    if docs.isEmpty():
        return start
    if "metadata" not in docs.columns:
        docs = docs.withColumn("metadata", F.create_map().cast("map<string,string>"))
    metadata = F.coalesce("metadata", F.create_map().cast("map<string,string>"))
    vec = hash_embedding("text") if embed is None else embed("text")
    table = number_documents(docs.withColumn("metadata", metadata), start).withColumn("vec", vec)
    table.select("doc_id", "text", "metadata", "vec").write.mode("append").parquet(path)
    return start


def index_stats(docs: DataFrame, store: str = "flat", model: str = "hash") -> DataFrame:
    return docs.agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.lit(store).alias("vector_store_type"),
        F.lit(model).alias("embedding_model"),
        F.max(F.size("vec")).alias("embedding_dim"),
        F.count("vec").alias("index_size"),
    )


# --- top-k search --------------------------------------------------------------------------------


def search_flat(
    docs: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    metric: str = "cosine",
    cells: int = CELLS,
) -> DataFrame:
    """Exact top-k: ``(query_id, rank, doc_id, score)``, fewer rows when there are fewer documents.

    ``cosine`` scores are similarities (descending), ``l2`` squared distances of unit vectors
    (ascending). ``docs``: (doc_id, vec), ``queries``: (query_id, vec). One way for every size: ``search_exact`` over
    the cells of sampled centres.
    """
    checked(metric)
    return search_exact(cut_cells(docs.select("doc_id", "vec"), cells), queries, k, metric)


def train_cells(docs: DataFrame, lists: int = LISTS, seed: int = 42, iterations: int = 10) -> tuple[DataFrame, DataFrame]:
    """Cluster the vectors: ``docs`` with a ``cell`` column, and the centroids ``(cell, vec)``.

    The clusters are fitted on at most ``FIT_ROWS`` vectors, those of least hash; every vector gets a cell.
    """
    some = docs.where(F.col("vec").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).select("vec")
    featured = materialize(some.select(array_to_vector(F.transform("vec", lambda x: x.cast("double"))).alias("_f")))
    model = KMeans(k=lists, seed=seed, maxIter=iterations, featuresCol="_f", predictionCol="cell").fit(featured)
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centroids = docs.sparkSession.createDataFrame(centers, "cell int, vec array<float>")
    return assign_cells(docs, centroids), centroids


def _centre_matrix(centroids: DataFrame) -> np.ndarray:
    return unit(np.array([r["vec"] for r in centroids.orderBy("cell").collect()], np.float64))


def assign_cells(docs: DataFrame, centroids: DataFrame) -> DataFrame:
    """``docs`` with a vector, each with the ``cell`` whose centroid is nearest at unit length. Cells are numbered from 0."""
    return materialize(nearest_centre(docs, _centre_matrix(centroids)).drop("_far"))


def search_ivf(
    cells: DataFrame,
    centroids: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    probes: int = 8,
    metric: str = "l2",
) -> DataFrame:
    """Top-k among the documents of the ``probes`` cells whose centroids are nearest to the query."""
    centres = _centre_matrix(centroids)
    nothing = np.zeros(len(centres))
    return search_probed(Cells(cells.select("cell", "doc_id", "vec"), centres, nothing, nothing), queries, k, probes, metric)


def search(
    docs: DataFrame, queries: DataFrame, k: int = TOP_K, method: str = "flat", metric: str = "cosine", **options
) -> DataFrame:
    """Dispatch on the search method."""
    if method == "flat":
        return search_flat(docs, queries, k, metric, **options)
    if method == "ivf":
        return search_ivf(docs, options.pop("centroids"), queries, k, metric=metric, **options)
    raise ValueError(f"unsupported search method {method!r}")


def search_text(
    docs: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    embed: Callable[[str], Column] | None = None,
    **options,
) -> DataFrame:
    """Search by query text ``(query_id, text)``, encoded like the documents."""
    vec = hash_embedding("text") if embed is None else embed("text")
    return search(docs, queries.select("query_id", vec.alias("vec")), k, **options)


def attach_documents(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Text and metadata of every hit."""
    return hits.join(docs.select("doc_id", "text", "metadata"), "doc_id").select(
        "query_id", "rank", "doc_id", "text", "metadata", "score"
    )


def above_threshold(hits: DataFrame, threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    return hits.where(F.col("score") >= threshold)


# --- context -------------------------------------------------------------------------------------


def within_budget(hits: DataFrame, budget: int = CONTEXT_BUDGET) -> DataFrame:
    """Keep the best hits of each query while their texts together stay within ``budget`` characters."""
    running = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    used = F.sum(F.length("text")).over(running)
    return hits.withColumn("used", used).where(F.col("used") <= budget)


def context_text(hits: DataFrame) -> DataFrame:
    """One context string per query: hit texts in rank order."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return hits.groupBy("query_id").agg(
        F.array_join(F.transform(listed, lambda h: h["text"]), " ").alias("context")
    )


def retrieve_contexts(
    samples: DataFrame, docs: DataFrame, k: int = TOP_K, dim: int = DEFAULT_DIM, key: str = "sample_id"
) -> DataFrame:
    """Add ``context`` to all samples with one batch search; a sample without hits gets ''."""
    queries = samples.select(F.col(key).alias("query_id"), hash_embedding(retrieval_query(), dim).alias("vec"))
    hits = attach_documents(search_flat(docs, queries, k), docs)
    contexts = context_text(hits).withColumnRenamed("query_id", key)
    return samples.join(contexts, key, "left").fillna("", ["context"])


def align_contexts(samples: DataFrame, contexts: DataFrame, key: str = "sample_id") -> DataFrame:
    """Give every sample its context by id; missing ones are null."""
    return samples.join(contexts, key, "left")


# --- text preparation ----------------------------------------------------------------------------


def chunk_text(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Overlapping character chunks ``(doc_id, chunk, text)`` that together cover the whole text."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the chunk size")
    last = F.greatest(F.length("text") - overlap, F.lit(1)) - 1
    starts = F.sequence(F.lit(0), last, F.lit(size - overlap))
    return docs.select("doc_id", "text", F.posexplode(starts).alias("chunk", "_at")).select(
        "doc_id", "chunk", F.substring("text", F.col("_at") + 1, F.lit(size)).alias("text")
    )


def boilerplate_lines(docs: DataFrame, share: float = 0.1, edge: int = 1, min_docs: int = 2) -> DataFrame:
    """``(source, line)`` of lines that open or close at least ``share`` of a source's documents.

    A document offers at most ``2 * edge`` lines, so a source has at most ``2 * edge / share`` of them.
    """
    lines = F.split("text", "\n")
    ends = F.array_distinct(F.concat(F.slice(lines, 1, edge), F.slice(F.reverse(lines), 1, edge)))
    offered = docs.select("source", F.explode(ends).alias("line")).where(F.trim("line") != "")
    seen = offered.groupBy("source", "line").agg(F.count(F.lit(1)).alias("n"))
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs"))
    return (
        seen.join(sizes, "source")
        .where((F.col("n") >= min_docs) & (F.col("n") >= F.col("docs") * share))
        .select("source", "line", "n")
    )


def clean_documents(docs: DataFrame, share: float = 0.1, edge: int = 1, min_docs: int = 2) -> DataFrame:
    """Drop repeated header and footer lines, then collapse white space. Texts are not shuffled apart."""
    found = boilerplate_lines(docs, share, edge, min_docs)
    lists = found.groupBy("source").agg(F.collect_set("line").alias("_drop"))
    joined = docs.join(lists, "source", "left")
    drop = F.coalesce("_drop", F.array().cast("array<string>"))
    lines = F.split("text", "\n")
    count = F.size(lines)
    kept = F.filter(
        lines, lambda x, i: ~(((i < edge) | (i >= count - edge)) & F.array_contains(drop, x))
    )
    text = F.trim(F.regexp_replace(F.array_join(kept, " "), r"\s+", " "))
    return joined.withColumn("text", text).select(*docs.columns)


# --- persistence ---------------------------------------------------------------------------------


def save_index(docs: DataFrame, path: str, config: dict[str, str], centroids: DataFrame | None = None) -> None:
    """Documents with vectors, partitioned by cell, beside a one-row configuration table."""
    spark = docs.sparkSession
    table = docs if "cell" in docs.columns else docs.withColumn("cell", F.lit(0))
    table.repartition("cell", F.pmod(F.xxhash64("doc_id"), F.lit(64))).write.mode("overwrite").partitionBy("cell").parquet(
        f"{path}/docs"
    )
    row = [(dict(config),)]
    spark.createDataFrame(row, "config map<string,string>").write.mode("overwrite").parquet(f"{path}/config")
    if centroids is not None:
        centroids.write.mode("overwrite").parquet(f"{path}/centroids")


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/docs"), spark.read.parquet(f"{path}/config")
