"""Exact nearest neighbours over cells, and a stored index of cells that grows.

Vectors are compared at unit length. Every document belongs to the cell of its nearest centre; a cell has a radius. A query
first visits the cells nearest to it that hold k documents together; its k-th score there is a bound. By the triangle
inequality no document of a cell can be nearer than the centre's distance less the radius, so in a second round the query visits
only the cells that may still hold something better. Centres, radii and counts are as many as there are cells, whatever
the data, and are the only things every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barflow.session import materialize
from barflow.sources.store import path_exists

METRICS = ("cosine", "l2")
#: Cells of a search without an index, and rows that a training of centres reads at most.
CELLS, FIT_ROWS = 64, 100_000
#: Documents and queries of a tile at most, and queries of it that are scored at once.
TILE_DOCS, TILE_QUERIES, SCORED_AT_ONCE = 16_384, 4_096, 256
#: Scores are compared at this many decimals, so that equal vectors tie in any summation order.
SCORE_DECIMALS = 10
#: What a bound may be off by in double precision, and the rounding of scores.
SLACK = 1e-7

_HITS = "query_id bigint, doc_id bigint, _s double"


def unit(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(norms == 0, 1.0, norms)


def matrix(column: pd.Series, dim: int = 1) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, dim))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit (or zero) vectors."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def scores(queries: np.ndarray, docs: np.ndarray, metric: str) -> np.ndarray:
    """Score matrix in double precision; larger is better (squared distances are negated)."""
    inner = unit(queries) @ unit(docs).T
    if metric == "cosine":
        return np.round(inner, SCORE_DECIMALS)
    q2 = (unit(queries) ** 2).sum(axis=1)[:, None]
    d2 = (unit(docs) ** 2).sum(axis=1)[None, :]
    return -np.round(np.maximum(q2 + d2 - 2 * inner, 0.0), SCORE_DECIMALS)


def checked(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unsupported metric {metric!r}")


@dataclass(frozen=True)
class Cells:
    """Documents (``cell, doc_id, vec``) and what every task may know of all cells: centres, radii, counts."""

    docs: DataFrame
    centres: np.ndarray
    radii: np.ndarray
    counts: np.ndarray


def nearest_centre(docs: DataFrame, centres: np.ndarray) -> DataFrame:
    """``docs`` with a vector, with ``cell`` and the distance ``_far`` to its centre; of equally near centres the first."""
    shared = docs.sparkSession.sparkContext.broadcast(centres)
    schema = docs.withColumns({"cell": F.lit(0), "_far": F.lit(0.0)}).schema

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            far = np.round(distances(unit(matrix(part["vec"], shared.value.shape[1])), shared.value), SCORE_DECIMALS)
            part = part.assign(cell=far.argmin(axis=1).astype(np.int32) if len(part) else np.zeros(0, np.int32))
            yield part.assign(_far=far.min(axis=1) if len(part) else np.zeros(0))

    return docs.where(F.col("vec").isNotNull()).mapInPandas(run, schema)


def sample_centres(docs: DataFrame, cells: int) -> np.ndarray:
    """Vectors of the ``cells`` documents whose ids have the least hashes, as unit vectors."""
    some = docs.where(F.col("vec").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(cells).select("vec").collect()
    found = unit(np.array([r["vec"] for r in some], np.float64)) if some else np.zeros((0, 1))
    return np.unique(found, axis=0)


def cut_cells(docs: DataFrame, cells: int = CELLS) -> Cells:
    """Deal documents to the cells of sampled centres and store them. The vectors are stored first: they are read for the centres
    and to be dealt, and may be costly to compute."""
    docs = materialize(docs.select("doc_id", "vec"))
    centres = sample_centres(docs, cells)
    if not len(centres):
        return Cells(docs.select(F.lit(0).alias("cell"), "doc_id", "vec").where("false"), centres, np.zeros(0), np.zeros(0, np.int64))
    dealt = materialize(nearest_centre(docs, centres))
    return Cells(dealt.select("cell", "doc_id", "vec"), centres, *_measured(dealt.groupBy("cell").agg(*_measures()), len(centres)))


def _measures() -> list:
    return [F.count(F.lit(1)).alias("n"), F.max("_far").alias("radius")]


def _measured(stats: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    radii, counts = np.zeros(cells), np.zeros(cells, np.int64)
    for r in stats.collect():  # one row per cell
        radii[r["cell"]], counts[r["cell"]] = r["radius"], r["n"]
    return radii, counts


def _first_cells(far: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Per query the nearest cells with documents that hold ``k`` documents together."""
    order = np.argsort(np.where(counts > 0, far, np.inf), axis=1, kind="stable")
    before = np.cumsum(counts[order], axis=1) - counts[order]
    chosen = np.zeros(far.shape, bool)
    np.put_along_axis(chosen, order, (before < k) & (counts[order] > 0), axis=1)
    return chosen


def _visits(queries: DataFrame, cells: Cells, choose) -> DataFrame:
    """(cell, query_id, vec) for the cells that ``choose(queries, distances to the centres)`` picks."""
    shared = queries.sparkSession.sparkContext.broadcast(cells.centres)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                row, cell = np.nonzero(choose(part, distances(unit(matrix(part["vec"])), shared.value)))
                yield pd.DataFrame({"cell": cell.astype(np.int32), "query_id": part["query_id"].to_numpy()[row], "vec": part["vec"].to_numpy()[row]})

    return queries.mapInPandas(run, f"cell int, query_id bigint, vec {queries.schema['vec'].dataType.simpleString()}")


def best(found: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one query, by score and then by smaller id."""
    if len(found) > k:
        kth = np.partition(found, len(found) - k)[len(found) - k]
        near = np.flatnonzero(found >= kth)
    else:
        near = np.arange(len(found))
    return near[np.lexsort((ids[near], -found[near]))[:k]]


def meet(docs: DataFrame, visits: DataFrame, k: int, metric: str) -> DataFrame:
    """The k best of each query in every tile: documents and queries of one cell, a bounded block of each.

    A cell is split by exact counts of its documents and of its visits, two tables of one row per cell; rows are copied only
    to the tiles of their own cell.
    """
    many = docs.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE_DOCS).cast("int").alias("_dbs"))
    asked = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE_QUERIES).cast("int").alias("_qbs"))
    sizes = F.broadcast(many.join(asked, "cell"))  # one row per cell
    left = (
        docs.join(sizes, "cell")
        .withColumn("_db", F.pmod(F.xxhash64("doc_id"), F.col("_dbs")).cast("int"))
        .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.col("_qbs") - 1)))
        .select("cell", "_db", "_qb", "doc_id", "vec")
    )
    right = (
        visits.join(sizes, "cell")
        .withColumn("_qb", F.pmod(F.xxhash64("query_id"), F.col("_qbs")).cast("int"))
        .withColumn("_db", F.explode(F.sequence(F.lit(0), F.col("_dbs") - 1)))
        .select("cell", "_db", "_qb", "query_id", "vec")
    )

    def score(d: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [np.zeros(0, np.int64)], "doc_id": [np.zeros(0, np.int64)], "_s": [np.zeros(0)]}
        if len(d) and len(q):
            ids, vectors, asked_by = d["doc_id"].to_numpy(), matrix(d["vec"]), q["query_id"].to_numpy()
            for lo in range(0, len(q), SCORED_AT_ONCE):
                found = scores(matrix(q["vec"].iloc[lo : lo + SCORED_AT_ONCE]), vectors, metric)
                for one, row in zip(asked_by[lo : lo + SCORED_AT_ONCE], found, strict=True):
                    at = best(row, ids, k)
                    out["query_id"].append(np.full(len(at), one))
                    out["doc_id"].append(ids[at])
                    out["_s"].append(row[at])
        return pd.DataFrame({c: np.concatenate(v) for c, v in out.items()})

    key = ["cell", "_db", "_qb"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(score, _HITS)


def rank(partial: DataFrame, k: int, metric: str) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("_s"), "doc_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    score = F.col("_s") if metric == "cosine" else F.abs("_s")
    return ranked.select("query_id", "rank", "doc_id", score.alias("score"))


def search_exact(cells: Cells, queries: DataFrame, k: int, metric: str = "cosine") -> DataFrame:
    """Exact top-k in two rounds, the k-th score of the first bounding the cells of the second."""
    checked(metric)
    queries = queries.select("query_id", "vec").where(F.col("vec").isNotNull())
    if not len(cells.centres):
        return queries.sparkSession.createDataFrame([], "query_id bigint, rank int, doc_id bigint, score double")
    counts, radii = cells.counts, cells.radii
    first = materialize(meet(cells.docs, _visits(queries, cells, lambda q, far: _first_cells(far, counts, k)), k, metric))
    order = Window.partitionBy("query_id").orderBy(F.desc("_s"), "doc_id")
    kth = first.withColumn("_at", F.row_number().over(order)).where(F.col("_at") == k).select("query_id", F.col("_s").alias("_kth"))
    bounded = queries.join(kth, "query_id", "left")

    def still_open(q: pd.DataFrame, far: np.ndarray) -> np.ndarray:
        least = np.maximum(far - radii[None, :], 0.0) ** 2
        best_left = 1.0 - least / 2 if metric == "cosine" else -least
        kth_score = q["_kth"].astype(np.float64).fillna(-np.inf).to_numpy()
        return (best_left >= kth_score[:, None] - SLACK) & (counts > 0) & ~_first_cells(far, counts, k)

    second = meet(cells.docs, _visits(bounded, cells, still_open), k, metric)
    return rank(first.unionByName(second), k, metric)


def search_probed(cells: Cells, queries: DataFrame, k: int, probes: int, metric: str = "l2") -> DataFrame:
    """Top-k among the documents of the ``probes`` cells whose centres are nearest to the query; of equals the first cells."""
    checked(metric)
    queries = queries.select("query_id", "vec").where(F.col("vec").isNotNull())

    def nearest(q: pd.DataFrame, far: np.ndarray) -> np.ndarray:
        chosen = np.zeros(far.shape, bool)
        order = np.argsort(np.round(far, SCORE_DECIMALS), axis=1, kind="stable")[:, :probes]
        np.put_along_axis(chosen, order, True, axis=1)
        return chosen

    visits = materialize(_visits(queries, cells, nearest))
    asked = [r["cell"] for r in visits.select("cell").distinct().collect()]  # as many as there are cells, at most
    return rank(meet(cells.docs.where(F.col("cell").isin(asked)), visits, k, metric), k, metric)


# --- a stored index ------------------------------------------------------------------------------


def create_index(spark: SparkSession, path: str, centres: np.ndarray, config: Mapping[str, str] | None = None, idf: DataFrame | None = None) -> None:
    """An empty index with these centres; documents come by ``append_documents``. ``idf`` (of ``fit_idf``) is stored beside it."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(unit(np.asarray(centres, np.float64)))]
    spark.createDataFrame(rows, "cell int, vec array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    spark.createDataFrame([(dict(config or {}),)], "config map<string,string>").write.mode("overwrite").parquet(f"{path}/config")
    if idf is not None:
        idf.coalesce(1).write.mode("overwrite").parquet(f"{path}/idf")


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(f"{path}/commits") if path_exists(spark, f"{path}/commits") else None


def append_documents(spark: SparkSession, path: str, docs: DataFrame, batch: str) -> bool:
    """Deal a batch of documents (``doc_id, vec`` and more columns) to the index's cells; False if that batch is in it already.

    The batch's files are written first, in its own folders by cell, replacing what a failed attempt left. One small file
    with the counts and radii of its cells then commits it: readers see committed batches only, so a batch can be sent again
    at any time. Documents without a vector are left out.
    """
    if not batch or "/" in batch:
        raise ValueError("a batch needs a name without a slash")
    done = _commits(spark, path)
    if done is not None and not done.where(F.col("batch") == batch).isEmpty():
        return False
    centres = _centres(spark, path)
    target = f"{path}/docs/batch={batch}"
    dealt = nearest_centre(docs, centres)
    dealt.repartition("cell", F.pmod(F.xxhash64("doc_id"), F.lit(16))).write.mode("overwrite").partitionBy("cell").parquet(target)
    stored = spark.read.schema(dealt.schema).parquet(target)
    stats = stored.groupBy("cell").agg(*_measures()).select(F.lit(batch).alias("batch"), "cell", "n", "radius")
    stats.coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return True


def _centres(spark: SparkSession, path: str) -> np.ndarray:
    return np.array([r["vec"] for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()], np.float64)


def index_documents(spark: SparkSession, path: str) -> DataFrame:
    """Committed documents. ``cell`` and ``batch`` are folders, so a filter on them leaves the others unread."""
    done = _commits(spark, path)
    if done is None:
        raise ValueError(f"no committed batch in {path}")
    docs = spark.read.option("basePath", f"{path}/docs").option("mergeSchema", "false").parquet(f"{path}/docs")
    return docs.withColumn("batch", F.col("batch").cast("string")).join(F.broadcast(done.select("batch").distinct()), "batch", "left_semi")


def open_index(spark: SparkSession, path: str) -> Cells:
    """The index for searching: its documents by cell, with radii and counts over all committed batches."""
    centres = _centres(spark, path)
    stats = _commits(spark, path)
    if stats is None:
        raise ValueError(f"no committed batch in {path}")
    stats = stats.groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"))
    return Cells(index_documents(spark, path).select("cell", "doc_id", "vec"), centres, *_measured(stats, len(centres)))


def index_idf(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/idf")
