"""Nearest neighbours by multi-index hashing.

Vectors get binary codes: centred, rotated onto principal axes and by a rotation learned so that the axes' signs lose
least (iterative quantisation on a bounded sample). A code is split into substrings, each with a table of its own. Two
codes within radius r differ by at most a share of r in one substring (pigeonhole), so probing every table with the
near values of the query's substring retrieves every code within r; these are ranked by their inner product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import only
from barflow.session import materialize

#: Vectors on which the codes are learned, those of least id hash; and how many of them calibrate the radius.
FIT_ROWS, CALIBRATION_ROWS = 20_000, 500
#: Share of the sample's nearest neighbours that the radius must take in.
COVERAGE = 0.98
#: Bits of a code and of a substring; high bits of a substring value that name the cell in which it is searched.
BITS, SUBSTRING_BITS, CELL_BITS = 64, 8, 3
#: Indexed rows, and queries, that one task holds.
CELL_ROWS, QUERY_ROWS = 16_384, 8_192
#: Scores this close, relative to the k-th best, are settled by exact sums.
MARGIN = 1e-9


@dataclass(frozen=True)
class Codes:
    """``sign(rotation @ (x - mean))`` of unit vectors, extended by one axis that evens out their lengths."""

    dimension: int
    longest: float
    mean: np.ndarray
    rotation: np.ndarray

    def extended(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Vectors whose angles order as the inner products with the query do."""
        square = np.einsum("ij,ij->i", x, x)
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - square, 0))
        y = np.concatenate([x, last[:, None]], axis=1)
        return y / np.sqrt(square + last**2)[:, None]

    def codes(self, x: np.ndarray, query: bool) -> np.ndarray:
        bits = (self.extended(x, query) - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1, bitorder="little").copy().view("<u8")[:, 0]


def learn(x: np.ndarray, longest: float, rounds: int = 40) -> Codes:
    """Principal axes, then the rotation that brings the sample nearest to its signs. Missing axes are filled up by
    random directions, so that a code always has ``BITS`` bits."""
    rng = np.random.default_rng(7)
    bare = Codes(x.shape[1], longest, np.zeros(x.shape[1] + 1), np.empty((0, 0)))
    y = bare.extended(x, query=False)
    mean = y.mean(axis=0)
    _, axes = np.linalg.eigh(np.cov((y - mean).T) if len(y) > 1 else np.eye(y.shape[1]))
    axes = axes[:, ::-1][:, :BITS]
    if axes.shape[1] < BITS:
        extra = rng.standard_normal((y.shape[1], BITS - axes.shape[1]))
        axes = np.concatenate([axes, extra / np.linalg.norm(extra, axis=0)], axis=1)
    z = (y - mean) @ axes
    turn, _ = np.linalg.qr(rng.standard_normal((BITS, BITS)))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(z @ turn > 0, 1.0, -1.0).T @ z)
        turn = (u @ v).T
    return Codes(x.shape[1], longest, mean, axes @ turn)


def radius(codes: Codes, x: np.ndarray, k: int, coverage: float = COVERAGE) -> int:
    """Hamming distance that takes in ``coverage`` of the k best in the sample of each of its first rows. Among more rows the
    k best are nearer, so the share found only grows."""
    stored, asked = codes.codes(x, False), codes.codes(x[:CALIBRATION_ROWS], True)
    far = []
    for i, code in enumerate(asked):
        score = x @ x[i]
        score[i] = -np.inf
        best = np.argsort(-score, kind="stable")[: min(k, len(x) - 1)]
        far.append(np.bitwise_count(stored[best] ^ code))
    far = np.concatenate([[0], *far])
    return int(np.quantile(far, coverage, method="higher"))


def radii(r: int, parts: int) -> list[int]:
    """How far to probe in each substring: the shares of r, one less in those beyond the remainder."""
    a, b = divmod(r, parts)
    return [a if j <= b else a - 1 for j in range(parts)]


def _usable(values: pa.Array, dimension: int | None, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and matrix of the vectors that are whole: not null, all components finite, not all zero."""
    kind = np.float64 if wide else np.float32
    rows, found = [], []
    for i, v in enumerate(values):
        if v.is_valid and v.values.null_count == 0 and len(v.values) and dimension in (None, len(v.values)):
            x = v.values.to_numpy().astype(kind)
            if np.isfinite(x).all() and x.any():
                rows.append(i)
                found.append(x)
    return np.array(rows, np.int64), np.array(found, kind)


def _vectors(df: DataFrame, id: str, vector: str) -> tuple[DataFrame, bool]:
    item = df.schema[vector].dataType.elementType.simpleString()
    wide = item != "float"
    return only(df, id, vector).toDF("id", "vector").filter("id IS NOT NULL AND vector IS NOT NULL"), wide


def nearest(
    df: DataFrame, queries: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of ``df`` with the largest inner product with each row of ``queries``.

    Scores are sums in double precision over the components in order; ties go to the smaller id. A row is no
    neighbour of a query with its id; a query id that repeats is asked once, rows that repeat an id all count. Vectors that are
    null, all zero, of another length than most, or hold a null or non-finite component take no part, nor do rows
    without an id. A query for which fewer than k codes lie within the radius is asked again over all rows, so it gets k
    neighbours, or all rows if there are fewer. No usable rows give no rows.
    """
    spark = df.sparkSession
    rows, wide = _vectors(df, id, vector)
    asked, _ = _vectors(queries, id, vector)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(fit_rows).toArrow()
    lengths = np.array([len(v.values) for v in sample.column("vector")] or [0])
    dimension = int(np.bincount(lengths).argmax())
    _, x = _usable(sample.column("vector").combine_chunks(), dimension, wide)
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if not len(x):
        return spark.createDataFrame([], out)
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    whole = F.size("vector") == dimension
    longest = rows.select(F.when(whole, square).alias("s")).filter("s > 0 AND s < double('infinity')").agg(F.max("s")).first()[0]
    codes = learn(x.astype(np.float64), math.sqrt(longest) if longest else 1.0)
    reach = radius(codes, x.astype(np.float64), k)
    shared = spark.sparkContext.broadcast((dimension, wide, codes.longest, codes.mean, codes.rotation))

    def encode(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dimension, wide, *rest = shared.value
            own = Codes(dimension, *rest)
            for b in batches:
                at, x = _usable(b.column(1), dimension, wide)
                code = own.codes(x.astype(np.float64), query).view(np.int64) if len(at) else np.empty(0, np.int64)
                made = [b.column(0).take(pa.array(at)), pa.array(code), pa.array([v.tobytes() for v in x], pa.binary())]
                yield pa.RecordBatch.from_arrays(made, names=["id", "code", "vector"])

        return run

    kind = "id bigint, code bigint, vector binary"
    stored = materialize(rows.withColumn("id", F.col("id").cast("bigint")).mapInArrow(encode(False), kind))
    asked = asked.withColumn("id", F.col("id").cast("bigint")).mapInArrow(encode(True), kind)
    asked = materialize(asked.dropDuplicates(["id"]))

    parts = BITS // SUBSTRING_BITS
    found = _probe(stored, asked, radii(reach, parts), reach, k, wide)
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
    left = materialize(asked.join(enough, asked["id"] == enough["query_id"], "left_anti"))
    again = _probe(stored, left, [SUBSTRING_BITS] + [-1] * (parts - 1), BITS, k, wide)
    found = found.join(left, found["query_id"] == left["id"], "left_anti").unionByName(again)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _probe(stored: DataFrame, asked: DataFrame, reach: list[int], total: int, k: int, wide: bool) -> DataFrame:
    """The k best of each query among the codes within ``total``, from the tables probed as far as ``reach`` says.

    A table is cut into cells by the high bits of the substring value; a cell with many rows is cut again by id, and many
    queries go in blocks, so no task holds more than its share. A pair that several tables offer counts in the first.
    """
    tables = [j for j, d in enumerate(reach) if d >= 0]
    low_bits, mask = SUBSTRING_BITS - CELL_BITS, (1 << SUBSTRING_BITS) - 1

    def value(j):
        return F.shiftrightunsigned(F.col("code"), j * SUBSTRING_BITS).bitwiseAND(F.lit(mask)).cast("int")

    posted = stored.select(
        "*", F.explode(F.array(*[F.struct(F.lit(j).alias("part"), F.shiftright(value(j), low_bits).alias("cell")) for j in tables])).alias("at")
    ).select("id", "code", "vector", "at.part", "at.cell")
    # a row for each of at most parts * 2 ** CELL_BITS cells
    sizes = {(r[0], r[1]): r[2] for r in posted.groupBy("part", "cell").count().collect()}
    blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))
    cuts = {at: max(1, math.ceil(n / CELL_ROWS)) for at, n in sizes.items()}
    cells = [[c for c in range(1 << CELL_BITS) if (j, c) in cuts] for j in tables]
    cut_of = F.create_map(*[F.lit(x) for (j, c), n in cuts.items() for x in (j * 1000 + c, n)]) if cuts else F.create_map(F.lit(0), F.lit(1))
    cut = F.element_at(cut_of, F.col("part") * 1000 + F.col("cell"))

    posted = posted.withColumn("cut", F.pmod(F.xxhash64("id"), cut).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    # The high bits of a probed value differ from the query's in no more bits than the substrings may.
    near = [
        F.struct(F.lit(j).alias("part"), F.lit(c).alias("cell"), (F.bit_count(F.shiftright(value(j), low_bits).bitwiseXOR(F.lit(c))) <= reach[j]).alias("near"))
        for j, cs in zip(tables, cells, strict=True)
        for c in cs
    ]
    near = near or [F.struct(F.lit(0).alias("part"), F.lit(0).alias("cell"), F.lit(False).alias("near"))]
    sent = (
        asked.select("*", F.explode(F.array(*near)).alias("at"))
        .filter("at.near")
        .select("id", "code", "vector", "at.part", "at.cell", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
        .withColumn("cut", F.explode(F.sequence(F.lit(0), cut - 1)))
    )
    type_ = np.float64 if wide else np.float32
    by = ["part", "cell", "cut", "block"]

    def search(key, rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(rows) or not len(asks):
            return none
        part = key[0]
        shift = np.uint64(part * SUBSTRING_BITS)
        x = np.frombuffer(b"".join(rows["vector"]), type_).reshape(len(rows), -1).astype(np.float64)
        q = np.frombuffer(b"".join(asks["vector"]), type_).reshape(len(asks), -1).astype(np.float64)
        code, ids = rows["code"].to_numpy().view(np.uint64), rows["id"].to_numpy()
        asked_code, asked_ids = asks["code"].to_numpy().view(np.uint64), asks["id"].to_numpy()
        own, theirs = (code >> shift) & np.uint64(mask), (asked_code >> shift) & np.uint64(mask)
        by_value = np.argsort(own, kind="stable")
        values, starts = np.unique(own[by_value], return_index=True)
        ends = [*starts[1:], len(own)]
        best: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for v, lo, hi in zip(values, starts, ends, strict=True):
            near = np.flatnonzero(np.bitwise_count(theirs ^ v) <= reach[part])
            for a in range(0, len(near), 256):
                some = near[a : a + 256]
                for b in range(lo, hi, 4096):
                    hit = by_value[b : min(hi, b + 4096)]
                    apart = code[hit][None, :] ^ asked_code[some][:, None]
                    ok = (np.bitwise_count(apart) <= total) & (ids[hit][None, :] != asked_ids[some][:, None])
                    for j in range(part):
                        ok &= np.bitwise_count((apart >> np.uint64(j * SUBSTRING_BITS)) & np.uint64(mask)) > reach[j] if reach[j] >= 0 else True
                    score = np.where(ok, q[some] @ x[hit].T, -np.inf)
                    if score.shape[1] > k:
                        kth = -np.partition(-score, k - 1, axis=1)[:, k - 1]
                        ok &= score >= (kth - MARGIN * np.maximum(1, np.abs(kth)))[:, None]
                    r, c = np.nonzero(ok)
                    for i in np.unique(r):
                        at = c[r == i]
                        best.setdefault(int(some[i]), []).append((hit[at], score[i, at]))
        pairs = []
        for i, found in best.items():
            at, score = (np.concatenate(y) for y in zip(*found, strict=True))
            if len(at) > k:
                kth = -np.partition(-score, k - 1)[k - 1]
                at = at[score >= kth - MARGIN * max(1, abs(kth))]
            pairs.append(np.stack([np.full(len(at), i), at]))
        if not pairs:
            return none
        i, at = np.concatenate(pairs, axis=1)
        exact = np.zeros(len(i))
        for d in range(x.shape[1]):
            exact += q[i, d] * x[at, d]
        return pd.DataFrame({"query_id": asked_ids[i], "vec_id": ids[at], "score": exact})

    return materialize(
        posted.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    )
