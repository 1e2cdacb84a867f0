"""Near-duplicates: an inverted join over MinHash signature coordinates, every link confirmed on whole shingle sets.

1. Documents of equal shingle set form a class. A class has a signature of ``COORDINATES`` minima.
2. Two sets of just the Jaccard asked for agree in at least ``matches`` of 32 coordinates, but for a chance below
   ``MISSED``: 16 at 0.85, fewer at a lower one. Of two signatures that do, any ``COORDINATES - matches + 1`` coordinates
   of the one, taken rarest value first, hold one that they share: a class is posted under these coordinate-value pairs only (prefix). Frequent values stand last, so that
   their long lists are not merged at all (skip), and a class whose pairs are its own for the most part isn't posted; collisions over the whole signature are counted per candidate pair.
3. Of the classes left on some list, the shingles that no other of them has are counted: none of these can be in
   common. Classes that have too many cannot be linked at all, and pairs are held against the rest of their sets. A
   finer sketch of one-bit coordinates tells most other pairs that are too far apart.
4. Each list is first compared with one pivot, the class with the largest share of shingles that others have too: the
   fewer changes of its own a copy has, the more copies it is linked with. What turns out linked joins the pivot's
   component, so a large group of near copies costs a comparison each, not one per pair.
5. Lists that still hold several components are joined across components: the largest one of the list against the others,
   and the others among themselves. Pairs inside a component can add nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import only
from barflow.llm.components import components
from barflow.session import materialize

#: Words in a shingle.
WORDS = 5
#: Coordinates of a signature, and one-bit coordinates of the finer sketch that candidates get.
COORDINATES, BITS = 32, 4096
#: Chances that signature and finer sketch miss a pair of just the similarity asked for; and the lowest one, in a hundred.
MISSED, MISSED_BITS, LEAST = 1e-6, 5e-7, 80
#: Distinct words whose hashes a task remembers.
REMEMBERED = 500_000
#: Shingles hashed in one vectorised step.
STEP = 1 << 20

_MULTIPLIERS = np.random.default_rng(20240501).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BIT_MULTIPLIERS = np.random.default_rng(20240502).integers(1, 1 << 63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def bounds(percent: int) -> tuple[int, int]:
    """How many coordinates linked sets must share, and in how many one-bit coordinates they may differ.

    Coordinates are equal with the chance of the similarity, bits differ with half of the rest: at 85 percent in 307 of
    4,096 on average.
    """
    alike = min(percent, 100) / 100
    matches, below = 0, (1 - alike) ** COORDINATES
    while matches < COORDINATES and below < MISSED:
        matches += 1
        below += math.comb(COORDINATES, matches) * alike**matches * (1 - alike) ** (COORDINATES - matches)
    differ = (1 - alike) / 2
    upto = np.array([math.lgamma(BITS + 1) - math.lgamma(k + 1) - math.lgamma(BITS - k + 1) for k in range(BITS + 1)])
    k = np.arange(BITS + 1)
    chance = np.exp(upto + k * math.log(differ) + (BITS - k) * math.log1p(-differ)) if differ else (k == 0).astype(float)
    above = np.append(np.cumsum(chance[::-1])[::-1][1:], 0.0)
    return matches, int(np.argmax(above < MISSED_BITS))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: _WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. ASCII letters are lowered, words end at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(h))
    count = len(h) - width + 1
    with np.errstate(over="ignore"):
        x = np.full(count, width, np.uint64)
        for j in range(width):
            x = x * _ROLL + h[j : j + count]
    return np.unique(mixed(x))


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Least high half of each multiple of the shingles, per set (none empty) and coordinate."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    x = np.concatenate(sets)
    out = np.empty((len(sets), COORDINATES), np.int64)
    with np.errstate(over="ignore"):
        for k, m in enumerate(_MULTIPLIERS):
            out[:, k] = np.minimum.reduceat(mixed(x * m) >> np.uint64(33), starts)
    return out.astype(np.int32)


def _bits(sets: list[np.ndarray]) -> np.ndarray:
    """A bit of the least multiple of the shingles, per set and coordinate, packed into 64-bit numbers."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    x = np.concatenate(sets)
    out = np.empty((len(sets), BITS), np.uint8)
    with np.errstate(over="ignore"):
        for k, m in enumerate(_BIT_MULTIPLIERS):
            out[:, k] = mixed(np.minimum.reduceat(x * m, starts)) & np.uint64(1)
    return np.packbits(out, axis=1).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for b in batches:
        n = np.zeros(b.num_rows, np.int64)
        node: list[bytes | None] = [None] * b.num_rows
        sig = np.zeros((b.num_rows, COORDINATES), np.int32)
        at, sets, waiting = [], [], 0
        for i, text in enumerate(b.column(1)):
            s = shingles(text.as_py(), hashes)
            n[i] = len(s)
            if len(s):
                node[i] = blake2b(s.tobytes(), digest_size=16).digest()
                at.append(i)
                sets.append(s)
                waiting += len(s)
            if sets and (waiting >= STEP or i == b.num_rows - 1):
                sig[at] = _signatures(sets)
                at, sets, waiting = [], [], 0
        if sets:
            sig[at] = _signatures(sets)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * COORDINATES), pa.array(sig.ravel()))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(node, pa.binary()), lists], names=["id", "n", "node", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for b in batches:
        sets = [shingles(t.as_py(), hashes) for t in b.column(1)]
        names = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        own = [k for k, (name, node) in enumerate(zip(names, b.column(2).to_pylist(), strict=True)) if name == node]
        sets, nodes = [sets[k] for k in own], pa.array([names[k] for k in own], pa.binary())  # an id may have other texts
        flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32)), pa.array(flat))
        parts = [_bits(sets[k : k + 200]).ravel() for k in range(0, len(sets), 200)]
        ends = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (BITS // 64))
        bits = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int64), *parts])))
        yield pa.RecordBatch.from_arrays([nodes, lists, bits], names=["node", "shingles", "bits"])


def _tokens(b: pa.RecordBatch) -> np.ndarray:
    """64-bit names of the coordinate-value pairs, one row per class."""
    sig = b.column("sig").flatten().to_numpy(zero_copy_only=False).astype(np.uint64).reshape(-1, COORDINATES)
    return mixed(sig + (np.arange(1, COORDINATES + 1, dtype=np.uint64) << np.uint64(33)))


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = np.repeat(np.arange(b.num_rows), COORDINATES)
        tokens = pa.array(_tokens(b).ravel().view(np.int64))
        yield pa.RecordBatch.from_arrays([tokens, b.column("key").take(pa.array(rows))], names=["token", "key"])


def _candidates(classes: DataFrame, matches: int) -> DataFrame:
    """Posted coordinate-value pairs (``key``, ``token``) of the classes that may share enough of them with another.

    A pair that one class alone has cannot match. A class with fewer than ``matches`` others is dropped, which may leave
    further pairs alone, so it is done twice. What is left is posted, rarest first: of the signature's first
    ``COORDINATES - matches + 1`` pairs in that order, those that are not alone.
    """
    posted = classes.select(_key().alias("key"), "sig").mapInArrow(_post, "token bigint, key bigint")
    for _ in range(2):
        often = materialize(posted.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"))
        mine = posted.join(often, "token")
        enough = mine.groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") >= matches)
        posted = materialize(mine.join(enough, "key"))
        mine, posted = posted, posted.select("token", "key")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("rows", "token"))
    prefix = mine.withColumn("rank", rank).filter(F.col("rank") <= F.col("many") - (matches - 1))
    return materialize(prefix.select("token", "key"))


def _key() -> Column:
    """Short name of a class, for counting. Should two classes share one, they only become candidates together."""
    return F.conv(F.hex(F.substring("node", 1, 7)), 16, 10).cast("bigint")


def _close(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be as similar as asked."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _apart(p: str, q: str) -> Column:
    """In how many one-bit coordinates two sketches differ."""
    return sum(F.bit_count(F.col(p)[i].bitwiseXOR(F.col(q)[i])) for i in range(BITS // 64))


def _collide(pairs: DataFrame, classes: DataFrame, percent: int, matches: int) -> DataFrame:
    """Of distinct pairs (a, b) of classes, those that sizes, shared shingles and collisions allow to be links."""
    for x in ("a", "b"):
        of = classes.select(F.col("node").alias(x), *[F.col(k).alias(f"{k}_{x}") for k in ("n", "shared", "sig")])
        pairs = pairs.join(of, x)
    n, shared = F.col("n_a") + F.col("n_b"), F.least("shared_a", "shared_b")
    same = F.aggregate(F.zip_with("sig_a", "sig_b", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v)
    close = _close(F.col("n_a"), F.col("n_b"), percent) & _enough(shared, n, percent)
    return materialize(pairs.filter(close & (same >= matches)).select("a", "b"))


def _unsettled(postings: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the lists that hold several components of the links, with the row's (``comp``) and the list's largest (``giant``)."""
    rows = postings.join(components(links), "node", "left")
    rows = materialize(rows.select("token", "node", "n", "shared", F.coalesce("comp", "node").alias("comp")))
    sizes = rows.groupBy("token", "comp").agg(F.count("*").alias("rows"))
    several = sizes.groupBy("token").agg(
        F.count("*").alias("comps"), F.max(F.struct("rows", "comp")).alias("most"), F.sum("rows").alias("all")
    )
    several = several.filter("comps > 1").select("token", F.col("most.comp").alias("giant"), "all", F.col("most.rows").alias("most"))
    return materialize(rows.join(materialize(several), "token"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are as similar as asked."""
    whole = sets.select("node", "shingles")
    two = pairs.join(whole.toDF("a", "set_a"), "a").join(whole.toDF("b", "set_b"), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return two.filter(_enough(both, F.size("set_a") + F.size("set_b"), percent)).select("a", "b")


def _enough(both: Column, n: Column, percent: int) -> Column:
    """Whether two sets of n elements together that share ``both`` are as similar as asked."""
    return both * 100 >= (n - both) * percent


def _shared(sets: DataFrame) -> DataFrame:
    """Per class (``node``, with its ``bits``): how many of its shingles another class of ``sets`` has too.

    No class can share more than that with any other. Counted by shingle, with a short name for the class.
    """
    each = sets.select(_key().alias("key"), F.explode("shingles").alias("x"))
    alone = each.groupBy("x").agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("key")).filter("rows = 1")
    alone = alone.groupBy("key").agg(F.count(F.lit(1)).alias("alone"))
    found = sets.select("node", _key().alias("key"), F.size("shingles").alias("n"), "bits").join(alone, "key", "left")
    return found.select("key", "node", "bits", (F.col("n") - F.coalesce("alone", F.lit(0))).cast("bigint").alias("shared"))


def near_duplicates(docs: DataFrame, percent: int = 85, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept``, under the name of the id column.

    Linked are documents whose sets of distinct shingles, intersection over union, reach ``percent`` in a hundred (80 or
    more). A text shorter than a shingle is one shingle; one without words, or null, has none and is linked with nothing.
    ``component_id`` is the smallest id reachable over links; ``kept`` tells that it is the row's own. Rows of equal text
    are one class, whatever their number. A null id cannot name a component: such a row gets the component of the rows that
    have its very set, or null, and is not kept. Repeated ids get a row each. No rows give no rows.
    """
    if percent < LEAST:
        raise ValueError(f"the signature is laid out for {LEAST} percent or more")
    matches, far = bounds(percent)
    docs = only(docs, id, text).toDF("id", "text")
    kind = docs.schema["id"].dataType.simpleString()
    sketch = materialize(docs.mapInArrow(_sketch, f"id {kind}, n bigint, node binary, sig array<int>"))
    classes = materialize(
        sketch.filter("n > 0").groupBy("node").agg(F.min("id").alias("low"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    )
    named = classes.filter("low IS NOT NULL")

    posted = _candidates(named, matches)
    some = posted.select("key").distinct().join(named.withColumn("key", _key()), "key").select("node", "low")
    some = materialize(some)
    texts = docs.join(some.withColumnRenamed("low", "id").hint("merge"), "id").select("id", "text", "node")
    sets = materialize(texts.mapInArrow(_sets, "node binary, shingles array<bigint>, bits array<bigint>"))
    able = classes.select("node", "low", "n", "sig").join(_shared(sets), "node")
    able = materialize(able.filter(F.col("shared") * 100 >= F.col("n") * percent))
    postings = materialize(posted.join(able.select("key", "node", "low", "n", "shared"), "key").drop("key"))
    central = F.min(F.struct((-F.col("shared") / F.col("n")).alias("share"), "low", "node"))
    lists = postings.groupBy("token").agg(F.count("*").alias("rows"), central.alias("pivot"))
    lists = materialize(lists.filter("rows > 1").select("token", F.col("pivot.node").alias("pivot")))
    postings = materialize(postings.join(lists, "token"))

    stars = materialize(postings.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct())
    links = materialize(_confirm(_collide(stars, able, percent, matches), sets, percent))

    rows = _unsettled(postings, links)
    lists = rows.groupBy("node").agg(F.collect_set("token").alias("tokens"))  # as many as were posted, at most
    rows = materialize(rows.join(lists, "node").join(able.select("node", "bits"), "node"))
    r = rows.filter("comp <> giant").alias("r")
    across = r.join(
        rows.alias("p"),
        (F.col("r.token") == F.col("p.token"))
        & ((F.col("p.comp") == F.col("p.giant")) | (F.col("r.comp") < F.col("p.comp")))
        & _close(F.col("r.n"), F.col("p.n"), percent)
        & _enough(F.least("r.shared", "p.shared"), F.col("r.n") + F.col("p.n"), percent)
        & (_apart("r.bits", "p.bits") <= far)
        & (F.array_min(F.array_intersect("r.tokens", "p.tokens")) == F.col("r.token")),  # each pair on one list only
    )
    across = across.select(F.col("r.node").alias("a"), F.col("p.node").alias("b")).distinct()
    across = materialize(across.join(stars.union(stars.select("b", "a")), ["a", "b"], "left_anti"))
    more = materialize(_confirm(across, sets, percent))

    final = components(links.unionByName(more))
    lowest = classes.join(final, "node").groupBy("comp").agg(F.min("low").alias("component"))
    named = final.join(lowest, "comp").select("node", "component")
    of_class = classes.select("node", "low").join(named, "node", "left")
    of_class = materialize(of_class.select("node", F.coalesce("component", "low").alias("component")))
    found = sketch.select("id", "n", "node").join(of_class, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return found.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
