"""Prefix trie of conversations, and its subtree totals by parallel tree contraction.

A node is a distinct beginning of conversations. Its key is the exclusive or of one 128-bit hash per turn, taken from place,
role and text, so that a conversation's keys are running values that blocks of a long conversation can hand on.

Totals over all subtrees need no walk by depth. Rounds alternate two steps until nothing is left: *rake* adds every leaf to its
parent, where many siblings are summed before a shuffle, and *compress* takes out whole chains of nodes with one child, by
pointer doubling: after j joins a node knows the sum of the 2^j nodes below it. After compress every inner node has two children
or more, so rake takes at least half of the nodes; the rounds grow with the logarithm of the nodes, whatever the depth. A raked
node's total is final. Chains are then put back, last round first: a node's total is its chain's sum plus the total of the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import lookup, only
from barflow.session import materialize

#: Turns of another conversation that can stand in front of a rebuilt one.
MOST_HEAD = 5
#: Ids of members that are put into one piece of text before it is hashed.
SEGMENT_IDS = 4096
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def number_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, block, digest, chars``: turns numbered from 1 within their conversation, by turn (null first).

    Null roles and texts count as empty, rows without a conv_id are left out, and turns of the same number stand in the order
    of a digest of role and text. Rows are dealt to blocks by ranges of that order, so a conversation of any length is spread
    over several; the ranges are drawn from a sample, so the blocks are stored before they are counted.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = only(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.length(text).cast("bigint").alias("chars"),
    )
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "digest", "_tie").drop("_tie")
    dealt = materialize(dealt.withColumn("block", F.spark_partition_id()))
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("conv_id", "block", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "digest")
    placed = dealt.withColumn("_at", F.row_number().over(inside)).join(counts, ["conv_id", "block"])
    return placed.select("conv_id", (F.col("_ahead") + F.col("_at")).alias("pos"), "block", "digest", "chars")


def rebuild(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Put the first turns of one conversation in front of another's later ones.

    ``turns`` as of ``number_turns``, stored. ``base`` and ``head`` are computed from ``conv_id``: a conversation gets the first
    ``head`` turns (at most ``MOST_HEAD``) of conversation ``base``, all if there are fewer and none if it is absent, and then its
    own turns after its first ``head``. Returns the rebuilt turns and one row (``conv_id``, ``n_turns``) for every conversation,
    also one that is left without turns.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("size")).withColumns({"base": base, "head": head})
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("_base_size"))
    every = sizes.join(bases, "base", "left").withColumn("lent", F.least("head", F.coalesce("_base_size", F.lit(0))))
    every = materialize(every.select("conv_id", "base", "lent", "head", (F.col("lent") + F.greatest(F.col("size") - F.col("head"), F.lit(0))).alias("n_turns")))

    heads = turns.filter(F.col("pos") <= MOST_HEAD).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    lent = every.select("conv_id", "base", "lent").join(heads, "base").filter("pos <= lent")
    lent = lent.select("conv_id", "pos", F.lit(-1).alias("block"), "digest", "chars")
    # Own turns: joined by block too, so that a long conversation stays spread.
    blocks = turns.groupBy("conv_id", "block").agg(F.max("pos").alias("_last"))
    blocks = blocks.join(every, "conv_id").select("conv_id", "block", "lent", "head")
    own = turns.join(blocks, ["conv_id", "block"]).filter(F.col("pos") > F.col("head"))
    own = own.select("conv_id", (F.col("pos") - F.col("head") + F.col("lent")).alias("pos"), "block", "digest", "chars")
    return lent.unionByName(own), every.select("conv_id", "n_turns")


def _node(pos: Column, a: Column, b: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws("/", pos, a, b).cast("binary")))


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, chars``: every turn with the key of all turns up to it and of those before it."""
    each = materialize(turns.withColumns({k: F.xxhash64(F.lit(k), "pos", "digest") for k in ("a", "b")}))
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = each.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    carried = [F.coalesce(F.bit_xor(k).over(ahead), F.lit(0)).alias(f"_{k}") for k in ("a", "b")]
    sums = sums.select("conv_id", "block", *carried)
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = each.withColumns({f"_in_{k}": F.bit_xor(k).over(upto) for k in ("a", "b")}).join(sums, ["conv_id", "block"])
    a, b = (F.col(f"_in_{k}").bitwiseXOR(F.col(f"_{k}")) for k in ("a", "b"))
    before = F.col("pos") - 1, a.bitwiseXOR(F.col("a")), b.bitwiseXOR(F.col("b"))
    return run.select("conv_id", F.col("pos").alias("depth"), _node(F.col("pos"), a, b).alias("node"), _node(*before).alias("parent"), "chars")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted members of one node as text, with the first id of each."""
    node, ids = None, []

    def row():
        return pa.RecordBatch.from_pydict(
            {"node": pa.array([node], pa.binary()), "first": pa.array([ids[0]], pa.int64()), "ids": [",".join(map(str, ids))]}
        )

    for b in batches:
        nodes, convs, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
        for n, c in zip(nodes, convs, strict=True):
            if n != node or len(ids) == SEGMENT_IDS:
                if ids:
                    out.append(row())
                node, ids = n, []
            ids.append(c)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield row()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its segments in order; only the state of the hash is held."""
    import hashlib

    node, state = None, None
    for b in batches:
        done: dict[str, list] = {"node": [], "ends_sha256": []}
        for n, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            if n != node:
                if state is not None:
                    done["node"].append(node)
                    done["ends_sha256"].append(state.hexdigest())
                node, state = n, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done["node"]:
            yield pa.RecordBatch.from_pydict({"node": pa.array(done["node"], pa.binary()), "ends_sha256": done["ends_sha256"]})
    if state is not None:
        yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "ends_sha256": [state.hexdigest()]})


def end_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of (node, conv_id) rows: the decimal ids of a node, ascending, joined by commas, hashed.

    The ids of a node that many conversations end at are written out by ranges, in many tasks; the hash itself runs through
    those pieces one after the other, holding one of them at a time.
    """
    pieces = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = pieces.mapInArrow(_segments, "node binary, first bigint, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node binary, ends_sha256 string")


def _above(sums: list[str]) -> list[str]:
    """Columns with the sums of the nodes taken out between a node and its parent."""
    return [f"above_{c}" for c in sums]


def _mark(alive: DataFrame, sums: list[str]) -> DataFrame:
    """Nodes with the number of their children, ``kids``, and of the one child where there is one its key ``only`` and the sums above
    it, ``to_<sum>``."""
    below = alive.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    kids = below.agg(F.count(F.lit(1)).alias("kids"), F.min("node").alias("only"), *[F.sum(f"above_{c}").alias(f"to_{c}") for c in sums])
    return alive.join(kids, "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def _compress(alive: DataFrame, sums: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """Take out all nodes with one child: what is left of the tree, and the nodes taken, each with the first node below it that
    stays (``end``) and the sums from itself to just above that. An end keeps the sums of its whole chain for its new parent.

    A link is a taken node and one below it. A closed link ends at a node that stays. An open link is joined with the link that
    starts at its end, so its reach doubles. Ends of open links are distinct, so no side of a join holds a key twice.
    """
    through = [(F.col(c) + F.col(f"to_{c}")).alias(c) for c in sums]
    links = alive.filter("kids = 1").select("node", F.col("only").alias("end"), *through)
    taken = links.select(F.col("node").alias("end"), F.lit(True).alias("_more"))
    last = materialize(links.join(taken, "end", "left").select("node", "end", *sums, F.col("_more").isNull().alias("closed")))
    if last.isEmpty():
        return None
    tops = last.select("node").join(last.select(F.col("end").alias("node")), "node", "left_anti")
    tops = alive.join(tops, "node", "left_semi").select("node", F.col("parent").alias("_up"), *_above(sums))
    closed = []
    while True:
        closed.append(last.filter("closed"))
        far = last.filter("NOT closed")
        if far.isEmpty():
            break
        below = _all([*closed, far])
        below = below.select(F.col("node").alias("end"), F.col("end").alias("_end"), "closed", *[F.col(c).alias(f"_{c}") for c in sums])
        joined = far.drop("closed").join(below, "end")
        last = materialize(joined.select("node", F.col("_end").alias("end"), *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums], "closed"))
    chains = _all(closed).drop("closed")
    moved = chains.join(tops, "node").select(
        F.col("end").alias("node"), "_up", F.lit(True).alias("_moved"), *[(F.col(c) + F.col(f"above_{c}")).alias(f"_{c}") for c in sums]
    )
    left = alive.filter("kids <> 1").join(moved, "node", "left")
    new = [F.when(F.col("_moved"), F.col(f"_{c}")).otherwise(F.col(f"above_{c}")).alias(f"above_{c}") for c in sums]
    parent = F.when(F.col("_moved"), F.col("_up")).otherwise(F.col("parent"))
    return materialize(left.select("node", parent.alias("parent"), *sums, *new, "kids")), chains


def subtree_sums(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """``node`` and the named columns summed over its whole subtree, itself included, of a forest (``node, parent``, null at a top).

    Nodes are distinct and every parent is a node. Values are integers, not null.
    """
    above = _above(sums)
    alive = materialize(_mark(nodes.select("node", "parent", *sums, *[F.lit(0).cast("bigint").alias(c) for c in above]), sums))
    raked, taken = [], []
    while True:
        leaves = alive.filter("kids = 0")
        raked.append(leaves.select("node", *sums))
        inner = alive.filter("kids > 0").select("node", "parent", *sums, *above)
        if inner.isEmpty():
            break
        given = leaves.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.col(c) + F.col(f"above_{c}")).alias(f"_{c}") for c in sums]
        )
        inner = inner.join(given, "node", "left")
        inner = inner.select("node", "parent", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums], *above)
        alive = materialize(_mark(inner, sums))
        if (got := _compress(alive, sums)) is not None:
            alive, chains = got
            taken.append(chains)
    totals = _all(raked)
    for chains in reversed(taken):
        ends = totals.select(F.col("node").alias("end"), *[F.col(c).alias(f"_{c}") for c in sums])
        found = lookup(chains, ends, "end")
        found = materialize(found.select("node", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums]))
        totals = totals.unionByName(found)
    return totals


def prefix_trie(turns: DataFrame, every: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``turns`` has ``conv_id, pos, block, digest, chars`` (see ``number_turns``), ``every`` one row (``conv_id, n_turns``) for each
    conversation, which is a member of the textless root even without turns. ``saved_tokens`` sums, over a node's subtree, the code
    points of a node's last text times its members beyond the first; ``ends_sha256`` tells who ends at the node. Without
    conversations there are no nodes.
    """
    root = F.unhex(F.md5(F.lit("0/0/0").cast("binary")))
    rows = prefixes(turns)
    below = rows.groupBy("node").agg(
        F.min("depth").cast("bigint").alias("depth"), F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
    )
    top = every.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    top = top.select(
        root.alias("node"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        "conv_id", "n_convs", F.lit(0).cast("bigint").alias("chars"),
    )
    nodes = materialize(below.unionByName(top))
    kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    weighed = nodes.select(
        "node", "parent", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")
    )
    totals = subtree_sums(weighed, ["n_leaves", "saved_tokens"])

    ends = rows.join(every, "conv_id").filter("depth = n_turns").select("node", "conv_id")
    ends = end_digests(ends.unionByName(every.filter("n_turns = 0").select(root.alias("node"), "conv_id")))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = lookup(nodes, parents, "parent", "inner").unionByName(nodes.filter("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
    found = found.join(totals, "node").join(ends, "node", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
