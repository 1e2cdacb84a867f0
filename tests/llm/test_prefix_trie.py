"""The trie against a plain one in Python, and tree contraction against a walk."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from barflow.llm import prefix_trie as module
from barflow.llm.prefix_trie import number_turns, prefix_trie, rebuild, subtree_sums
from barflow.llm.queries import LLM_QUERIES
from barflow.session import materialize

KIND = "conv_id bigint, turn bigint, role string, text string, node string, pos int"


def _plain(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:]
    nodes, kids, leaves, saved = {}, {}, {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    for k in nodes:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] = leaves.get(k[:d], 0) + (k not in kids)
            saved[k[:d]] = saved.get(k[:d], 0) + (len(members) - 1) * (len(k[-1][1]) if k else 0)
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(k))
        up = min(nodes[k[:-1]]) if k else None
        out.append((min(members), len(k), up, len(members), kids.get(k, 0), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _built(spark, rows):
    df = spark.createDataFrame([(*r, "n", 3) for r in rows], KIND)
    turns = materialize(number_turns(df))
    return rebuild(turns, F.expr("conv_id - conv_id % 100"), F.expr("crc32(CAST(CAST(conv_id AS string) AS binary)) % 6"))


def _got(spark, rows):
    return sorted(map(tuple, prefix_trie(*_built(spark, rows)).collect()), key=str)


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [
        (100, 0, "user", "hi"), (100, 1, "assistant", "hello"), (100, 2, "user", None), (101, 0, "user", "hi"), (101, None, None, "x"),
        (101, 1, "assistant", "hello"), (102, 0, "user", "lone"), (203, 0, "user", "no base"), (204, 0, None, None), (205, 3, "", ""),
        (7, 1, "a", "b"), (7, 1, "a", "b"), (7, 1, "a", "c"), (-5, 0, "u", "é🎉"), (-105, 0, "u", "é🎉"), (0, 0, "u", "é🎉"),
        (None, 0, "user", "nobody"), (50, 0, "user", "y" * 200_000), (50, 1, "user", ","), (300, 0, "r", "1:a"), (301, 0, "r1", ":a"),
    ]
    assert _got(spark, rows) == _plain(rows)
    assert any(r[1] == 0 and r[3] > 0 for r in _plain(rows))


def test_empty_table(spark):
    assert _got(spark, []) == []


def test_one_long_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(module, "SEGMENT_IDS", 7)
    rng = random.Random(4)
    rows = [(900, t, "u", f"t{t}") for t in range(400)]
    rows += [(c, t, "u", f"t{t}") for c in range(901, 1000) for t in range(rng.randrange(0, 9))]
    rows += [(c, t, "u", "same") for c in range(2000, 2300) for t in range(3)]
    assert _got(spark, rows) == _plain(rows)


def _walk(parent, value):
    total = dict(value)
    depth = {}

    def deep(v):
        path = []
        while v is not None and v not in depth:
            path.append(v)
            v = parent[v]
        d = -1 if v is None else depth[v]
        for u in reversed(path):
            d += 1
            depth[u] = d

    for v in parent:
        deep(v)
    for v in sorted(parent, key=lambda v: -depth[v]):
        if parent[v] is not None:
            total[parent[v]] += total[v]
    return total


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest", "caterpillar", "binary"])
def test_contraction_on_any_tree(spark, shape):
    rng = random.Random(9)
    n = 300
    if shape == "forest":
        up = {i: None if i % 50 == 0 else rng.randrange(i - i % 50, i) for i in range(n)}
    else:
        up = {i: {"chain": i - 1, "star": 0, "random": rng.randrange(i) if i else 0, "caterpillar": i - 1 if i % 2 else i - 2, "binary": (i - 1) // 2}[shape] for i in range(1, n)}
        up = {0: None, **{i: max(p, 0) for i, p in up.items()}}
    value = {i: rng.randrange(1, 100) for i in up}
    rows = [(bytes([i // 256, i % 256]), None if p is None else bytes([p // 256, p % 256]), value[i]) for i, p in up.items()]
    df = spark.createDataFrame(rows, "node binary, parent binary, w bigint")
    found = {r["node"][0] * 256 + r["node"][1]: r["w"] for r in subtree_sums(df, ["w"]).collect()}
    assert found == _walk(up, value)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, LLM_QUERIES["op13_prefix_trie"](spark, small).collect()), key=str) == _plain(rows)
