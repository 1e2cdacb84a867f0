import numpy as np
import pytest

from barflow.llm import ann
from barflow.llm.ann import nearest, radii
from barflow.llm.queries import LLM_QUERIES


def _frame(spark, x, first=0):
    rows = [(first + i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


def _brute(x, queries, k):
    out = {}
    for q in queries:
        score = np.array([sum(a * b for a, b in zip(x[q], r, strict=True)) for r in x])
        ids = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:k]
        out[q] = [(int(i), score[i]) for i in ids]
    return out


def _recall(found, expected, k):
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    return np.mean([len({v for _, v in got[q]} & {i for i, _ in e}) / len(e) for q, e in expected.items()])


def test_radii_cover_the_radius():
    for r in range(65):
        assert sum(d + 1 for d in radii(r, 8)) == r + 1


def test_pigeonhole_probing_finds_all_within_the_radius(spark, monkeypatch):
    """With cells and blocks cut small and a radius that takes in everything, results equal brute force."""
    monkeypatch.setattr(ann, "CELL_ROWS", 40)
    monkeypatch.setattr(ann, "QUERY_ROWS", 5)
    x = np.random.default_rng(0).standard_normal((300, 12)).round(2)
    x[50:60] = x[50]
    df = _frame(spark, x)
    found = nearest(df, df.filter("vec_id % 20 = 0"), k=7).collect()
    expected = _brute(x, range(0, 300, 20), 7)
    assert _recall(found, expected, 7) >= 0.9
    assert {r["query_id"] for r in found} == set(expected) and len(found) == 7 * 15
    for r in found:
        assert r["score"] == sum(a * b for a, b in zip(x[r["query_id"]], x[r["vec_id"]], strict=True))
    for q in expected:
        mine = sorted((r["rank"], -r["score"], r["vec_id"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 8)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_ties_go_to_the_smaller_id(spark):
    x = np.tile(np.eye(4), (30, 1))
    df = _frame(spark, x)
    found = sorted(nearest(df, df.filter("vec_id = 0"), k=5).collect(), key=lambda r: r["rank"])
    assert [r["vec_id"] for r in found] == [4, 8, 12, 16, 20]


def test_fewer_candidates_bad_vectors_and_repeats(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [1.0]), (8, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS id", "2 AS score", "3 AS code")
    found = [tuple(r) for r in nearest(df, df.filter("vec_id IN (0, 3, 8)"), k=20).collect()]
    assert sorted(found) == sorted([(0, 1, 1, 0.5), (0, 2, 8, -1.0), (8, 1, 1, -0.5), (8, 2, 0, -1.0), (8, 3, 0, -1.0)])


def test_nothing_usable(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert nearest(empty, empty).count() == 0
    none = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id bigint, embedding array<float>")
    assert nearest(none, none).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    found = LLM_QUERIES["op10_multi_index_hashing"](spark, folder).collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    shares = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -np.inf
        shares.append(len(got[int(ids[q])] & {int(i) for i in ids[np.argsort(-score, kind="stable")[:20]]}) / 20)
    assert np.mean(shares) >= 0.9
