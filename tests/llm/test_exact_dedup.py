import hashlib
import uuid

import pytest

from barflow.llm.exact_dedup import DigestIndex, exact_dedup, scratch_index

KEYS = ("doc_id", "keep_id", "group_size", "kept")


def _rows(df):
    return sorted(df.select(*KEYS).collect(), key=str)


def test_largest_id_stays_and_null_is_empty(spark, docs_of):
    docs = docs_of([(1, "a"), (5, "a"), (3, "A"), (2, None), (4, ""), (9, "b ")])
    found = exact_dedup(docs, scratch_index(spark, 4), "b1")
    assert {c.lower() for c in docs.columns} <= {c.lower() for c in found.columns}
    assert _rows(found) == _rows(
        spark.createDataFrame(
            [(1, 5, 2, False), (5, 5, 2, True), (3, 3, 1, True), (2, 4, 2, False), (4, 4, 2, True), (9, 9, 1, True)],
            "doc_id bigint, keep_id bigint, group_size bigint, kept boolean",
        )
    )
    digests = {r["doc_id"]: r["text_sha256"] for r in found.collect()}
    assert digests[1] == hashlib.sha256(b"a").hexdigest() and digests[2] == hashlib.sha256(b"").hexdigest()


def test_repeated_rows_and_null_ids_keep_one(spark, docs_of):
    found = exact_dedup(docs_of([(1, "a"), (1, "a"), (None, "n"), (None, "n"), (None, "a")]), scratch_index(spark, 4), "b")
    got = [(r["doc_id"], r["kept"], r["group_size"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(
        [(1, True, 3), (1, False, 3), (None, False, 3), (None, True, 2), (None, False, 2)], key=str
    )


def test_index_outlives_its_object_and_batches_repeat(spark, docs_of, tmp_path):
    name = f"kept_{uuid.uuid4().hex}"
    first = DigestIndex(spark, name, str(tmp_path / name), 4)
    assert _rows(exact_dedup(docs_of([(1, "a"), (2, "b")]), first, "one")) == [(1, 1, 1, True), (2, 2, 1, True)]
    again = DigestIndex(spark, name, str(tmp_path / name), 4)
    new = docs_of([(7, "b"), (8, "c"), (9, "c"), (10, None)])
    expected = [(10, 10, 1, True), (7, 2, 1, False), (8, 9, 2, False), (9, 9, 2, True)]
    assert _rows(exact_dedup(new, again, "two")) == expected
    assert _rows(exact_dedup(new, again, "two")) == expected
    assert again.table().count() == 4


def test_empty_batch(spark, docs_of):
    assert exact_dedup(docs_of([]), scratch_index(spark, 4), "b").count() == 0


def test_index_side_is_not_shuffled(spark, docs_of):
    index = scratch_index(spark, 4)
    groups = spark.createDataFrame([(b"x", 1)], "digest binary, keep_id bigint")
    index.append(groups, "b")
    plan = groups.join(index.table().select("digest").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1


def test_name_is_checked(spark):
    with pytest.raises(ValueError):
        DigestIndex(spark, "a; DROP", "/tmp/x")
