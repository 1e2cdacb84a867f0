"""Collocations against a plain count in Python; the registered query also runs against its SQL."""

import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barflow.llm.collocations import collocations, phrase_counts


def _plain(rows, longest=3, least=10, top=2000, cover=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f["und" if lang is None else lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cands.items():
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            covered = any(
                len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in cands.items()
            )
            if not covered:
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def _got(spark, rows, **kw):
    df = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, f int, window string")
    return sorted(map(tuple, collocations(df, **kw).collect()))


ROWS = [
    ("en", "New York city is New York City. new york, NEW\tYORK  city; the city\nnew york"),
    ("en", "a a a a a a a a a a a a"), ("en", "a a a a b"), (None, "x y. x y. x y! x y? x y:x y\vx y\fx y\rx y x y x y"), ("und", "x y"),
    ("de", None), ("de", ""), ("fr", "É é É é É é é é é é é é é"), ("fr", " \t . , "),
]


@pytest.mark.parametrize("least", [1, 2, 10])
def test_small(spark, least):
    assert _got(spark, ROWS * 3, least=least) == _plain(ROWS * 3, least=least)


def test_longer_phrases_and_top(spark):
    kw = {"longest": 5, "least": 2, "top": 3}
    assert _got(spark, ROWS, **kw) == _plain(ROWS, **kw)
    with pytest.raises(ValueError):
        collocations(spark.createDataFrame(ROWS, "lang string, text string"), longest=1)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["en", None]), st.text(alphabet="ab \t.\n", max_size=60)), max_size=8))
def test_any_text(spark, rows):
    assert _got(spark, rows, least=2) == _plain(rows, least=2)


def test_one_frequent_word_and_a_long_text(spark):
    rows = [("en", "the w%d the " % (i % 7) * 30) for i in range(40)] + [("en", "of the sea " * 20_000)]
    assert _got(spark, rows) == _plain(rows)


def test_exact_beyond_64_bits(spark):
    """A score's product passes 64 bits; the counts are put in by hand."""
    from barflow.llm import collocations as module

    big = [("en", 0, "", 10**15), ("en", 1, "a", 10**13 + 1), ("en", 1, "b", 10**13 + 3), ("en", 2, "a b", 10**13)]
    made = spark.createDataFrame(big, "lang string, size int, phrase string, f bigint")
    kept = module.phrase_counts
    module.phrase_counts = lambda *a: made
    try:
        (row,) = collocations(spark.createDataFrame([], "lang string, text string")).collect()
    finally:
        module.phrase_counts = kept
    assert row["score"] == 10**6 * 10**26 // ((10**13 + 1) * (10**13 + 3))


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_lots_and_lengths(spark, monkeypatch, longest):
    from barflow.llm import collocations as module

    monkeypatch.setattr(module, "COMBINED", 5)
    assert _got(spark, ROWS, longest=longest, least=2) == _plain(ROWS, longest=longest, least=2)


def test_empty_table_and_one_shuffle_of_windows(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations(df).count() == 0
    df = spark.createDataFrame(ROWS, "lang string, text string")
    counts = phrase_counts(df, 3, 10)
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("MapInArrow") == 1 and plan.count("ReusedExchange") == 2 and plan.count("Expand") == 1


def test_windows_are_made_and_counted_in_one_step(spark):
    """They were made by exploding arrays of words, a row for each word, and counted after that, which took op12 over its budget."""
    import numpy as np
    import pyarrow as pa

    from barflow.llm.collocations import _count, _windows

    lang = pa.array(["en", "en", "de", "en", "en"])
    texts = pa.array(["A b\tc", None, " é;É x  y", "", "c. a b c!a"])
    batch = pa.RecordBatch.from_arrays([lang, texts], names=["lang", "text"]).slice(0, 5)
    got = {(r["lang"], r["window"]): r["n"] for b in _count(3)(iter([batch.slice(0, 2), batch.slice(2)])) for r in b.to_pylist()}
    assert got == {("en", "a b c"): 2, ("en", "b c"): 2, ("en", "c"): 3, ("en", "a"): 1, ("de", "é"): 1, ("de", "É x y"): 1, ("de", "x y"): 1, ("de", "y"): 1}
    plan = phrase_counts(spark.createDataFrame(ROWS, "lang string, text string"), 3, 10)._jdf.queryExecution().executedPlan().toString()
    assert "arrays_zip" not in plan

    # Beginnings of long windows of many words, whose numbers pass 64 bits together, get numbers of their own.
    words = [f"w{i % 3000}" for i in range(6000)]
    (made,) = _windows(pa.array(["en"] * 6000).dictionary_encode(), pa.array(words, pa.large_string()).dictionary_encode(), np.zeros(6000, np.int64), 9)
    assert made.num_rows == 3000 + 8 and set(made.column(1).to_pylist()) == {" ".join(words[i : i + 9]) for i in range(6000)}
