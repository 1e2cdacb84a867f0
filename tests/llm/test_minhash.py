import random
import re
from math import comb

import pytest

import corpus_pipeline
from barflow.llm import minhash
from barflow.llm.components import components
from barflow.llm.minhash import bounds, near_duplicates


def _shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def _brute(rows, percent=85):
    sets = [(i, _shingles(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= percent * (len(sets[a][1]) + len(sets[b][1]) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)], i == least[find(k)]) for k, (i, s) in enumerate(sets))


def _got(df, docs_of, rows):
    return sorted(tuple(r) for r in near_duplicates(docs_of(rows)).collect())


def _corpus(seed, groups=12, copies=8):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 4000)}"
    line = [word() for _ in range(30)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([4, 6, 20, 80, 300]))] + (line if g % 2 else [])
        for _ in range(copies):
            new = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
                new[rng.randrange(len(new))] = word()
            rows.append((len(rows), " ".join(new).upper() if rng.random() < 0.2 else "\n".join(new)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, docs_of, seed):
    rows = _corpus(seed)
    assert _got(spark, docs_of, rows) == _brute(rows)


def test_chain_across_a_group(spark, docs_of):
    """Every text is near to the next alone: one component, though its ends share nothing."""
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 4 : i * 4 + 100])) for i in range(40)]
    expected = _brute(rows)
    assert len({r[2] for r in expected}) < 40
    assert _got(spark, docs_of, rows) == expected


def test_short_empty_null_and_repeated(spark, docs_of):
    rows = [(1, "A b"), (2, "a  B\n"), (3, "b a"), (4, ""), (5, None), (6, " \t"), (7, "one two three four five"), (7, "one two three four five")]
    assert _got(spark, docs_of, rows) == sorted(
        [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True), (7, 1, 7, True)]
    )
    found = near_duplicates(docs_of([(None, "x y"), (None, None), (3, "x y")])).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(None, 1, 3, False), (None, 0, None, False), (3, 1, 3, True)], key=str)
    assert near_duplicates(docs_of([])).count() == 0


def test_no_row_per_pair_of_a_large_group(spark, docs_of):
    base = [f"g{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"tail{i}"])) for i in range(300)]
    found = near_duplicates(docs_of(rows)).collect()
    assert {r["component_id"] for r in found} == {0}


def test_one_text_of_a_very_long_document(spark, docs_of):
    long = " ".join(f"l{i}" for i in range(200_000))
    assert _got(spark, docs_of, [(1, long), (2, long + " end")]) == [(1, 199_996, 1, True), (2, 199_997, 1, False)]


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (200, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a int, b int")).collect()))
    assert found == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_lower_thresholds_are_refused(docs_of):
    with pytest.raises(ValueError):
        near_duplicates(docs_of([]), percent=50)


def test_pairs_from_80_to_85_percent(spark, docs_of):
    """Pairs of 200 shingles each that share 178 to 183 of them, 0.802 to 0.843 alike, and 177, which is 0.794."""
    rows, expected = [], []
    for k in range(60):
        own = 177 + k % 7
        base = [f"p{k}x{i}" for i in range(204)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join([*base[: own + 4], *[f"q{k}x{i}" for i in range(200 - own)]]))]
        linked = 100 * own >= 80 * (400 - own)
        assert linked == (own > 177) and 100 * own < 85 * (400 - own)
        expected += [(2 * k, 200, 2 * k, True), (2 * k + 1, 200, 2 * k + (not linked), not linked)]
    assert sorted(map(tuple, near_duplicates(docs_of(rows), percent=80).collect())) == expected
    assert all(r["kept"] for r in near_duplicates(docs_of(rows)).collect())
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r["doc_id"] for r in stage(spark, docs_of(rows), "").collect()) == [r[0] for r in expected if r[3]]


def test_bounds_miss_one_pair_in_a_million():
    assert bounds(85) == (16, 393)
    for percent in (80, 85, 90):
        matches, far = bounds(percent)
        p, q = percent / 100, (100 - percent) / 200
        below = [sum(comb(32, i) * p**i * (1 - p) ** (32 - i) for i in range(m)) for m in (matches, matches + 1)]
        assert below[0] < 1e-6 <= below[1]
        assert 4096 * q + 4.5 * (4096 * q * (1 - q)) ** 0.5 < far < 4096 * q + 5.2 * (4096 * q * (1 - q)) ** 0.5


def test_near_copies_that_few_of_their_group_are_linked_to(spark, docs_of, monkeypatch):
    """Copies of one text with two changes each are linked through the few with one change; not every pair is compared."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(300):
        new = list(base)
        for at in rng.sample(range(4, 146), 1 if i % 30 == 29 else 2):
            new[at] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(new)))
    compared, confirm = [], minhash._confirm
    monkeypatch.setattr(minhash, "_confirm", lambda pairs, *rest: compared.append(pairs.count()) or confirm(pairs, *rest))
    found = sorted(tuple(r) for r in near_duplicates(docs_of(rows), percent=80).collect())
    assert found == _brute(rows, 80)
    assert sum(compared) < 30 * len(rows)


def test_the_most_central_copy_is_the_pivot(spark, docs_of, monkeypatch):
    """Copies with two changes each are linked through the unchanged text, whose id is the largest; the first comparison finds it."""
    rng = random.Random(6)
    base = [f"w{k}" for k in range(150)]
    rows = [(300, " ".join(base))]
    for i in range(300):
        new = list(base)
        for at in rng.sample(range(4, 146), 2):
            new[at] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(new)))
    compared, confirm = [], minhash._confirm
    monkeypatch.setattr(minhash, "_confirm", lambda pairs, *rest: compared.append(pairs.count()) or confirm(pairs, *rest))
    found = near_duplicates(docs_of(rows), percent=80).collect()
    assert {r["component_id"] for r in found} == {0}
    assert sum(compared) < 4 * len(rows)
