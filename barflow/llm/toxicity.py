"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

P(grade > k) is the logistic function of one score, shared by all thresholds, less the k-th of the ordered thresholds. The score
of a text adds up the weights of its words' features (the word, and its first three, four and five letters), so a
text is scored in one pass with a memory of word scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import column, only

#: Hashed features, and how many of them the model keeps: those that mark toxic rows best.
FEATURES, SELECTED = 1 << 22, 4096
#: Rows fitted at most: so many toxic and so many clean ones, those of least hash. A bound on the labelled sample alone.
FIT_ROWS = 3000
#: A feature is used if so many fitted toxic texts, and such a share of them, have it: so many times its share among clean ones.
LEAST_TEXTS, LEAST_SHARE, LIFT = 3, 0.005, 20.0
#: Distinct words whose score a task remembers.
REMEMBERED = 500_000
#: Severity above the clean grade 0: 1 up to as many grades.
GRADES = 3

_WORD = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word."""
    parts = {word, *(f"^{word[:k]}" for k in (3, 4, 5) if len(word) > k)}
    return sorted({xxhash.xxh3_64_intdigest(p) % FEATURES for p in parts})


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text, ascending, and how often each occurs."""
    words, times = np.unique(np.array(_WORD.findall((text or "").lower()), dtype=object), return_counts=True)
    found = [features(w) for w in words]
    flat = np.fromiter((f for x in found for f in x), np.int64)
    ids, at = np.unique(flat, return_inverse=True)
    return ids, np.bincount(at, weights=np.repeat(times, [len(x) for x in found]), minlength=len(ids))


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of the selected features and ascending thresholds, one fewer than there are grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) per score and threshold."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _texts_with(docs: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features that occur, ascending, and in how many toxic and clean texts; the memory is that of two tables of all features."""
    both = np.zeros((2, FEATURES), np.int32)
    for d, t in zip(docs, toxic, strict=True):
        both[int(t), d] += 1
    ids = np.flatnonzero(both.any(axis=0))
    return ids, both[1, ids].astype(float), both[0, ids].astype(float)


def _select(docs: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Features by which toxic texts stand out: in at least ``LIFT`` times the share of them, best likelihood ratio first.

    What is commoner in clean texts is left out, or else enough harmless words could outweigh any abuse.
    """
    ids, a, b = _texts_with(docs, toxic)
    na, nb = toxic.sum(), (1 - toxic).sum()

    def part(x, n, share):
        with np.errstate(divide="ignore", invalid="ignore"):
            yes, no = x * np.log(x / (n * share)), (n - x) * np.log((n - x) / (n * (1 - share)))
        return np.nan_to_num(yes) + np.nan_to_num(no)

    share = (a + b) / (na + nb)
    gain = part(a, na, share) + part(b, nb, share)
    telling = (a >= np.maximum(LEAST_TEXTS, LEAST_SHARE * na)) & (a / na >= LIFT * (b + 0.5) / nb)
    best = np.lexsort((ids, -gain))
    return np.sort(ids[best[telling[best]][:SELECTED]])


def severity(docs: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Grades for rows that are labelled toxic or clean only: 0 for clean, 1 to ``grades`` by equal parts of the toxic rows.

    They are ordered by how often the features occur that ``LEAST_TEXTS`` toxic and no clean texts have.
    """
    ids, a, b = _texts_with([d[0] for d in docs], toxic)
    marks = ids[(a >= LEAST_TEXTS) & (b == 0)]
    mass = np.array([n[np.isin(i, marks, assume_unique=True)].sum(dtype=float) for i, n in docs])
    cuts = np.quantile(mass[toxic == 1], [k / grades for k in range(1, grades)]) if toxic.any() else []
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, mass, side="left"), 0)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, levels: int, l2: float = 3e-4, steps: int = 400) -> OrdinalModel:
    """Least penalised negative log likelihood by adaptive gradient steps over all given rows.

    Without rows above grade 0, or without rows of grade 0, there is nothing to tell apart: all scores are 0, and every
    threshold lies high up, or low down.
    """
    toxic = (grades > 0).astype(float)
    if not len(grades) or toxic.all() or not toxic.any():
        side = -20.0 if len(grades) and toxic.all() else 20.0
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), side + np.arange(levels) * 0.1)
    chosen = _select([d[0] for d in docs], toxic)
    rows, cols, vals = [], [], []
    for r, (ids, n) in enumerate(docs):
        here = np.searchsorted(chosen, ids)
        hit = (here < len(chosen)) & (chosen[np.minimum(here, len(chosen) - 1)] == ids) if len(chosen) else np.zeros(len(ids), bool)
        rows.append(np.full(hit.sum(), r))
        cols.append(here[hit])
        vals.append(np.log1p(n[hit].astype(float)))
    row, col, val = np.concatenate(rows), np.concatenate(cols).astype(np.int64), np.concatenate(vals)
    weight = np.where(toxic == 1, 0.5 / toxic.sum(), 0.5 / (1 - toxic).sum())
    w, first, gaps = np.zeros(len(chosen)), 0.5, np.zeros(levels - 1)
    moment = [np.zeros(len(chosen) + levels), np.zeros(len(chosen) + levels)]
    for t in range(1, steps + 1):
        theta = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, weights=val * w[col], minlength=len(docs))
        upper = np.concatenate([np.ones((len(docs), 1)), _logistic(score[:, None] - theta)], axis=1)
        lower = np.concatenate([upper[:, 1:], np.zeros((len(docs), 1))], axis=1)
        at = np.arange(len(docs)), grades
        p = np.maximum(upper[at] - lower[at], 1e-9)
        slope_up, slope_low = upper[at] * (1 - upper[at]), lower[at] * (1 - lower[at])
        by_score = -weight * (slope_up - slope_low) / p
        by_theta = np.zeros(levels + 2)
        np.add.at(by_theta, grades, weight * slope_up / p)
        np.add.at(by_theta, grades + 1, -weight * slope_low / p)
        by_theta = by_theta[1 : levels + 1]
        by_gap = np.cumsum(by_theta[::-1])[::-1][1:] * np.exp(gaps)
        grad = np.concatenate([np.bincount(col, weights=val * by_score[row], minlength=len(chosen)) + l2 * w, [by_theta.sum()], by_gap])
        moment[0] = 0.9 * moment[0] + 0.1 * grad
        moment[1] = 0.99 * moment[1] + 0.01 * grad**2
        step = 0.05 * (moment[0] / (1 - 0.9**t)) / (np.sqrt(moment[1] / (1 - 0.99**t)) + 1e-8)
        w, first, gaps = w - step[: len(w)], first - step[len(w)], gaps - step[len(w) + 1 :]
    return OrdinalModel(chosen, w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def _sample(docs: DataFrame, labels: DataFrame, rows: int, id: str, text: str, label: str) -> list[tuple]:
    """At most ``rows`` labelled documents for each of: label 0, label above 0."""
    marks = only(labels, id, label).toDF("id", "label").filter("id IS NOT NULL AND label IS NOT NULL")
    marks = marks.groupBy("id").agg(F.max("label").cast("int").alias("label"))
    some = [
        marks.filter(c).orderBy(F.xxhash64("id"), "id").limit(rows) for c in ("label = 0", "label > 0")
    ]
    texts = only(docs, id, text).toDF("id", "text")
    found = texts.join(F.broadcast(some[0].union(some[1])), "id").dropDuplicates(["id"]).select("id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [counts(t.as_py()) for t in b.column(1)]
            ids = pa.array([m[0].astype(np.int32) for m in made], pa.list_(pa.int32()))
            times = pa.array([m[1].astype(np.float32) for m in made], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), ids, times], names=["id", "label", "features", "times"])

    kind = texts.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"id {kind}, label int, features array<int>, times array<float>").toArrow()


def train(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, id: str = "doc_id", text: str = "text", label: str = "toxic",
    graded: bool = False, grades: int = GRADES,
) -> OrdinalModel:
    """Fit the model on labelled documents: at most ``rows`` of them with label 0 and ``rows`` with a label above.

    With ``graded`` the label is the grade, from 0 to ``grades``; else it says toxic or not, and ``severity`` grades the
    toxic rows. Rows with a null id or label are left out; of several labels of an id the largest holds, of
    several texts of an id any one. Labels without a document, or no labels at all, are fine.
    """
    found = _sample(docs, labels, rows, id, text, label).sort_by("id")
    marks = found.column("label").to_numpy().astype(np.int64)
    pairs = zip(found.column("features"), found.column("times"), strict=True)
    sample = [(f.values.to_numpy(), t.values.to_numpy()) for f, t in pairs]
    if not len(marks):
        return fit([], marks, grades)
    return fit(sample, np.minimum(marks, grades) if graded else severity(sample, (marks > 0).astype(int), grades), grades)


def grade(docs: DataFrame, model: OrdinalModel, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Replace the text by (with ``keep_text``: add) ``expected_severity`` (mean grade), ``grade`` (thresholds passed with probability one half or
    more) and ``toxic`` (grade above 0).

    A null text is an empty one; without a known feature the score is 0. Columns called like the new ones are
    replaced, all others stay. No rows give no rows.
    """
    out = ("expected_severity", "grade", "toxic")
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), *out)]
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights, thresholds = shared.value
        known = dict(zip(ids.tolist(), range(len(ids)), strict=True))

        class Hits(dict):
            """Selected features of the words met."""

            def __missing__(self, word):
                if len(self) > REMEMBERED:
                    self.clear()
                self[word] = hit = tuple(known[f] for f in features(word) if f in known)
                return hit

        hits = Hits()
        for b in batches:
            scores = np.zeros(b.num_rows)
            for i, t in enumerate(b.column(len(keep))):
                found = [f for hit in filter(None, map(hits.__getitem__, _WORD.findall((t.as_py() or "").lower()))) for f in hit]
                if found:
                    at, n = np.unique(found, return_counts=True)
                    scores[i] = weights[at] @ np.log1p(n)
            above = 1 / (1 + np.exp(-np.clip(scores[:, None] - thresholds[None, :], -40, 40)))
            level = (above >= 0.5).sum(axis=1).astype(np.int32)
            made = [pa.array(above.sum(axis=1)), pa.array(level), pa.array(level > 0)]
            stay = b.columns if keep_text else b.columns[:-1]
            yield pa.RecordBatch.from_arrays([*stay, *made], names=[*names, *out])

    names = [*keep, text] if keep_text else keep
    rest = docs.select(*[column(docs, c) for c in names])
    schema = rest.withColumns({out[0]: F.lit(0.0), out[1]: F.lit(0), out[2]: F.lit(False)}).schema
    for f in schema.fields:
        f.nullable = True
    return docs.select(*[column(docs, c) for c in keep], column(docs, text)).mapInArrow(run, schema)
