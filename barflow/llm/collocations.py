"""Collocations by marginalising the longest windows.

Every word of a piece of text starts one window: itself and the words that lead it, up to the longest phrase, and fewer at the
end of a piece, where the window is padded. Only these windows are counted. Each phrase is the beginning of the windows that
start where it stands, so the counts of all shorter phrases, and the number of words, are sums over successively shorter
prefixes of the counted windows: one ROLLUP.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.byte_bpe import lots
from barflow.llm.common import only
from barflow.session import materialize

PIECE_ENDS, BLANKS = b".,;:!?\n\v\f\r", b" \t"
#: Bytes with A-Z lowered, and of which kind each is: of a word, blank or the end of a piece.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_KIND = np.array([2 if b in PIECE_ENDS else 1 if b in BLANKS else 0 for b in range(256)], np.uint8)
NO_LANG = "und"
#: Scores are ratios in millionths.
SCALE = 1_000_000
#: Windows a task counts at once before it hands them on, and rows of a batch it hands on.
COMBINED, ARROW_ROWS = 1_000_000, 50_000
#: Parts that the rows of one key are dealt over when they look a phrase up.
SALTS = 16


def _words(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts, A-Z lowered, as one array, with each word's text and piece. Pieces and words end at ASCII bytes."""
    text = text.cast(pa.large_string()).fill_null("")
    _, offsets, data = text.buffers()
    upto = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    data = _LOWER[np.frombuffer(data or b"", np.uint8)[upto[0] : upto[-1]]]
    upto = upto - upto[0]
    kind = _KIND[data]
    inside = kind == 0
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = upto[1:-1][(upto[1:-1] > 0) & (upto[1:-1] < len(data))]  # a text's first word starts there, whatever stood before
    starts[cut] |= inside[cut]
    ends[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    of = np.searchsorted(upto, starts, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + of
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, of, piece


def _windows(lang: pa.DictionaryArray, words: pa.DictionaryArray, piece: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """Distinct windows of words given with their langs and pieces, and how often each is found, ``ARROW_ROWS`` in a batch."""
    code = words.indices.to_numpy() + np.int32(1)  # 0 stands for no word
    names, key, words = lang.dictionary, lang.indices.to_numpy().astype(np.int64), words.dictionary
    many, size, packed = len(words) + 1, len(names), []
    for k in range(longest):
        kept = None
        if size * many >= 1 << 62:  # numbers of the distinct beginnings instead of the beginnings
            kept = np.unique(key)
            key, size = np.searchsorted(kept, key), len(kept)
        packed.append(kept)
        key *= many
        n = max(0, len(key) - k)
        key[:n] += np.where(piece[k:] == piece[:n], code[k:], np.int32(0))
        size *= many
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts, key = np.diff(np.append(first, len(key))), key[first]
    del code, piece, lang, first
    for at in range(0, len(key), ARROW_ROWS):
        rest, parts = key[at : at + ARROW_ROWS], []
        for kept in reversed(packed):
            rest, own = np.divmod(rest, many)
            parts.append(words.take(pa.array(own - 1, mask=own == 0)))
            rest = rest if kept is None else kept[rest]
        window = pc.binary_join_element_wise(*reversed(parts), pa.scalar(" ", pa.large_string()), null_handling="skip")
        columns = [names.take(pa.array(rest)), window.cast(pa.string()), pa.array(counts[at : at + ARROW_ROWS])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "window", "n"])


def _count(longest: int):
    """Windows of the texts: one for each word, itself and the words that lead it up to ``longest``, fewer at a piece's end, joined by
    blanks. Equal ones of a task are counted before they are shuffled, ``COMBINED`` words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, pieces = [], 0, 0

        def flush():
            lang, words = (pa.chunked_array([h[k] for h in held]).dictionary_encode().combine_chunks() for k in (0, 1))
            made = _windows(lang, words, np.concatenate([h[2] for h in held]), longest)
            held.clear()
            del lang, words
            yield from made
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for b in lots(batch, 1):
                words, of, piece = _words(b.column(1))
                if not len(words):
                    continue
                held.append((b.column(0).take(pa.array(of)), words, (piece + pieces).astype(np.int32)))
                rows, pieces = rows + len(words), pieces + int(piece[-1]) + 1
                if rows >= COMBINED:
                    yield from flush()
                    rows = pieces = 0
        if held:
            yield from flush()

    return run


def phrase_counts(docs: DataFrame, longest: int, least: int) -> DataFrame:
    """``lang, size, phrase, f``: phrases of up to ``longest`` words found at least ``least`` times, and under size 0 all words.

    Only the windows are counted: within a task first, then shuffled once, by all their words but the last, so that sums over the
    next shorter prefix stay where they are. Their sums over one word less are small, and ROLLUP sums those over fewer and fewer first words. A padded window is no
    phrase of the words it lacks, but counts for its beginnings.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    combined = texts.mapInArrow(_count(longest), "lang string, window string, n bigint")
    head = F.substring_index("window", " ", longest - 1)
    # Dealt by the prefix, which is not sent along but taken from the window again.
    dealt = combined.repartition("lang", head).withColumn("head", head)
    counted = dealt.groupBy("lang", "head", "window").agg(F.sum("n").alias("f"))
    heads = dealt.groupBy("lang", "head").agg(F.sum("n").alias("f"))

    # One condition on both, or the second would be moved below the count, which is then made twice.
    wanted = F.when(F.col("f") >= least, F.size(F.split("window", " ")) == longest)
    full = counted.filter(wanted).select("lang", F.lit(longest).alias("size"), F.col("window").alias("phrase"), "f")

    # Every prefix goes on by its own first words; it stays beside them where it is a phrase found often enough.
    shorter = F.substring_index("head", " ", longest - 2) if longest > 2 else F.lit("")
    stays = F.when((F.col("f") >= least) & (F.size(F.split("head", " ")) == longest - 1), F.struct(F.lit(longest - 1).alias("size"), F.col("head").alias("phrase")))
    kept = F.explode(F.array_compact(F.array(F.struct(F.lit(0).alias("size"), shorter.alias("phrase")), stays)))
    sums = heads.select("lang", "f", kept.alias("p")).groupBy("lang", "p.size", "p.phrase").agg(F.sum("f").alias("f"))
    # Conditions on the sum too, for the same reason as above: these sums are made once.
    heads_kept = sums.filter(F.when(F.col("f") >= 1, F.col("size") > 0)).select("lang", "size", "phrase", "f")

    names = [f"w{k}" for k in range(longest - 2)]
    parts = F.split("phrase", " ")
    first = sums.filter(F.when(F.col("f") >= 1, F.col("size") == 0))
    rolled = first.select("lang", "f", *[F.coalesce(F.get(parts, F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(names)])
    rolled = rolled.rollup("lang", *names).agg(F.sum("f").alias("f")).filter("lang IS NOT NULL")
    size = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in names], F.lit(0))
    padded = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) == "", F.lit(False)) for c in names], F.lit(False))
    short = rolled.filter(~padded).select("lang", size.alias("size"), F.concat_ws(" ", *names).alias("phrase"), "f")
    return full.unionByName(heads_kept).unionByName(short.filter(f"size = 0 OR f >= {int(least)}"))


def _look(left: DataFrame, counts: DataFrame, key: str, out: str) -> DataFrame:
    """``left`` with the count of the phrase in ``key``. Frequent words stand in many phrases: the rows of a key are dealt out."""
    deal = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    copies = counts.select("lang", F.col("phrase").alias(key), F.col("f").alias(out), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return left.withColumn("_salt", deal).join(copies, ["lang", key, "_salt"]).drop("_salt")


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(15,0)")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int | None = 2000, cover_percent: int = 50) -> DataFrame:
    """Phrases of 2 to ``longest`` words that stand together more often than their parts would.

    Reads ``text`` and ``lang`` (a null one counts as ``und``) of whole ``docs``; A-Z are lower-cased, pieces end at ``.,;:!?`` and
    line ends, words at blanks and tabs. ``f`` counts all occurrences within pieces. A phrase found at least ``least`` times is
    a candidate; cut after its first k words it has l = f(first part), r = f(rest) and score floor(10^6 a² / (l r)), in exact
    decimals; the lowest score counts, among equals that of the smallest k. Candidates that stand inside a longer one with at least
    ``cover_percent`` of their occurrences are left out. The result has, per lang, the first ``top`` (None: all) by score and
    ``a`` descending and phrase ascending in byte order: ``lang, rank, phrase, a, l, r, n, score``.

    Null and empty texts have no words; equal rows count each for itself; an empty table gives an empty result. A text is read
    whole, however long; other columns are not read.
    """
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words or more, and are found at least once")
    counts = materialize(phrase_counts(only(docs, "text", "lang"), longest, least))
    phrases = counts.filter("size > 0").select("lang", "phrase", "f")
    candidates = counts.filter("size > 1").withColumnRenamed("f", "a")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    first, rest = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - size)")
    scored = _look(_look(cuts.withColumns({"_first": first, "_rest": rest}), phrases, "_first", "l"), phrases, "_rest", "r")
    scored = scored.withColumn("_over", F.lit(SCALE).cast("decimal(7,0)") * _exact("a") * _exact("a"))
    scored = scored.withColumn("_under", F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)"))
    scored = scored.withColumn("score", F.expr("CAST(_over div _under AS bigint)"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("_best")
    scored = scored.groupBy("lang", "phrase", "size", "a").agg(best).select("lang", "phrase", "size", "a", "_best.score", "_best.l", "_best.r")

    words = F.split("phrase", " ")
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    longer = candidates.filter("size > 2").withColumn("w", words).select("lang", F.explode(inner).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(f"_longer IS NULL OR 100 * _longer < {int(cover_percent)} * a")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
