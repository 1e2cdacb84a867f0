"""BPE encoding that encodes chunks shared between documents once.

Texts are cut where a rolling hash over their bytes says so, so equal passages give equal chunks wherever they stand. Chunks are
told apart by a hash; those that occur more than once are encoded once, from one of the documents that hold them, and their
ids are handed to all others.

A chunk's ids are not simply put side by side, as its first and last tokens may differ within the text. Inside a chunk there are
places where the tokenizer's pattern always cuts, whatever stands around: between a printable ASCII character and a blank, for one.
From the first such place to the last, the ids hold in every text; that part of a chunk is its body. Between two bodies the
text is encoded again, over a whole chunk and further where it has no such place, so that the ids agree with those of the whole text. What
comes out is decoded and compared with the text; one that differed, as two chunks with the same hash could make it, is encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.byte_bpe import gather
from barflow.llm.common import column, lookup, whole
from barflow.llm.range_coder import Words
from barflow.session import materialize

#: Bytes the rolling hash sees, as a power of two, and how many bits of it are zero at a cut: chunks of about 2^10 bytes.
WINDOW_DOUBLINGS, CUT_BITS = 5, 10
#: Bytes of a chunk at least and at most.
SHORTEST, LONGEST = 128, 1 << 14
#: Distinct words whose ids a Python worker remembers before it starts anew.
REMEMBERED = 300_000
#: Bytes hashed, and bytes of text encoded, in one step.
STEP = 1 << 21
#: Places where a cut of the tokenizer's pattern is certain: before a blank or line end after a printable character, before an ASCII
#: sign after an ASCII letter or digit, before CJK punctuation after an ideograph (U+5000 to U+8FFF).
CERTAIN = re.compile(
    rb"(?<=[!-~])(?=[ \n])|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])|(?<=[\xe5-\xe8][\x80-\xbf][\x80-\xbf])(?=\xe3\x80[\x81\x82]|\xef\xbc[\x81\x8c\x9a\x9b\x9f])"
)
#: 64-bit words of the filter that tells which texts may hold a shared chunk, and bits set for each; a full filter only moves more texts.
FILTER_WORDS, FILTER_BITS = 1 << 20, 4
#: Bytes at a chunk's end that are looked at first for its last certain place.
NEAR = 96

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, np.uint32)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places, ascending, before which the rolling hash of the bytes cuts: the hash covers the ``2 ** WINDOW_DOUBLINGS`` bytes there."""
    found, reach = [], 1 << WINDOW_DOUBLINGS
    for lo in range(0, len(data), STEP):
        start = max(0, lo - reach)
        h = _GEAR[data[start : lo + STEP]]
        for k in range(WINDOW_DOUBLINGS):
            step = 1 << k
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        at = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + start + 1
        found.append(at[(at > lo) & (at <= lo + STEP)])
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunks(text: bytes, at: np.ndarray) -> list[tuple[int, int]]:
    """Chunks (start, end) of a text by its cuts: none shorter than ``SHORTEST`` but the last, none longer than ``LONGEST``."""
    out, start, n = [], 0, len(text)
    for cut in (*at.tolist(), n):
        while cut - start > LONGEST:
            out.append((start, start := start + LONGEST))
        if cut - start >= SHORTEST:
            out.append((start, cut))
            start = cut
    if start < n:
        out.append((start, n))
    return out


def body(text: bytes, start: int, end: int) -> tuple[int, int] | None:
    """From the first certain place of a chunk to its last."""
    first = CERTAIN.search(text, start + 1, end)
    if first is None:
        return None
    last = first.start()
    for m in CERTAIN.finditer(text, max(last, end - NEAR), end):
        last = m.start()
    if last < end - NEAR:
        for m in CERTAIN.finditer(text, last, end):
            last = m.start()
    return (first.start(), last) if last > first.start() else None


def _literals(tokenizer: str):
    """The added tokens of a tokenizer as a pattern, None without any; a text is cut there before all else."""
    import json

    added = [t["content"] for t in json.loads(tokenizer).get("added_tokens") or []]
    return re.compile(b"|".join(re.escape(a.encode()) for a in sorted(added, key=len, reverse=True))) if added else None


def _bodies(text: bytes, at: np.ndarray, literals) -> list[tuple[int, int]]:
    """Bodies of a text's chunks; none of them touches the literal of an added token."""
    found = [b for c in chunks(text, at) if (b := body(text, *c)) is not None]
    if literals is None or not (marks := [m.span() for m in literals.finditer(text)]):
        return found
    starts = np.array([m[0] for m in marks])
    # Literals don't overlap, so the last that starts before a body's end is the only one to look at.
    last = np.searchsorted(starts, [b[1] for b in found], side="left") - 1
    return [b for b, k in zip(found, last, strict=True) if k < 0 or marks[k][1] <= b[0]]


def _cut(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        literals = _literals(tokenizer.value["json"])
        for b in batches:
            for lo, texts in _steps(b.column(1)):
                joined = np.frombuffer(b"".join(texts), np.uint8)
                at, start, out = cuts(joined), 0, []
                for k, text in enumerate(texts):
                    own = at[np.searchsorted(at, start + SHORTEST) : np.searchsorted(at, start + len(text))] - start
                    key = b.column(0)[lo + k].as_py()
                    out += [(xxhash.xxh3_64_intdigest(text[s:e]) - (1 << 63), key, s, e) for s, e in _bodies(text, own, literals)]
                    start += len(text)
                table = np.array(out, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(table[:, i]) for i in range(4)], names=["chunk", "doc", "lo", "hi"])

    return run


def _steps(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in lots of about ``STEP`` bytes, each with its place; null as empty."""
    lot, size, at = [], 0, 0
    for k in range(len(texts)):
        text = (texts[k].as_py() or "").encode()
        lot.append(text)
        size += len(text)
        if size >= STEP:
            yield at, lot
            lot, size, at = [], 0, k + 1
    if lot:
        yield at, lot


class _Encoder:
    """The tokenizer without truncation and padding, on one thread, with the ids of words met before."""

    def __init__(self, tokenizer: str):
        self.words = Words(tokenizer)
        self.own = self.words.tokenizer
        self.own.no_truncation()
        self.own.no_padding()

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, as the library gives them."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
            self.words.closing.clear()
        return [i.astype("<u4") for i in self.words.ids([t.decode(errors="replace") for t in texts])]

    def plain(self, text: bytes) -> tuple[np.ndarray, bytes]:
        """Ids and decoded text of a whole text by the library alone."""
        ids = self.own.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4"), self.own.decode(ids, skip_special_tokens=False).encode()


def _load(shared) -> _Encoder:
    """A Python worker keeps the broadcast dictionary, and the encoder in it, for all its tasks."""
    if "encoder" not in shared.value:
        shared.value["encoder"] = _Encoder(shared.value["json"])
    return shared.value["encoder"]


def _token_bytes(tokenizer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens in one array, with start and length of each: how byte-level tokens are spelt is undone.

    A printable Latin-1 byte is spelt as itself, the others in order as the characters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spelt = {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    added = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    tokens = [added.get(i) or bytes(spelt[c] for c in tokenizer.id_to_token(i) or "") for i in range(max(tokenizer.get_vocab_size(), *added, 0) + 1)]
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def _packing(vocabulary: int) -> str:
    """How ids of shared chunks travel: two bytes each where all fit."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _encode_shared(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _load(tokenizer)
        kind = _packing(encoder.own.get_vocab_size())
        for b in batches:
            wanted = b.column(1)
            for lo, texts in _steps(b.column(0)):
                names, parts = [], []
                for k, text in enumerate(texts):
                    for w in wanted[lo + k].as_py():
                        names.append(w["chunk"])
                        parts.append(text[w["lo"] : w["hi"]])
                packed = [i.astype(kind).tobytes() for i in encoder.ids(parts)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], names=["chunk", "packed"])

    return run


def _join_up(tokenizer, kept: int, names: list[str]):
    """Columns kept, text, pieces -> columns kept, ids, their number, decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _load(tokenizer)
        kind = _packing(encoder.own.get_vocab_size())
        pool, starts, lengths = _token_bytes(encoder.own)
        for b in batches:
            pieces = b.column(kept + 1)
            for lo, texts in _steps(b.column(kept)):
                plans, gaps = [], []
                for k, text in enumerate(texts):
                    plan, at = [], 0
                    for p in sorted(pieces[lo + k].as_py() or (), key=lambda p: p["lo"]):
                        if p["lo"] > at:
                            plan.append(len(gaps))
                            gaps.append(text[at : p["lo"]])
                        plan.append(np.frombuffer(p["packed"], kind))
                        at = p["hi"]
                    if at < len(text):
                        plan.append(len(gaps))
                        gaps.append(text[at:])
                    plans.append(plan)
                coded = encoder.ids(gaps)
                ids = [
                    np.concatenate([coded[p] if isinstance(p, int) else p.astype("<u4") for p in plan]) if plan else np.empty(0, "<u4")
                    for plan in plans
                ]
                back = []
                for k, text in enumerate(texts):
                    if gather(pool, starts[ids[k]], lengths[ids[k]]).tobytes() == text:
                        back.append(text)
                        continue
                    ids[k], decoded = encoder.plain(text)
                    back.append(decoded)
                arrays = [b.column(i).slice(lo, len(texts)) for i in range(kept)]
                arrays += [pa.array([i.tobytes() for i in ids], pa.binary()), pa.array([len(i) for i in ids], pa.int64()), pa.array(back, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def encode_chunks(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Replace the text by ``ids`` (little-endian unsigned 32-bit integers, in one binary), ``n_tokens`` and ``decoded``.

    ``tokenizer`` is the JSON text of a byte-level BPE tokenizer whose pre-tokenizer is its own pattern. The ids are those of the
    tokenizers library for the whole text without special tokens added, truncation and padding; literals of added tokens in a text
    get their ids. ``decoded`` is what the library makes of the ids, special tokens kept. A null or empty text has no ids and decodes
    to the empty text. Other columns stay, but for those called like one of the three. Equal rows give equal results; an empty table
    gives an empty one. A text is encoded whole by one task, however long.

    Every row has a key made from its text and other columns. Chunks travel as hashes, and only ids of shared ones are copied; a
    chunk that very many documents hold reaches them by broadcast (``lookup``). Of texts, only those move that have a shared
    chunk, or of which one is taken: a filter of fixed size (``_maybe``) finds the others, which are encoded where they are read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"json": tokenizer})
    outs = ["ids", "n_tokens", "decoded"]
    keep = [c for c in docs.columns if c.lower() not in {text.lower(), *outs}]
    names = {c: f"kept_{i}" for i, c in enumerate(keep)}
    plain = [column(docs, c).alias(n) for c, n in names.items()]
    mix = F.xxhash64(whole(column(docs, text)), *_hashed(docs, keep)).alias("doc")
    rows = docs.select(mix, *plain, whole(column(docs, text)).alias("text"))

    found = materialize(rows.select("doc", "text").mapInArrow(_cut(shared), "chunk bigint, doc bigint, lo bigint, hi bigint"))
    one = F.min(F.struct("doc", "lo", "hi")).alias("one")
    twice = found.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), one).filter("n > 1")
    wanted = twice.groupBy("one.doc").agg(F.collect_list(F.struct("chunk", "one.lo", "one.hi")).alias("wanted"))
    wanted = materialize(wanted)
    sources = _split(rows.select("doc", "text"), wanted)[0].join(wanted, "doc").dropDuplicates(["doc"]).select("text", "wanted")
    coded = materialize(sources.mapInArrow(_encode_shared(shared), "chunk bigint, packed binary"))

    pieces = materialize(lookup(found, coded, "chunk").groupBy("doc").agg(F.collect_set(F.struct("lo", "hi", "packed")).alias("pieces")))
    schema = [*[f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in names.items()], "ids binary, n_tokens bigint, decoded string"]
    join_up = _join_up(shared, len(keep), [*names.values(), *outs])
    moved, still = _split(rows, pieces)
    kind = pieces.schema["pieces"].dataType
    moved = moved.join(pieces, "doc", "left").select(*names.values(), "text", "pieces")
    still = still.select(*names.values(), "text", F.lit(None).cast(kind).alias("pieces"))
    done = moved.mapInArrow(join_up, ", ".join(schema)).unionByName(still.mapInArrow(join_up, ", ".join(schema)))
    return done.select(*[F.col(n).alias(c) for c, n in names.items()], *outs)


def _maybe(keys: DataFrame) -> DataFrame:
    """A Bloom filter over the column ``doc`` as a table of at most ``FILTER_WORDS`` rows: the bits set in each 64-bit word."""
    return keys.select(_word(), _mask().alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_set"))


def _word() -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), "doc"), F.lit(FILTER_WORDS)).alias("_word")


def _mask() -> Column:
    bits = [F.expr(f"shiftleft(1L, CAST(shiftright(xxhash64('bits', doc), {6 * k}) & 63 AS int))") for k in range(FILTER_BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _split(rows: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``doc`` may be one of the keys, and rows whose ``doc`` surely is none. The filter is broadcast: its size is bound."""
    tested = rows.withColumn("_word", _word()).join(F.broadcast(_maybe(keys)), "_word", "left")
    hit = F.coalesce(F.col("_set").bitwiseAND(_mask()) == _mask(), F.lit(False))
    return tested.filter(hit).select(*rows.columns), tested.filter(~hit).select(*rows.columns)


def _hashed(docs: DataFrame, keep: list[str]) -> list:
    """Columns that can be hashed, so that rows that differ in them have keys of their own."""
    return [column(docs, c) for c in keep if not docs.schema[c].dataType.simpleString().startswith(("map", "variant"))]
