"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by the tokenizer's pattern. Tier one is a minimal perfect hash over the vocabulary: it
resolves a pre-token that is itself a token with one hash, one displacement and one comparison. Tier two merges a missed
pre-token's bytes, held as a linked list, lowest rank first, with a heap of candidate pairs; a short one's few pairs are
looked through instead.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from barflow.llm.common import column

_MASK = (1 << 64) - 1
_SPREAD, _STRIDE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
#: Displacements tried at once, and at most, for one bucket; seeds tried for a whole table.
_TRIES, _MOST_TRIES, _SEEDS = 256, 1 << 16, 64
#: Bytes of words, pre-tokens and ids, with what Python adds to each, that a worker remembers, in two generations.
REMEMBERED_BYTES, _ENTRY_BYTES = 192 << 20, 240
#: Bytes up to which the pairs of a pre-token are looked through, and a rank above all.
SHORT, _NO_PAIR = 48, 1 << 40
#: Words resolved in one vectorised step, and bytes of text handed on in one batch.
STEP, BATCH_BYTES = 1 << 20, 4 << 20


class PerfectHash:
    """Minimal perfect hash by displacement: n keys on n slots, one number for each bucket of about four keys.

    A displacement is mixed with the hash, so each sends the keys of a bucket to other, unrelated slots. Buckets are placed largest
    first; should one find no place, the table is made anew with another seed.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        if len(set(keys)) < n:
            raise ValueError("two keys are equal")
        self.n, self.buckets = n, max(1, n // 4)
        for self.seed in range(_SEEDS):
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(k, seed=self.seed) for k in keys), np.uint64, n)
            if len(np.unique(hashes)) == n and self._build(hashes):
                return
        raise ValueError("no perfect hash found")

    def _build(self, hashes: np.ndarray) -> bool:
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(counts)
        shift = np.zeros(self.buckets, np.int64)
        owner = np.full(self.n, -1, np.int64)
        for b in np.argsort(-counts, kind="stable"):
            if counts[b] <= 1:
                break
            mine = by_bucket[ends[b] - counts[b] : ends[b]]
            placed = self._place(hashes[mine], owner)
            if placed is None:
                return False
            shift[b], slots = placed
            owner[slots] = mine
        lone = np.flatnonzero(counts == 1)
        free = np.flatnonzero(owner < 0)
        shift[lone] = -1 - free
        owner[free] = by_bucket[ends[lone] - 1]
        self.shift, self.owner = shift, owner
        return True

    def _place(self, hashes: np.ndarray, owner: np.ndarray) -> tuple[int, np.ndarray] | None:
        """The first displacement that puts these hashes on distinct free slots; None if there is none."""
        for start in range(0, _MOST_TRIES, _TRIES):
            tried = np.arange(start, start + _TRIES, dtype=np.uint64)
            slots = self._slots(hashes[None, :], tried[:, None])
            fits = (owner[slots] < 0).all(axis=1)
            for t in np.flatnonzero(fits):
                if len(np.unique(slots[t])) == len(hashes):
                    return start + int(t), slots[t]
        return None

    def _slots(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = hashes ^ (shift * np.uint64(_STRIDE))
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(_SPREAD)
        return ((mixed >> np.uint64(32)) % np.uint64(self.n)).astype(np.int64)


def slot_owner(key: bytes, shift: list[int], owner: list[int], seed: int = 0) -> int:
    """The key that owns the slot of ``key`` in a perfect hash given as two lists and a seed; the caller compares."""
    h = xxhash.xxh3_64_intdigest(key, seed=seed)
    d = shift[h % len(shift)]
    if d < 0:
        return owner[-1 - d]
    mixed = h ^ (d * _STRIDE & _MASK)
    return owner[(((mixed ^ mixed >> 32) * _SPREAD & _MASK) >> 32) % len(owner)]


class Vocabulary:
    """Tokens by id, with the perfect hash over them. Read on the driver and sent once to each executor."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.hash = PerfectHash(tokens)

    @classmethod
    def from_ranks(cls, path: str, pattern: str) -> Vocabulary:
        """Read a rank file: one base64 token and its rank per line, ranks 0, 1, 2 and so on."""
        with open(path, "rb") as f:
            pairs = sorted((int(r), base64.b64decode(t)) for t, r in (line.split() for line in f if line.strip()))
        if [r for r, _ in pairs] != list(range(len(pairs))):
            raise ValueError("ranks are not 0, 1, 2 and so on")
        return cls([t for _, t in pairs], pattern)

    def plain(self) -> dict:
        """Tokens, pattern and hash as plain lists: some megabytes for any public vocabulary."""
        shift, owner = self.hash.shift.tolist(), self.hash.owner.tolist()
        return {"tokens": self.tokens, "pattern": self.pattern, "shift": shift, "owner": owner, "seed": self.hash.seed}


class Encoder:
    """Pre-tokens to ids."""

    def __init__(self, tokens: list[bytes], pattern: str, shift: list[int], owner: list[int], seed: int = 0):
        self.tokens, self.shift, self.owner, self.seed = tokens, shift, owner, seed
        self.ranks = {t: r for r, t in enumerate(tokens)}
        self.pattern, self.split = pattern, regex.compile(pattern).findall
        self.single = [self.ranks.get(bytes([b])) for b in range(256)]
        self.double = {(a, b): self.ranks.get(bytes([a, b]), _NO_PAIR) for a in range(256) for b in range(256)}

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        found = slot_owner(piece, self.shift, self.owner, self.seed)
        if self.tokens[found] == piece:
            return [found]
        return self.merge(piece) if len(piece) > SHORT else self.merge_short(piece)

    def merge_short(self, piece: bytes) -> list[int]:
        """What ``merge`` gives, for few pairs: ``pairs`` holds the rank of each pair of neighbours, ``at`` where the parts start."""
        at, rank = list(range(len(piece) + 1)), self.ranks.get
        pairs = list(map(self.double.__getitem__, zip(piece, piece[1:], strict=False)))
        while pairs and (least := min(pairs)) < _NO_PAIR:
            i = pairs.index(least)
            del at[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(piece[at[i] : at[i + 2]], _NO_PAIR)
            if i:
                pairs[i - 1] = rank(piece[at[i - 1] : at[i + 1]], _NO_PAIR)
        out = [rank(piece[a:b]) for a, b in zip(at, at[1:], strict=False)]
        if None in out:
            raise ValueError("a byte is not in the vocabulary")
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Merge neighbours, lowest rank first and leftmost among equals, until no pair is a token.

        ``after`` and ``before`` link the parts by the byte they start at; a part that is gone has 0 in ``after``. The
        heap holds (rank, start, end) of pairs in one number; a pair is stale when its parts have changed since.
        """
        n, rank = len(piece), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n))
        ids = [self.single[b] for b in piece]
        pairs = map(self.double.__getitem__, zip(piece, piece[1:], strict=False))
        heap = [r << 64 | i << 32 | i + 2 for i, r in enumerate(pairs) if r < _NO_PAIR]
        heapify(heap)
        while heap:
            best = heappop(heap)
            i, end = best >> 32 & 0xFFFFFFFF, best & 0xFFFFFFFF
            mid = after[i]
            if not 0 < mid < n or after[mid] != end:
                continue
            after[i], after[mid], before[end], ids[i] = end, 0, i, best >> 64
            if end < n:
                far = after[end]
                if (r := rank(piece[i:far])) is not None:
                    heappush(heap, r << 64 | i << 32 | far)
            if (p := before[i]) >= 0 and (r := rank(piece[p:end])) is not None:
                heappush(heap, r << 64 | p << 32 | end)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        if None in out:
            raise ValueError("a byte is not in the vocabulary")
        return out

    def text(self, text: str) -> list[int]:
        return [i for p in self.split(text) for i in self.piece(p.encode())]


#: Patterns that take letters with the blank before them as one pre-token and a last mark after them as another.
_PLAIN = {r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"}
_MARKS = frozenset(".,;:!?")


class _Memory(dict):
    """Distinct words met so far, cut at blanks: a number for each, under which the ids of ``' ' + word`` stand in a pool.

    Cutting a text before each blank, and the parts by the pattern, gives the pre-tokens of the whole text unless white
    space stands before a blank, where a run may go on; such texts are cut by the pattern as a whole.

    A full memory becomes the ``older`` one of a new memory, which takes over from it what it meets again.
    """

    def __init__(self, encoder: Encoder, older: _Memory | None = None):
        super().__init__()
        self.encoder, self.pieces, self.closing, self.older = encoder, {}, set(), older
        if older is not None:
            older.older = None
        self.pool, self.start, self.length, self.piece_ids = array("i"), array("q"), array("i"), array("i")
        self.alone = bytearray()
        self.space = regex.compile(r"\s").match
        self.plain = encoder.pattern in _PLAIN
        self.bytes = 0

    def __missing__(self, word: str) -> int:
        if not word or (not word[-1].isalnum() and self.space(word[-1])):
            self.closing.add(word)
        old = self.older
        at = None if old is None else old.get(word)
        if at is not None:
            first, length = old.start[at], old.length[at]
            self.start.append(len(self.pool))
            self.pool.extend(old.pool[first : first + length])
            self.length.append(length)
            self.alone.append(old.alone[at])
            code = len(self.start) - 1
        elif word.isascii() and word.isalpha():  # one pre-token with its blank, and so is all but a last mark
            code = self.add(" " + word, (" " + word,))
        elif word[-1:] in _MARKS and word.isascii() and word[:-1].isalpha():
            code = self.add(" " + word, (" " + word[:-1], word[-1]))
        else:
            code = self.add(" " + word)
        self[word] = code
        self.bytes += 4 * len(word) + _ENTRY_BYTES
        return code

    def add(self, text: str, pieces: tuple[str, ...] | None = None) -> int:
        """A new number for the ids of a text, whose pre-tokens may be known."""
        self.start.append(len(self.pool))
        if pieces is None or not self.plain:
            pieces = self.encoder.split(text)
        self.alone.append(len(pieces) == 1)
        for piece in pieces:
            ids = self.known(piece)
            if ids is None:
                ids = None if self.older is None else self.older.known(piece)
                if ids is None:
                    ids = array("i", self.encoder.piece(piece.encode()))
                if not self.alone[-1]:
                    self.pieces[piece] = len(self.piece_ids)
                    self.piece_ids.append(len(ids))
                    self.piece_ids.extend(ids)
                    self.bytes += 4 * len(piece) + 4 * len(ids) + _ENTRY_BYTES
            self.pool.extend(ids)
        self.length.append(len(self.pool) - self.start[-1])
        self.bytes += 4 * self.length[-1] + 16
        return len(self.start) - 1

    def known(self, piece: str) -> array | None:
        """Ids of a pre-token met before: kept as such, or as those of a word that is one pre-token with its blank."""
        at = self.pieces.get(piece)
        if at is not None:
            return self.piece_ids[at + 1 : at + 1 + self.piece_ids[at]]
        code = self.get(piece[1:]) if piece[0] == " " else None
        if code is None or not self.alone[code]:
            return None
        return self.pool[self.start[code] : self.start[code] + self.length[code]]

    def codes(self, text: str) -> np.ndarray:
        first, *words = text.split(" ")
        codes = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        if (first and self.space(first[-1])) or not self.closing.isdisjoint(words):
            return np.array([self.add(text)], np.int32)
        return np.concatenate([np.array([self.add(first)], np.int32), codes]) if first else codes

    def ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of codes, and how many each code gave."""
        lengths = np.array(self.length, np.int64)[codes]
        return gather(np.array(self.pool, np.int32), np.array(self.start, np.int64)[codes], lengths), lengths

    @property
    def full(self) -> bool:
        return self.bytes > REMEMBERED_BYTES // 2


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``pool[start : start + length]``, one after the other."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return pool[np.repeat(shift, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)]


def encode_batches(texts: Iterator[pa.Array], vocabulary: dict) -> Iterator[pa.Array]:
    """For every array of texts, the array of their ids. ``vocabulary`` is what ``Vocabulary.plain`` gives.

    The words met so far are kept in that dictionary, which a Python worker keeps for all its tasks.
    """
    if "memory" not in vocabulary:
        vocabulary["memory"] = _Memory(Encoder(*(vocabulary[k] for k in ("tokens", "pattern", "shift", "owner", "seed"))))
    memory = vocabulary["memory"]
    for batch in texts:
        found, counts, codes, per_text = [], [], [], []

        def flush():
            flat, lengths = memory.ids(np.concatenate(codes)) if codes else (np.empty(0, np.int32), np.empty(0, np.int64))
            upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)]
            found.append(flat)
            counts.append(np.diff(upto))
            codes.clear()
            per_text.clear()

        waiting = 0
        for scalar in batch:
            codes.append(memory.codes(scalar.as_py() or ""))
            per_text.append(len(codes[-1]))
            waiting += per_text[-1]
            if waiting >= STEP or memory.full:
                flush()
                waiting = 0
                if memory.full:
                    memory = vocabulary["memory"] = _Memory(memory.encoder, memory)
        flush()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))


def decode_batches(batches: Iterator[pa.Array], tokens: list[bytes]) -> Iterator[pa.Array]:
    """For every array of id lists, the array of their bytes; null where the list is null."""
    pool = np.frombuffer(b"".join(tokens), np.uint8)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.cumsum(lengths) - lengths
    for ids in batches:
        values = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(values) and (values.min() < 0 or values.max() >= len(tokens)):
            raise ValueError("an id is not in the vocabulary")
        per_id = np.concatenate([[0], np.cumsum(lengths[values])])
        per_row = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = per_id[np.concatenate([[0], np.cumsum(per_row)])]
        steps = [values[a : a + STEP] for a in range(0, max(1, len(values)), STEP)]
        data = np.concatenate([gather(pool, starts[v], lengths[v]) for v in steps])
        present = None if not ids.null_count else ids.is_valid()
        buffers = [present and present.buffers()[1], pa.py_buffer(offsets), pa.py_buffer(data)]
        yield pa.Array.from_buffers(pa.large_binary(), len(ids), buffers).cast(pa.binary())


def _rest(docs: DataFrame, *gone: str) -> list[str]:
    return [c for c in docs.columns if c.lower() not in {g.lower() for g in gone}]


def lots(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``BATCH_BYTES`` of text, one row at least."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    lot = np.cumsum(sizes) // BATCH_BYTES
    starts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), len(sizes)] if len(sizes) else [0]
    for a, b in zip(starts, starts[1:], strict=False):
        yield batch.slice(a, b - a)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Replace the text by its ids, ``array<int>``, as the vocabulary's own library would without special tokens.

    With ``decoded`` the bytes that the ids stand for are added under that name, in the same step. A null or empty text has no ids
    and decodes to no bytes; equal rows give equal results, an empty table an empty one. A text is encoded whole by one task, however
    long; several texts only as long as they are together ``BATCH_BYTES``. A column that is called like ``ids`` or ``decoded`` is
    replaced; all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.plain())
    outs = [ids] if decoded is None else [ids, decoded]
    keep = _rest(docs, text, *outs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lot in lots(b, len(keep)):
                (found,) = encode_batches(iter([lot.column(len(keep))]), shared.value)
                made = [found] if decoded is None else [found, *decode_batches(iter([found]), shared.value["tokens"])]
                yield pa.RecordBatch.from_arrays([*lot.columns[: len(keep)], *made], names=[*keep, *outs])

    fields = [StructField(ids, ArrayType(IntegerType(), False)), *[StructField(d, BinaryType()) for d in outs[1:]]]
    schema = StructType([*[docs.schema[c] for c in keep], *fields])
    return docs.select(*[column(docs, c) for c in keep], column(docs, text)).mapInArrow(run, schema)


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for, as binary; null for null ids. A column called like ``out`` is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.plain())
    keep = _rest(docs, out)
    at = keep.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value["tokens"]
        for b in batches:
            for found in decode_batches(iter([b.column(at)]), tokens):
                yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*keep, out])

    schema = StructType([*[docs.schema[c] for c in keep], StructField(out, BinaryType())])
    return docs.select(*[column(docs, c) for c in keep]).mapInArrow(run, schema)
