"""Token ids in compressed binary blocks.

A block holds a directory of documents, or pieces of long ones, and their ids, coded by a range coder whose model starts
anew in every block, and ends with a checksum, so any block can be read alone. Three guesses are kept for an id: what
last followed the two ids before it (order 2), the one before it (order 1), and the block's commonest (order 0), each with
a count of how well it did. What such counts have meant so far are three predictions, which a small logistic network mixes
into the chance that the first guess holds and learns from. If it fails, the other guesses are asked, and an id that none
names is coded by a fixed prior over all ids.

The coder works on many blocks at once, one id of each in a step, so that a step costs a few vector operations.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import only
from barflow.session import shared_dir

#: Ids in a block at most, and blocks that are coded at once; they bound the model's memory.
BLOCK_IDS, LANES = 2048, 4096
#: Distinct words whose ids a Python worker remembers before it starts anew.
REMEMBERED = 800_000
#: Entries of a guess table, per block.
GUESSES = 2048
#: Bits of an id.
ID_BITS = 17
MAGIC = b"TID2"
_HEAD = "<4sIII"
_ENTRY = np.dtype([("doc", "<i8"), ("number", "<i8"), ("start", "<i8"), ("piece", "<i4"), ("n", "<i4"), ("flags", "<i4")])
#: Flags of a directory entry.
_LAST, _NULL = 1, 2

_STRETCH = np.array([round(256 * math.log((p + 0.5) / (4095.5 - p))) for p in range(4096)], np.int64).clip(-2047, 2047)
_SQUASH = np.array([round(4096 / (1 + math.exp(-x / 256))) for x in range(-2048, 2048)], np.int64).clip(1, 4095)

#: State of a coder: 48 bits, kept at least 24 wide. Parts of a whole that an id's interval is measured in.
_STATE, _TOP, _LEAST, _WHOLE = (1 << 48) - 1, 1 << 40, 1 << 24, 20


def _prior() -> np.ndarray:
    """Where each id's interval starts: one part for every id, the rest in proportion to 1 / (id + 64)."""
    size = 1 << ID_BITS
    share = np.cumsum(1 / (np.arange(size) + 64.0))
    rest = np.floor(share / share[-1] * ((1 << _WHOLE) - size)).astype(np.int64)
    return np.concatenate([[0], rest + np.arange(1, size + 1)])


class _Coder:
    """Range coders side by side. Encodes what it is given, or decodes it from ``data``."""

    def __init__(self, lanes: int, data: list[bytes] | None):
        self.low, self.high = np.zeros(lanes, np.int64), np.full(lanes, _STATE, np.int64)
        self.at, self.starts = np.zeros(lanes, np.int64), _prior()
        self.reads = data is not None
        if self.reads:
            self.bytes = np.zeros((lanes, max(map(len, data), default=0) + 16), np.uint8)
            for i, d in enumerate(data):
                self.bytes[i, : len(d)] = np.frombuffer(d, np.uint8)
            self.value = self.bytes[:, :6].astype(np.int64) @ (1 << np.arange(40, -1, -8, dtype=np.int64))
            self.at += 6
        else:
            self.bytes = np.zeros((lanes, 4096), np.uint8)

    def bit(self, at, p: np.ndarray, bits: np.ndarray | None) -> np.ndarray:
        """One bit in each lane of ``at``, an index or a slice; ``p`` of 65536 is the chance of a one."""
        low, high = self.low[at], self.high[at]
        mid = low + ((high - low) >> 16) * p
        if self.reads:
            bits = self.value[at] <= mid
        self._narrow(at, np.where(bits, low, mid + 1), np.where(bits, mid, high))
        return bits

    def id(self, at: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
        """One id in each lane of ``at`` by the fixed prior."""
        low, part = self.low[at], (self.high[at] - self.low[at]) >> _WHOLE
        if self.reads:
            part_of = np.minimum((self.value[at] - low) // part, (1 << _WHOLE) - 1)
            ids = np.searchsorted(self.starts, part_of, side="right") - 1
        self._narrow(at, low + part * self.starts[ids], low + part * self.starts[ids + 1] - 1)
        return ids

    def _narrow(self, at, low: np.ndarray, high: np.ndarray) -> None:
        """Take the new interval, moving out the bytes that are settled."""
        due = np.flatnonzero(((low ^ high) < _TOP) | (high - low < _LEAST))
        lanes = np.arange(len(self.low))[at] if len(due) else at
        while len(due):
            a, b, lane = low[due], high[due], lanes[due]
            b = np.where((a ^ b) < _TOP, b, a | (_LEAST - 1))
            if self.reads:
                self.value[lane] = (self.value[lane] << 8 & _STATE) | self.bytes[lane, self.at[lane]]
            else:
                if self.at[lane].max() >= self.bytes.shape[1] - 16:
                    self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)], axis=1)
                self.bytes[lane, self.at[lane]] = a >> 40
            self.at[lane] += 1
            a, b = a << 8 & _STATE, b << 8 & _STATE | 0xFF
            low[due], high[due] = a, b
            due = due[((a ^ b) < _TOP) | (b - a < _LEAST)]
        self.low[at], self.high[at] = low, high

    def finish(self) -> list[bytes]:
        """The bytes written, and enough of the last interval to tell it."""
        ends = [int(x).to_bytes(6, "big") for x in self.high]
        return [self.bytes[i, : self.at[i]].tobytes() + ends[i] for i in range(len(self.at))]


def _run(lengths: np.ndarray, blocks: list[np.ndarray] | None, data: list[bytes] | None) -> _Coder | np.ndarray:
    """Code the blocks, longest first, or read them from ``data``."""
    lanes, steps = len(lengths), int(lengths.max())
    coder = _Coder(lanes, data)
    ids = np.zeros((steps, lanes), np.int32)
    if blocks is not None:
        for i, b in enumerate(blocks):
            ids[: len(b), i] = b
    # One word per guess: the id above, four bits of trust below. Order 0 keeps one guess for a block.
    guess = [np.zeros(lanes * GUESSES, np.int32) for _ in range(2)]
    common = np.zeros(lanes, np.int32)
    records = [np.full(lanes * 16, 1 << 15, np.int32) for _ in range(3)]
    later = [np.full(lanes * 16, 1 << 15, np.int32) for _ in range(2)]
    weights = np.full((3, lanes), 22_000, np.int32)
    last, before = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    every, base = np.arange(lanes) * GUESSES, np.arange(lanes) * 16
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    for t in range(steps):
        n = int(active[t])
        here, want = slice(0, n), ids[t, :n] if blocks is not None else None
        a, b = last[here].astype(np.int64), before[here]
        places = (
            every[here] + (((b * 0x2F0B4C47 + a * 0x9E3779B1) >> 11) & (GUESSES - 1)),
            every[here] + ((a * 0x9E3779B1 >> 13) & (GUESSES - 1)),
        )
        held = guess[0][places[0]], guess[1][places[1]], common[here]
        (g2, g1, g0), (f2, f1, f0) = [h >> 4 for h in held], [h & 15 for h in held]
        first = np.where(f2 > 0, g2, np.where(f1 > 0, g1, g0))

        seen = [base[here] + f for f in (f2, f1, f0)]
        chances = [r[s] for r, s in zip(records, seen, strict=True)]
        said = [_STRETCH[c >> 4] for c in chances]
        w = weights[:, here]
        dot = (w[0] * said[0] + w[1] * said[1] + w[2] * said[2]) >> 16
        p = _SQUASH[dot.clip(-2048, 2047) + 2048]
        hit = coder.bit(here, p << 4, None if want is None else want == first)
        goal = hit.astype(np.int32) << 16
        error = ((goal >> 4) - p) * 7
        for k in range(3):
            w[k] += ((said[k] * error + 0x8000) >> 16).astype(np.int32)
            records[k][seen[k]] = (chances[k] + ((goal - chances[k]) >> 5)).clip(64, 65_472)
        found = np.where(hit, first, 0)

        rest = np.flatnonzero(~hit)
        for g, f, record in ((g1, f1, later[0]), (g0, f0, later[1])):
            ask = rest[(f[rest] > 0) & (g[rest] != first[rest])]
            if len(ask):
                at = base[ask] + f[ask]
                c = record[at]
                yes = coder.bit(ask, c.astype(np.int64), None if want is None else want[ask] == g[ask])
                record[at] = (c + (((yes.astype(np.int32) << 16) - c) >> 5)).clip(64, 65_472)
                found[ask[yes]] = g[ask[yes]]
                gone = np.zeros(n, bool)
                gone[ask[yes]] = True
                rest = rest[~gone[rest]]
        if len(rest):
            found[rest] = coder.id(rest, None if want is None else want[rest])

        for k, (g, f) in enumerate(((g2, f2), (g1, f1), (g0, f0))):
            same = g == found
            kept = np.where(same, np.minimum(f + 1, 15), f >> 1 if k < 2 else f - 1)
            new = np.where(kept > 0, g << 4 | kept, found << 4 | 1)
            if k < 2:
                guess[k][places[k]] = new
            else:
                common[here] = new
        before[here], last[here] = last[here].copy(), found
        if blocks is None:
            ids[t, :n] = found
    return coder if blocks is not None else ids


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Code arrays of ids, none empty, each for itself."""
    out: list[bytes] = [b""] * len(blocks)
    for a in range(0, len(blocks), LANES):
        some = sorted(range(a, min(a + LANES, len(blocks))), key=lambda i: -len(blocks[i]))
        lengths = np.array([len(blocks[i]) for i in some])
        for i, done in zip(some, _run(lengths, [blocks[i] for i in some], None).finish(), strict=True):
            out[i] = done
    return out


def decode_blocks(coded: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The arrays that ``encode_blocks`` was given."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(coded)
    for a in range(0, len(coded), LANES):
        some = sorted(range(a, min(a + LANES, len(coded))), key=lambda i: -lengths[i])
        ids = _run(np.array([lengths[i] for i in some]), None, [coded[i] for i in some])
        for lane, i in enumerate(some):
            out[i] = ids[: lengths[i], lane]
    return out


def seal(entries: np.ndarray, coded: bytes, n: int) -> bytes:
    """A block's bytes: head, directory, ids, checksum of all that."""
    body = struct.pack(_HEAD, MAGIC, n, len(entries), len(coded)) + entries.tobytes() + coded
    return body + struct.pack("<I", zlib.crc32(body))


def unseal(block: bytes) -> tuple[np.ndarray, bytes, int]:
    """Directory, coded ids and their number; an error if the block isn't whole."""
    if len(block) < struct.calcsize(_HEAD) + 4 or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("a block's checksum is wrong")
    magic, n, entries, size = struct.unpack_from(_HEAD, block)
    end = struct.calcsize(_HEAD) + entries * _ENTRY.itemsize
    if magic != MAGIC or len(block) != end + size + 4:
        raise ValueError("not a block of token ids")
    return np.frombuffer(block, _ENTRY, entries, struct.calcsize(_HEAD)), block[end : end + size], n


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the checksum's, highest power in the lowest bit."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def join_crc(first: int, second: int, length: int) -> int:
    """Checksum of two runs of bytes from theirs and the second's length."""
    shift, power = 1 << 31, 1 << 23
    while length:
        if length & 1:
            shift = _times(shift, power)
        power, length = _times(power, power), length >> 1
    return _times(shift, first) ^ second


class Words(dict):
    """Ids by word, each word encoded once by the tokenizers library, with the blank before it.

    A byte-level pre-tokenizer cuts before a blank unless white space stands in front of it; a text where that occurs
    is encoded as a whole, and so are one that holds the literal of an added token, such as the end of a text, and what
    comes before the first blank of a text.
    """

    def __init__(self, tokenizer: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.literals = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.closing: set[str] = set()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many in one text; a token belongs to the word in which it starts."""
        lots = [words[k : k + 1000] for k in range(0, len(words), 1000)]
        for lot, e in zip(lots, self.tokenizer.encode_batch(["".join(f" {w}" for w in lot) for lot in lots], add_special_tokens=False), strict=True):
            ends = np.cumsum([len(w) + 1 for w in lot])
            starts = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.offsets))
            upto = np.searchsorted(starts, ends, side="left")
            ids = np.array(e.ids, np.int32)
            for w, lo, hi in zip(lot, [0, *upto[:-1]], upto, strict=True):
                self[w] = ids[lo:hi].tobytes()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self) > REMEMBERED:
            self.clear()
            self.closing.clear()
        cut = [t.split(" ") for t in texts]
        new = set().union(*[c[1:] for c in cut]).difference(self)
        closing = [w for w in new if not w or w[-1].isspace()]
        self.closing.update(closing)
        self.update(dict.fromkeys(closing, b""))
        self._learn(list(new.difference(closing)))
        whole = [
            bool(c[0][-1:].isspace()) or not self.closing.isdisjoint(c[1:]) or any(x in t for x in self.literals)
            for t, c in zip(texts, cut, strict=True)
        ]
        heads = self._encode([t if w else c[0] for t, w, c in zip(texts, whole, cut, strict=True)])
        out = []
        for head, w, c in zip(heads, whole, cut, strict=True):
            rest = b"" if w else b"".join(map(self.__getitem__, c[1:]))
            out.append(np.concatenate([np.array(head, np.int32), np.frombuffer(rest, np.int32)]))
        return out


def _pack(tokenizer, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = tokenizer.value.setdefault("words", None) or Words(tokenizer.value["json"])
        tokenizer.value["words"] = memory
        shard, number, start, made = TaskContext.get().partitionId(), 0, 0, 0
        entries, ids, blocks = [], [], []

        def close():
            blocks.append((np.array(entries, _ENTRY), np.concatenate(ids)))
            entries.clear()
            ids.clear()

        def flush():
            nonlocal made
            coded = encode_blocks([b for _, b in blocks])
            sealed = [seal(e, c, len(b)) for (e, b), c in zip(blocks, coded, strict=True)]
            names = np.arange(made, made + len(blocks), dtype=np.int64)
            made += len(blocks)
            blocks.clear()
            shards = np.full(len(names), shard, np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(shards), pa.array(names), pa.array(sealed, pa.binary())], names=["shard", "block", "payload"]
            )

        room = BLOCK_IDS
        for b in batches:
            docs = b.column(0)
            for lo in range(0, b.num_rows, 256):
                texts = [t or "" for t in b.column(1).slice(lo, 256).to_pylist()]
                for k, own in enumerate(memory.ids(texts)):
                    doc = docs[lo + k].as_py()
                    whole = np.append(own, end)
                    piece = at = 0
                    while at < len(whole):
                        part = whole[at : at + room]
                        at += len(part)
                        flags = (_LAST if at == len(whole) else 0) | (_NULL if doc is None else 0)
                        entries.append((doc or 0, number, start, piece, len(part), flags))
                        ids.append(part)
                        piece, room = piece + 1, room - len(part)
                        if room == 0:
                            close()
                            room = BLOCK_IDS
                            if len(blocks) == LANES:
                                yield flush()
                    number, start = number + 1, start + len(whole)
        if entries:
            close()
        if blocks:
            yield flush()

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, LANES):
            opened = [unseal(p.as_py()) for p in b.column(1).slice(lo, LANES)]
            shard = b.column(0).slice(lo, LANES).to_numpy()
            ids = decode_blocks([c for _, c, _ in opened], [n for _, _, n in opened])
            dirs = np.concatenate([e for e, _, _ in opened])
            crcs = []
            for (e, _, _), block in zip(opened, ids, strict=True):
                ends = np.cumsum(e["n"])
                data = block.astype("<u4")
                crcs += [zlib.crc32(data[z - n : z].tobytes()) for z, n in zip(ends, e["n"], strict=True)]
            null = (dirs["flags"] & _NULL) > 0
            made = [
                pa.array(np.repeat(shard, [len(e) for e, _, _ in opened])), pa.array(dirs["doc"], mask=null),
                *[pa.array(dirs[c].astype(np.int64)) for c in ("number", "start", "piece", "n")],
                pa.array((dirs["flags"] & _LAST) > 0), pa.array(np.array(crcs, np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(made, names=["shard", "doc", "number", "start", "piece", "n", "last", "crc"])


def write_ids(docs: DataFrame, tokenizer: str, path: str, end: int = 0, id: str = "doc_id", text: str = "text") -> None:
    """Encode the texts (null: empty), append the id ``end`` to each, and write them in ascending order of ``id``.

    ``tokenizer`` is the JSON text of a tokenizer. Each partition of the order is a shard, its blocks are rows (``shard``,
    ``block``, ``payload``) of Parquet files under ``path``. Null ids stand first; rows of equal id in any order. Blocks are
    written and committed by Spark, so a lost executor's blocks are made again.
    """
    # A Python worker keeps the broadcast dictionary, and the words put in it, for all its tasks.
    shared = docs.sparkSession.sparkContext.broadcast({"json": tokenizer})
    rows = only(docs, id, text).toDF("id", "text").withColumn("id", F.col("id").cast("bigint"))
    order = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    order.mapInArrow(_pack(shared, end), "shard int, block bigint, payload binary").write.mode("overwrite").parquet(path)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        crcs = []
        for parts in b.column(b.schema.get_field_index("parts")).to_pylist():
            crc = 0
            for p in sorted(parts, key=lambda p: p["piece"]):
                crc = join_crc(crc, p["crc"], 4 * p["n"])
            crcs.append(crc)
        yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(5)], pa.array(crcs, pa.int64())], names=["shard", "doc", "number", "start", "n", "crc"])


def read_ids(spark, path: str) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (ids before it in the whole order), ``n_tokens``, ``ids_crc32``.

    Every block is checked and decoded. No files give no rows.
    """
    kind = "shard int, doc bigint, number bigint, start bigint, piece bigint, n bigint, last boolean, crc bigint"
    pieces = spark.read.schema("shard int, block bigint, payload binary").parquet(path).select("shard", "payload").mapInArrow(_unpack, kind)
    folder = f"{shared_dir(spark)}/pieces-{uuid.uuid4().hex}"
    pieces.write.parquet(folder)
    pieces = spark.read.schema(kind).parquet(folder)
    one = "piece = 0 AND last"
    whole = pieces.filter(one).select("shard", "doc", "number", "start", "n", "crc")
    parts = pieces.filter(f"NOT ({one})").groupBy("shard", "number").agg(
        F.first("doc").alias("doc"), F.first("start").alias("start"), F.sum("n").alias("n"),
        F.collect_list(F.struct("piece", "n", "crc")).alias("parts"),
    )
    parts = parts.select("shard", "doc", "number", "start", "n", "parts").mapInArrow(_joined, "shard int, doc bigint, number bigint, start bigint, n bigint, crc bigint")
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = pieces.groupBy("shard").agg(F.sum("n").alias("size"))
    shards = shards.select("shard", F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("before"))
    return whole.unionByName(parts).join(F.broadcast(shards), "shard").select(
        F.col("doc").alias("doc_id"), (F.col("before") + F.col("start")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )
