"""Best-fit packing of token sequences with a bounded number of open bins."""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from struct import pack as pack_numbers

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexflume.llm._common import columns_of, stored

#: Bins that may be open at once in a task, and words in a generation of a worker's memo.
OPEN_BINS = 512
MEMO_WORDS = 900_000
#: Pieces of bins that tasks leave open which one task packs again, the bins that may be open there, and the share of a bin that may stay free without it.
AGAIN_PIECES, AGAIN_BINS, SPARE = 500_000, 200_000, 1 / 128


class OpenBins:
    """Online best fit over at most `most` open bins, keyed by free space.

    Bit f of `mask` says that a bin with f free places is open, so the tightest bin
    that takes a piece is the lowest set bit at or above its length. When a new bin
    is needed and `most` are open, the fullest (lowest set bit) closes for good.
    """

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.mask, self.count, self.made = 0, 0, 0
        self.bins: dict[int, list[int]] = defaultdict(list)

    def _take(self, free: int) -> int:
        held = self.bins[free]
        number = held.pop()
        if not held:
            self.mask &= ~(1 << free)
            del self.bins[free]
        self.count -= 1
        return number

    def free(self) -> dict[int, int]:
        """The free places of each open bin."""
        return {number: free for free, held in self.bins.items() for number in held}

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to size places."""
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if length < self.size and self.count == self.most:
                self._take((self.mask & -self.mask).bit_length() - 1)
            number, free = self.made, self.size
            self.made += 1
        rest = free - length
        if rest:
            self.bins[rest].append(number)
            self.mask |= 1 << rest
            self.count += 1
        return number, self.size - free


class WordIds:
    """Little-endian 32-bit ids of whole texts, from the ids of their runs without ASCII white space.

    No rule of the tokenizer crosses such white space, so words are encoded once and
    remembered: in two generations, the older of which is dropped when the newer has
    MEMO_WORDS words. The tokenizer lowers case itself, so texts are lowered before they
    are split, but for those that may have special strings, which it knows in their own
    case. Nor does a rule of it cross from an ASCII letter or digit to the signs TAIL, so
    a new word that ends in them is two. New words are encoded many at a time, between
    marks: MARK is a word that no other contains, words with its character are encoded
    alone.
    """

    MARK = b"\x01"
    TAIL = b".,!?;:"
    SPECIAL = b"<|"

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merged = self.tokenizer.model.tokenize
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        (self.mark,) = self.ids(self.MARK).tolist()

    def ids(self, text: bytes) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        found: dict[bytes, bytes] = {}
        plain = []
        for w in words:
            if w.isalpha() and w.islower():
                # Small ASCII letters only: no rule but the merges applies.
                ids = [x.id for x in self.merged(w.decode())]
                found[w] = pack_numbers(f"<{len(ids)}I", *ids)
            elif self.MARK in w:
                found[w] = self.ids(w).tobytes()
            else:
                plain.append(w)
        joint = b" " + self.MARK + b" "
        for at in range(0, len(plain), 512):
            part = plain[at : at + 512]
            got = self.ids(joint.join(part))
            raw, ends = got.tobytes(), (4 * np.flatnonzero(got == self.mark)).tolist()
            for w, start, end in zip(part, [0, *(e + 4 for e in ends)], [*ends, len(raw)], strict=True):
                found[w] = raw[start:end]
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        memo, held, holes = self.new, [], []
        for t in texts:
            words = (t if self.SPECIAL in t else t.lower()).split()
            values = list(map(memo.get, words))
            held.append(values)
            at = 0
            try:
                while True:
                    at = values.index(None, at)
                    holes.append((values, at, words[at]))
                    at += 1
            except ValueError:
                pass
        found: dict[bytes, bytes | None] = {w: self.old.get(w) for _, _, w in holes}
        new = [w for w, ids in found.items() if ids is None]
        bases = [w.rstrip(self.TAIL) for w in new]
        split = {w: (x, w[len(x) :]) for w, x in zip(new, bases, strict=True) if len(x) < len(w) and x[-1:].isalnum()}
        parts = {x: memo.get(x) or self.old.get(x) for both in split.values() for x in both}
        found |= self.learn([*dict.fromkeys([*(x for x, ids in parts.items() if ids is None), *(w for w in new if w not in split)])])
        for w, (x, tail) in split.items():
            found[w] = (parts[x] or found[x]) + (parts[tail] or found[tail])
        for values, at, w in holes:
            values[at] = found[w]
        memo.update((w, ids) for w, ids in found.items() if len(w) <= 64)
        if len(memo) > MEMO_WORDS:
            self.old, self.new = memo, {}
        return list(map(b"".join, held))


def batches_of(texts: Iterator[bytes], rows: int = 256, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The texts in runs of at most `rows`, each ended as it reaches `size` bytes."""
    held, total = [], 0
    for t in texts:
        held.append(t)
        total += len(t)
        if len(held) == rows or total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


_IDS: dict[int, WordIds] = {}
PIECE = {"piece": T.IntegerType(), **dict.fromkeys(("start", "length", "ids_crc32", "sequence_id", "offset"), T.LongType()), "ids": T.BinaryType()}


def pack(docs: DataFrame, vocabulary: str, *, size: int = 4096, end_id: int = 1, open_bins: int = OPEN_BINS, text: str = "text", ids: bool = False) -> DataFrame:
    """One row per piece: docs' columns without the text, then PIECE (and `ids`, little-endian, if asked for).

    A document is its ids and then end_id; a null text is empty, so it is one token.
    Documents above `size` are cut into pieces of `size`, the last may be shorter; no
    other document is cut. Each task packs the pieces it reads, in order. Pieces of bins
    that are still open when a task ends, a bounded number of each task, are packed
    again together, the longest first, so the number of sequences hardly depends on how
    the input is dealt. sequence_id is made of a task's partition and the bin's number;
    it is negative where pieces were packed again.

    Pieces are written once to the shared folder and packed again from there, so a lost
    executor changes nothing. Repeated rows and ids are packed each on their own, null
    keys and other columns go along whatever their names, columns named like results
    are replaced. A very long text is encoded by itself; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared, key = spark.sparkContext.broadcast(vocabulary), hash(vocabulary)
    extra = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if ids else [])]
    keep = docs.drop(*extra, text)
    inner = columns_of(keep) or [F.lit(True).alias("there")]
    rows = docs.select(F.struct(*inner).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *(T.StructField(n, PIECE[n]) for n in extra), T.StructField("loose", T.BooleanType())])
    end = end_id.to_bytes(4, "little")
    kinds = [pa.int32(), *[pa.int64()] * 5, *([pa.binary()] if ids else [])]

    def batch_of(row: pa.Array, made: list[tuple], loose: list[bool]) -> pa.RecordBatch:
        cols = list(zip(*made, strict=True)) or [[]] * len(extra)
        return pa.RecordBatch.from_arrays([row, *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), pa.array(loose, pa.bool_())], names=["row", *extra, "loose"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _IDS.get(key)
        if words is None:
            words = _IDS[key] = WordIds(shared.value)
        bins, base = OpenBins(size, open_bins), TaskContext.get().partitionId() << 40
        held, made = None, []  # the pieces of open bins
        for batch in batches:
            row = []
            texts = (x.as_py() or b"" for x in batch.column("text").cast(pa.binary()))
            for i, got in enumerate(x + end for part in batches_of(texts) for x in words.encode(part)):
                for k, at in enumerate(range(0, len(got), 4 * size)):
                    cut = got[at : at + 4 * size]
                    number, offset = bins.place(len(cut) // 4)
                    row.append(i)
                    made.append((k, at // 4, len(cut) // 4, zlib.crc32(cut), base + number, offset, *([cut] if ids else [])))
            new = batch.column("row").take(pa.array(row, pa.int64()))
            held = new if held is None else pa.concat_arrays([held, new])
            still = {base + number for number in bins.free()}
            stays = [m[4] in still for m in made]
            done = [m for m, s in zip(made, stays, strict=True) if not s]
            yield batch_of(held.filter(pa.array([not s for s in stays], pa.bool_())), done, [False] * len(done))
            held, made = held.filter(pa.array(stays, pa.bool_())), [m for m, s in zip(made, stays, strict=True) if s]
        if made:
            loose = {base + number for number, free in bins.free().items() if free > SPARE * size}
            yield batch_of(held, made, [m[4] in loose for m in made])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(size, AGAIN_BINS), TaskContext.get().partitionId() << 40
        for batch in batches:
            where = [bins.place(n) for n in batch.column("length").to_pylist()]
            place = {"sequence_id": pa.array([-1 - base - n for n, _ in where], pa.int64()), "offset": pa.array([o for _, o in where], pa.int64())}
            yield pa.RecordBatch.from_arrays([place.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

    pieces = stored(rows.mapInArrow(run, schema), "pieces")
    left = pieces.where("loose")
    parts = max(1, -(-left.count() // AGAIN_PIECES))
    packed = left.coalesce(parts).sortWithinPartitions(F.desc("length"), "sequence_id", "offset").mapInArrow(again, schema)
    out = pieces.where("not loose").unionByName(packed)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep.columns], *extra)


def packing_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    return pack(docs.select("doc_id", "text"), vocabulary)
