"""Substring dedup by sliding spans of consecutive sentences.

1. One scan splits every text into sentences and hashes the span that starts at each
   of them to 128 bits. A task keeps the first place of each hash that it has seen
   and knows all others to be covered.
2. The first places of all tasks meet by hash: one shuffle, in which a hash has at
   most a row a task, however often its passage comes. All but the very first are
   covered.
3. What is covered is joined back to its row and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexflume.llm._common import nested
from lexflume.llm.shingles import all_words, mixed, powers, slabs

#: A span is this many consecutive sentences, and as many more as it takes to this many words.
SENTENCES, MIN_WORDS = 3, 15
#: A sentence of more words is cut after each word the sum of whose lower-cased bytes SPARSE divides, and after so many words without one.
LONGEST, SPARSE = 16, 6
#: Spans that a task gathers before it passes on what it has.
FLUSH_SPANS = 500_000

_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_BASES = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)


def _starts(ends: np.ndarray) -> np.ndarray:
    """Marks of first words from marks of last words."""
    return np.concatenate([[True], ends[:-1]])


def sentences(texts: list[bytes], longest: int = LONGEST) -> tuple[np.ndarray, ...]:
    """(hashes of all words, first word of each sentence, byte of its text where it starts, sentences of each text).

    A sentence ends with a word that ends in one of .!?, with a line and with the
    text. One of more than `longest` words is cut into several where its own words
    say so, so that a passage is cut alike wherever in a sentence it begins.
    """
    hashes, start, last, total, counts = _marked(texts)
    n = len(hashes)
    if not n:
        none = np.zeros(0, np.int64)
        return hashes, none, none, counts
    base = np.cumsum([0, *(len(t) for t in texts[:-1])])
    own = np.repeat(np.arange(len(texts)), counts)
    ends = _STOP[last]
    lines = np.flatnonzero(np.frombuffer(b"".join(texts), np.uint8) == 10)
    before = np.searchsorted(start, lines) - 1
    ends[before[before >= 0]] = True
    ends[np.cumsum(counts)[counts > 0] - 1] = True
    whole = np.cumsum(_starts(ends)) - 1
    ends |= (total % SPARSE == 0) & (np.bincount(whole)[whole] > longest)
    head = _starts(ends)
    at = np.arange(n) - np.flatnonzero(head)[np.cumsum(head) - 1]
    ends |= (at + 1) % longest == 0
    first = np.flatnonzero(_starts(ends))
    return hashes, first, start[first] - base[own[first]], np.bincount(own[first], minlength=len(texts))


def _marked(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    hashes, counts, start, last, total = all_words(texts, True)
    return hashes, start, last, total, counts


class Runs:
    """Hashes of any runs of words, by sums of words times powers modulo 2^64."""

    def __init__(self, hashes: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            n = len(hashes)
            self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ b) * powers(b, n))]) for b in _BASES]
            self.back = [powers(b, n + 1) for b in _INVERSES]

    def hashed(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[k][end] - self.sums[k][start]) * self.back[k][start] + mixed((end - start).astype(np.uint64)))


def spans(hashes: np.ndarray, first: np.ndarray, each: np.ndarray, least: int = SENTENCES, words: int = MIN_WORDS) -> tuple[np.ndarray, ...]:
    """(first sentence, number of sentences, two hashes of its words) of the shortest span that starts at each sentence, if its text has one."""
    edge = np.append(first, len(hashes))
    stop = np.repeat(np.cumsum(each), each)
    i = np.arange(len(first))
    e = np.maximum(i + least, np.searchsorted(edge, first + words))
    fits = e <= stop
    i, e = i[fits], e[fits]
    runs = Runs(hashes)
    return i, e - i, *(runs.hashed(k, edge[i], edge[e]) for k in (0, 1))


_SPAN = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("row", "<i8"), ("first", "<i4"), ("size", "<i4")])


def _ranks(keys: list, tags: list[int]) -> np.ndarray:
    """A number for each row that rises with (key, tag), null keys first; equal rows have one."""
    by = sorted(range(len(keys)), key=lambda r: (keys[r] is not None, keys[r], tags[r]))
    out, rank = np.zeros(len(keys), np.int64), -1
    for k, r in enumerate(by):
        if not k or (keys[r], tags[r]) != (keys[by[k - 1]], tags[by[k - 1]]):
            rank += 1
        out[r] = rank
    return out


def _flushed(held: list[np.ndarray], keys: list, tags: list[int], kind: pa.DataType) -> pa.RecordBatch:
    """The spans of a task's rows: all but the first place of each hash are covered already."""
    e = np.concatenate(held) if held else np.zeros(0, _SPAN)
    rank = _ranks(keys, tags)[e["row"]] if len(e) else np.zeros(0, np.int64)
    by = np.lexsort(((rank << 32) | e["first"], e["h1"]))
    e, rank = e[by], rank[by]
    new = np.ones(len(e), bool)
    new[1:] = (e["h1"][1:] != e["h1"][:-1]) | (e["h2"][1:] != e["h2"][:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(e) else by
    again = ~new & (rank == rank[lead]) & (e["first"] == e["first"][lead])  # the same place of a repeated row
    e, new = e[~again], new[~again]
    # What is covered needs no hash any more; a number of its own spreads it, and its place is negative.
    h1 = np.where(new, e["h1"], mixed(np.arange(len(e), dtype=np.uint64)))
    h2 = np.where(new, e["h2"], np.uint64(0))
    at = (e["first"].astype(np.int64) << 32) | e["size"]
    row = pa.array(e["row"])
    return pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(keys, kind).take(row), pa.array(tags, pa.int64()).take(row), pa.array(np.where(new, at, ~at))], names=["h1", "h2", "key", "tag", "at"])


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


def repeated_spans(docs: DataFrame, *, text: str = "text", key: str = "doc_id", least: int = SENTENCES, words: int = MIN_WORDS, longest: int = LONGEST) -> DataFrame:
    """(key, tag, first, size) of every span that an earlier place has too; tag is the hash of the row's text.

    Places are ordered by key, tag and position. A row is its key and its text, so
    rows that share a key but not the text are apart, and copies of a whole row are one.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, tags, size, of = [], [], [], 0, pa.null()
        for batch in batches:
            of = batch.schema.field("key").type
            at, names, marks = 0, batch.column("key").to_pylist(), batch.column("tag").to_pylist()
            for slab in slabs(_texts(batch.column("text"))):
                hashes, first, _, each = sentences(slab, longest)
                i, n, h1, h2 = spans(hashes, first, each, least, words)
                e = np.zeros(len(i), _SPAN)
                e["row"] = len(keys) + np.repeat(np.arange(len(slab)), each)[i]
                e["first"] = i - np.repeat(np.cumsum(each) - each, each)[i]
                e["size"], e["h1"], e["h2"] = n, h1, h2
                keys += names[at : at + len(slab)]
                tags += marks[at : at + len(slab)]
                at += len(slab)
                held.append(e)
                size += len(e)
                if size > FLUSH_SPANS:
                    yield _flushed(held, keys, tags, of)
                    held, keys, tags, size = [], [], [], 0
        if size:
            yield _flushed(held, keys, tags, of)

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(f"`{text}`").alias("tag"), F.col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(run, f"h1 long, h2 long, key {kind}, tag long, at long")
    place = F.struct("key", "tag", "at")
    met = found.withColumn("least", F.min(place).over(Window.partitionBy("h1", "h2"))).where((F.col("at") < 0) | ~place.eqNullSafe(F.col("least")))
    at = F.when(F.col("at") < 0, F.bitwise_not("at")).otherwise(F.col("at"))
    return met.select("key", "tag", F.shiftright(at, 32).cast("int").alias("first"), at.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("size"))


EXTRA = ("n_sentences", "n_removed", "n_removed_chars")


def span_dedup(docs: DataFrame, *, text: str = "text", key: str = "doc_id", least: int = SENTENCES, words: int = MIN_WORDS, longest: int = LONGEST) -> DataFrame:
    """docs with the covered sentences cut from text, and n_sentences, n_removed and n_removed_chars added.

    A sentence goes, with the white space after it, if any span over it is found at an
    earlier place: in a row with a smaller key, or before it in its own. Words compare
    by 64-bit hashes with A-Z lower-cased, spans by 128 bits; what remains stays byte
    by byte as it was. key: whole numbers or strings.

    Null and empty texts, and texts with fewer sentences or words than a span has, lose
    nothing. Null keys come before all others. Rows that share a key (null too) and
    differ in text are rows of their own, ordered by a hash of the text; rows that
    repeat whole (key and text) count as one and are cut alike. A very long text is a
    slab of its own, hashed in parts. Columns named like the three results are
    replaced, all others pass whatever their names; an empty table gives no rows.
    """
    docs = docs.drop(*EXTRA)
    covered = repeated_spans(docs, text=text, key=key, least=least, words=words, longest=longest)
    cuts = covered.groupBy("key", "tag").agg(F.collect_list(F.struct("first", "size")).alias("cuts")).select(F.struct("key", "tag").alias("of"), "cuts")
    whole = nested(docs).select("row", F.struct(F.col(f"row.`{key}`").alias("key"), F.xxhash64(f"row.`{text}`").alias("tag")).alias("id"))
    joined = whole.join(cuts, whole["id"] == cuts["of"], "left").select("row", "cuts")
    schema = docs.schema
    for name in EXTRA:
        schema = schema.add(name, "long")
    place = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(batch.column("row").flatten())
            gone, out, counts, at = batch.column("cuts"), [], [], 0
            for slab in slabs(_texts(cols[place])):
                _, _, start, each = sentences(slab, longest)
                edge = np.cumsum(each) - each
                for k, body in enumerate(slab):
                    away = [(g["first"], g["first"] + g["size"]) for g in gone[at + k].as_py() or ()]
                    if away:
                        left, removed, chars = _cut(body, start[edge[k] : edge[k] + each[k]], away)
                        out.append(left)
                        counts.append((each[k], removed, chars))
                    else:
                        out.append(body)
                        counts.append((each[k], 0, 0))
                at += len(slab)
            null = cols[place].is_null().to_pylist()
            cols[place] = pa.array([None if z else x for z, x in zip(null, out, strict=True)], pa.binary()).cast(pa.string())
            cols += [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(EXTRA))]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return joined.mapInArrow(cut, schema)


def _cut(body: bytes, start: np.ndarray, away: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(what remains, sentences gone, characters gone)."""
    gone = np.zeros(len(start), bool)
    for a, b in away:
        gone[a:b] = True
    edge = np.append(start, len(body))
    turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
    left, chars, at = [], 0, 0
    for a, b in edge[turn].tolist():
        left.append(body[at:a])
        chars += len(body[a:b].decode())
        at = b
    return b"".join([*left, body[at:]]), int(gone.sum()), chars
