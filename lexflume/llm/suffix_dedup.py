"""Exact substring dedup: bytes covered by a 50-byte string that a document with a smaller key has too.

1. Every 50-byte window of a document has an anchor: its 20-byte string of smallest
   hash, the leftmost of equals. Anchors depend on nothing but the window's bytes, so
   equal windows have equal anchors. Neighbouring windows with one anchor place are a
   stretch; there is about one to 16 bytes. Equal stretches that follow each other, as
   in a text of one repeated byte, are one entry with their number.
2. Stretches meet by the hash of their anchor, in buckets. Equal stretches are one
   class, with the smallest document that has it; all others are covered whole. Before
   the shuffle each task keeps one document of each class, so a passage in a third of
   all documents costs a bucket one entry a task.
3. Different classes with one anchor may share some windows. Their bytes are fetched
   and their suffixes sorted by linear grouping (suffix_order): suffixes that agree in
   50 bytes are neighbours in the order, and the smallest document among them keeps its
   bytes. An anchor with more than CROWDED classes, in a task or in its bucket, is
   split into its windows, which meet by their own hash as in step 2; so a bucket gets
   a bounded number of classes of an anchor from a task (ASIDE times CROWDED).
4. What is covered is cut from the rows. A row is its key and the hash of its text.

Classes of one anchor are equal if a hash of 64 bits is, windows anywhere if two are
that are made with different multipliers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.llm._common import stored
from lexflume.llm.jaccard_join import cell_of, id_cells
from lexflume.llm.shingles import mixed, slabs
from lexflume.llm.suffix_order import suffix_order

#: Length of a repeat, of an anchor, and how many anchors a window has.
LENGTH, ANCHOR = 50, 20
ANCHORS = LENGTH - ANCHOR + 1
#: Windows whose anchor isn't in their middle reach this far beyond it on one side.
REACH = (LENGTH - ANCHOR + 1) // 2
#: Entries that a bucket is meant to hold; entries after which a task passes on what it has; classes of an anchor beyond which it is crowded.
BUCKET_ROWS, FLUSH_ROWS, CROWDED = 300_000, 500_000, 48
#: How many times more it takes in a task, which can't know yet which of them may share windows.
ASIDE = 16
#: Bytes of text whose stretches are found at once, which takes about eighty times as much memory; entries that are packed for one batch.
SCAN_BYTES, PACKED_ROWS = 1 << 18, 50_000
#: Bytes of short texts whose suffixes are sorted in step.
SORTED_BYTES = 1 << 20
LAST = np.iinfo(np.int64).max

_BYTE, _OTHER = np.random.default_rng(20240509).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP, _STRIDE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F)
#: Bits of a minimum's key that hold a place within a slab; the rest are of the hash.
_PLACE_BITS = np.uint64(31)

#: h: hash of the anchor or window; s: of the class; doc, tag: key of the row and hash of its text. `more` windows follow that at lo; all of it comes
#: `rep` times, `step` bytes apart. left, right: fingerprints beyond the anchor. An entry of MARK `more` says that its anchor is crowded elsewhere.
ENTRY = np.dtype([("h", "<u8"), ("s", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("lo", "<u4"), ("rep", "<u4"), ("more", "u1"), ("step", "u1"), ("left", "u1"), ("right", "u1")])
MARK = 255


def rolled(data: np.ndarray, lengths: tuple[int, ...], table: np.ndarray = _BYTE, step: np.uint64 = _STEP) -> list[np.ndarray]:
    """For each length the hash of the string of that length from every byte on; ends that don't fit are left out."""

    def _power(k: int) -> np.uint64:
        return np.uint64(pow(int(step), k, 1 << 64))

    doubled = {1: table[data]}
    k = 1
    while 2 * k <= max(lengths):
        h = doubled[k]
        doubled[2 * k] = h[:-k] * _power(k) + h[k:] if len(h) > k else h[:0]
        k *= 2
    out = []
    for n in lengths:
        h, have = None, 0
        for k in sorted(doubled, reverse=True):
            if n & k:
                part = doubled[k]
                size = max(len(data) - have - k + 1, 0)
                h = part[:size] if h is None else h[:size] * _power(k) + part[have : have + size]
                have += k
        out.append(h)
    return out


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(entries without rows, number of entries of each text)."""
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < LENGTH:
        return np.zeros(0, ENTRY), np.zeros(len(texts), np.int64)
    side = ANCHOR + REACH
    anchor, window, reach = rolled(data, (ANCHOR, LENGTH, side))
    key = (mixed(anchor) >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(anchor), dtype=np.uint64)
    low, have = key, 1
    while 2 * have <= ANCHORS:
        low, have = np.minimum(low[:-have], low[have:]), 2 * have
    n = len(data) - LENGTH + 1
    low = np.minimum(low[:n], low[ANCHORS - have : ANCHORS - have + n])
    at = (low & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    count = np.maximum(sizes - LENGTH + 1, 0)
    ends = np.cumsum(count)
    inside = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - count), count)
    if not len(inside):
        return np.zeros(0, ENTRY), np.zeros(len(texts), np.int64)
    owner = np.repeat(np.arange(len(texts)), count)
    anchors = at[inside]
    new = np.append(True, (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(new)
    lo = inside[first]
    hi = inside[np.append(first[1:], len(inside)) - 1]
    p = anchors[first]
    e = np.zeros(len(lo), ENTRY)
    e["h"] = mixed(anchor[p])
    e["s"] = mixed(mixed(window[lo]) * _STEP + window[hi] + (hi - lo).astype(np.uint64))
    e["lo"] = lo - starts[owner[first]]
    e["more"], e["step"] = hi - lo, hi - lo + 1
    # Fingerprints of what reaches beyond the anchor: a shared window reaches REACH bytes on the left or on the right.
    before = p - REACH
    ok = before >= starts[owner[first]]
    e["left"] = np.where(ok, mixed(reach[np.maximum(before, 0)]) & np.uint64(127), 128 + (np.arange(len(p)) & 127))
    ok = p + side <= (starts + sizes)[owner[first]]
    e["right"] = np.where(ok, mixed(reach[np.minimum(p, len(reach) - 1)]) & np.uint64(127), 128 + (np.arange(len(p)) & 127))
    # Equal stretches in a row are one entry: their windows, and so all that can be shared, are the same.
    apart = np.ones(len(e), bool)
    apart[1:] = (e["h"][1:] != e["h"][:-1]) | (e["s"][1:] != e["s"][:-1]) | (owner[first][1:] != owner[first][:-1])
    at = np.flatnonzero(apart)
    e, first = e[at], first[at]
    e["rep"] = np.diff(np.append(at, len(apart)))
    return e, np.bincount(owner[first], minlength=len(texts))


# ---------------------------------------------------------------- entries on their way


def _planes(a: np.ndarray, width: int) -> bytes:
    """The low bytes of whole numbers, byte by byte in planes, which compress well."""
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplaned(x: bytes, width: int) -> np.ndarray:
    a = np.frombuffer(x, np.uint8).reshape(width, -1)
    out = np.zeros((a.shape[1], 8), np.uint8)
    out[:, :width] = a.T
    return out.reshape(-1).view("<u8")


#: Columns of an entry that travel as planes of so many bytes; rows travel once each.
_WIDTHS = (("h", 8), ("s", 8), ("lo", 4), ("rep", 4), ("more", 1), ("step", 1), ("left", 1), ("right", 1))


def packed(e: np.ndarray) -> bytes:
    """Entries of one bucket, row by row."""
    e = e[np.lexsort((e["tag"], e["doc"]))]
    new = np.ones(len(e), bool)
    new[1:] = (e["doc"][1:] != e["doc"][:-1]) | (e["tag"][1:] != e["tag"][:-1])
    parts = [_planes(new, 1), *(_planes(e[new][k].view(np.uint64), 8) for k in ("doc", "tag")), *(_planes(e[k], width) for k, width in _WIDTHS)]
    return len(e).to_bytes(4, "little") + int(new.sum()).to_bytes(4, "little") + b"".join(parts)


def unpacked(x: bytes) -> np.ndarray:
    n, rows = int.from_bytes(x[:4], "little"), int.from_bytes(x[4:8], "little")
    e, at = np.zeros(n, ENTRY), 8
    row = np.cumsum(_unplaned(x[at : at + n], 1)).astype(np.int64) - 1
    at += n
    for name in ("doc", "tag"):
        e[name] = _unplaned(x[at : at + 8 * rows], 8).view(np.int64)[row]
        at += 8 * rows
    for name, width in _WIDTHS:
        e[name] = _unplaned(x[at : at + n * width], width)
        at += n * width
    return e


OUT = "key long, tag long, kind int, lo long, hi long, rep int, step int, h long, p long, entries binary"
NAMES = [x.split()[0] for x in OUT.split(", ")]
COVERED, WANTED, CROWD, ENTRIES = range(4)


def _batch(n: int, kind, **columns) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "rep": pa.int32(), "step": pa.int32(), "entries": pa.binary()}
    columns["kind"] = np.full(n, kind, np.int32) if np.isscalar(kind) else kind
    return pa.RecordBatch.from_arrays([pa.array(columns[k], kinds.get(k, pa.int64())) if k in columns else pa.nulls(n, kinds.get(k, pa.int64())) for k in NAMES], names=NAMES)


def _covered(e: np.ndarray) -> pa.RecordBatch:
    """The windows of entries; of one that repeats without gaps as one stretch, else each time."""
    whole = e["step"] == e["more"] + 1
    times = np.where(whole, 1, e["rep"]).astype(np.int64)
    k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    lo = np.repeat(e["lo"].astype(np.int64), times) + k * np.repeat(e["step"].astype(np.int64), times)
    size = np.where(whole, e["rep"].astype(np.int64) * e["step"], e["more"].astype(np.int64) + 1)
    return _batch(len(lo), COVERED, key=np.repeat(e["doc"], times), tag=np.repeat(e["tag"], times), lo=lo, hi=lo + np.repeat(size, times) - 1)


def _asked(e: np.ndarray, crowded) -> pa.RecordBatch:
    lo = e["lo"].astype(np.int64)
    kind = np.where(np.broadcast_to(crowded, len(e)), CROWD, WANTED).astype(np.int32)
    return _batch(len(e), kind, key=e["doc"], tag=e["tag"], lo=lo, hi=lo + e["more"], rep=e["rep"].astype(np.int32), step=e["step"].astype(np.int32), h=e["h"].view(np.int64))


def _entry_rows(e: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each bucket; what is packed leaves before more is."""
    by = np.argsort(p, kind="stable")
    keys, at = np.unique(p[by], return_index=True)
    blobs, size = [], 0
    for k, rows in enumerate(np.split(by, at[1:]) if len(keys) else [], 1):
        blobs.append(packed(e[rows]))
        size += len(rows)
        if size > PACKED_ROWS or k == len(keys):
            yield _batch(len(blobs), ENTRIES, p=keys[k - len(blobs) : k].astype(np.int64), entries=blobs)
            blobs, size = [], 0


def classes(e: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries covered whole because a smaller document has their class, those of the smallest document of each class); new marks the first of each."""
    if not len(e):
        return e, e
    least = np.minimum.reduceat(e["doc"], np.flatnonzero(new))[np.cumsum(new) - 1]
    return e[e["doc"] > least], e[e["doc"] == least]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run that each of the sorted values is in, length of each run)."""
    new = np.append(True, values[1:] != values[:-1])
    run = np.cumsum(new) - 1
    return run, np.bincount(run)


def combined(e: np.ndarray, buckets: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """What a task passes on: what it knows to be covered, its entries by bucket, and of anchors with far over `most` entries the stretches, with a mark for the bucket."""
    e = e[np.lexsort((e["s"], e["h"]))]
    covered, e = classes(e, np.append(True, (e["h"][1:] != e["h"][:-1]) | (e["s"][1:] != e["s"][:-1])))
    if len(covered):
        yield _covered(covered)
    del covered
    if most is not None:
        run, size = _runs(e["h"])
        crowded = (size > ASIDE * most)[run]
        if crowded.any():
            yield _asked(e[crowded], True)
            marks = e[crowded & np.append(True, run[1:] != run[:-1])].copy()
            marks["more"], marks["doc"], marks["tag"] = MARK, LAST, 0
            e = np.concatenate([e[~crowded], marks])
    yield from _entry_rows(e, (e["h"] % np.uint64(buckets)).astype(np.int64))


def settled(e: np.ndarray, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Of a bucket: entries covered whole, and of anchors with several classes those that may share windows; without `most`, of windows, the former only."""
    crowd = np.unique(e["h"][e["more"] == MARK])
    e = e[e["more"] != MARK]
    e = e[np.lexsort((e["s"], e["h"]))]
    covered, left = classes(e, np.append(True, (e["h"][1:] != e["h"][:-1]) | (e["s"][1:] != e["s"][:-1])))
    yield _covered(covered)
    if most is None or not len(left):
        return
    marked = np.isin(left["h"], crowd)
    if marked.any():
        yield _asked(left[marked], True)
        left = left[~marked]
    if not len(left):
        return
    new = np.append(True, left["h"][1:] != left["h"][:-1])
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    several = np.minimum.reduceat(left["s"], first) != np.maximum.reduceat(left["s"], first)
    several &= np.minimum.reduceat(left["doc"], first) != np.maximum.reduceat(left["doc"], first)
    left, group = left[several[group]], group[several[group]]
    wanted = np.zeros(len(left), bool)
    for side in ("left", "right"):
        _, place, times = np.unique(group * 256 + left[side], return_inverse=True, return_counts=True)
        wanted |= (times[place] > 1) & (left[side] < 128)
    left, group = left[wanted], group[wanted]
    size = np.bincount(group) if len(group) else np.zeros(1, np.int64)
    yield _asked(left, size[group] > most)


def _bucket(table: pa.Table, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """A group of rows of one bucket: entries are settled, all else passes."""
    plain = table.filter(pc.not_equal(table.column("kind"), ENTRIES))
    yield from plain.to_batches()
    blobs = table.filter(pc.equal(table.column("kind"), ENTRIES)).column("entries")
    if len(blobs):
        yield from settled(np.concatenate([unpacked(x.as_py()) for x in blobs]), most)


def _bucketed(rows: DataFrame, buckets: int, most: int) -> DataFrame:
    """Entries by bucket, all else by document."""
    p = F.when(F.col("kind") == ENTRIES, F.col("p")).otherwise(-1 - F.pmod(F.xxhash64("key", "tag"), F.lit(buckets)))

    def run(table: pa.Table) -> pa.Table:
        table = table.select(NAMES)
        return pa.Table.from_batches(list(_bucket(table, most)), table.schema)

    return rows.withColumn("bucket", p).groupBy("bucket").applyInArrow(run, OUT)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in batch.column("_text").cast(pa.binary()))


#: Bytes of a text taken at once; longer ones come in parts that share LENGTH - 1 bytes, so each window is in one part.
PART = SCAN_BYTES


def _parts(row: int, text: bytes, places: list[tuple[int, int]]) -> Iterator[bytes]:
    for start in range(0, max(len(text) - LENGTH + 1, 1), PART):
        places.append((row, start))
        yield text if len(text) < PART + LENGTH else text[start : start + PART + LENGTH - 1]


def _scan(docs: DataFrame, buckets: int, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def taken() -> np.ndarray:
            e = np.concatenate(held)
            held.clear()
            return e

        for batch in batches:
            keys, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_key", "_tag"))
            parts, at = [], 0
            for slab in slabs((x for k, text in enumerate(_texts(batch)) for x in _parts(k, text, parts)), SCAN_BYTES):
                e, counts = stretches(slab)
                row, start = np.array(parts[at : at + len(slab)], np.int64).reshape(-1, 2).T
                e["doc"], e["tag"] = np.repeat(keys[row], counts), np.repeat(tags[row], counts)
                e["lo"] += np.repeat(start, counts).astype(np.uint32)
                at += len(slab)
                held.append(e)
                size += len(e)
                if size > FLUSH_ROWS:
                    yield from combined(taken(), buckets, most)
                    size = 0
        if size:
            yield from combined(taken(), buckets, most)

    return docs.mapInArrow(run, OUT)


# ---------------------------------------------------------------- stretches that may share windows


def shared_windows(h: np.ndarray, doc: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """(row, window) of the windows of strings that a smaller document with the same h has too.

    Every h makes one text: its strings, each closed by a separator. Suffixes of all
    texts are sorted in step, a bounded number of bytes at a time.
    """
    out = []
    by = np.argsort(h, kind="stable")
    cut = np.flatnonzero(np.append(True, h[by][1:] != h[by][:-1])) if len(by) else by
    held, total = [], 0
    for rows in np.split(by, cut[1:]) if len(by) else []:
        if len(rows) > 1 and doc[rows].min() != doc[rows].max():
            held.append(rows)
            total += sum(len(strings[r]) + 1 for r in rows) + 1
            if total > SORTED_BYTES:
                out.append(_sorted(held, doc, strings))
                held, total = [], 0
    if held:
        out.append(_sorted(held, doc, strings))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _sorted(lanes: list[np.ndarray], doc: np.ndarray, strings: list[bytes]) -> np.ndarray:
    parts, size = [], []
    for rows in lanes:
        joined = b"".join(strings[r] + b"\0" for r in rows) + b"\0"
        size.append(len(joined))
        parts.append(joined)
    size = np.array(size)
    base = np.concatenate([[0], np.cumsum(size)[:-1]])
    text = np.frombuffer(b"".join(parts), np.uint8).astype(np.int16) + 2
    rows = np.concatenate(lanes)
    lengths = np.array([len(strings[r]) for r in rows])
    inner = np.cumsum(lengths + 1) - (lengths + 1) + np.repeat(np.arange(len(lanes)), [len(x) for x in lanes])
    text[inner + lengths] = 1  # separators; each text ends with the smallest symbol
    text[base + size - 1] = 0
    owner, window = np.full(len(text), -1, np.int64), np.zeros(len(text), np.int64)
    fits = np.maximum(lengths - LENGTH + 1, 0)
    at = np.arange(fits.sum()) + np.repeat(inner - (np.cumsum(fits) - fits), fits)
    owner[at] = np.repeat(rows, fits)
    window[at] = at - np.repeat(inner, fits)
    order = suffix_order(text, base, size)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero((owner[a] >= 0) & (owner[b] >= 0))
    for k in range(LENGTH):  # agreement of neighbours in LENGTH symbols
        near = near[text[a[near] + k] == text[b[near] + k]]
    new = np.ones(len(order), bool)
    new[near + 1] = False
    kept = owner[order] >= 0
    run = np.cumsum(new)[kept] - 1
    who = owner[order][kept]
    least = np.full(int(new.sum()), LAST)
    np.minimum.at(least, run, doc[who])
    gone = doc[who] > least[run]
    return np.stack([who[gone], window[order][kept][gone]], 1)


def _windows(places: np.ndarray, parts: list[bytes]) -> np.ndarray:
    """An entry for each window of the parts at places (key, tag, lo, rep, step)."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    size = np.array([len(x) for x in parts])
    many, base = size - LENGTH + 1, np.cumsum(size) - size
    k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(base, many) + k
    e = np.zeros(len(at), ENTRY)
    e["h"], e["s"] = mixed(rolled(data, (LENGTH,))[0][at]), mixed(rolled(data, (LENGTH,), _OTHER, _STRIDE)[0][at])
    for name, column in zip(("doc", "tag", "lo", "rep", "step"), places.T, strict=True):
        e[name] = np.repeat(column, many)
    e["lo"] += k.astype(np.uint32)
    return e


def _fetched(docs: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """The rows that settle the wanted stretches: their bytes by anchor, or their windows by hash where an anchor is crowded."""
    asked = wanted.groupBy("key", "tag").agg(F.collect_list(F.struct("lo", "hi", "rep", "step", "h", (F.col("kind") == CROWD).alias("crowd"))).alias("ask"))
    # A broadcast join, as small tables get, would chain two Python steps in a task: a second worker for each core, which keeps its memory.
    met = _touched(docs, wanted.select("key")).join(asked.hint("merge"), (F.col("_key") == F.col("key")) & (F.col("_tag") == F.col("tag"))).select("_key", "_tag", "_text", "ask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, crowd, size = [], [], 0
        for batch in batches:
            rows, blob = [], []
            for key, tag, x, ask in zip(batch.column("_key").to_pylist(), batch.column("_tag").to_pylist(), _texts(batch), batch.column("ask"), strict=True):
                for a in ask.as_py():
                    part = x[a["lo"] : a["hi"] + LENGTH]
                    if a["crowd"]:
                        places.append((key, tag, a["lo"], a["rep"], a["step"]))
                        crowd.append(part)
                        size += len(part)
                        if size > FLUSH_ROWS:
                            yield from combined(_windows(np.array(places, np.int64), crowd), buckets)
                            places, crowd, size = [], [], 0
                    else:
                        rows.append((key, tag, a["lo"], a["hi"], a["rep"], a["step"], a["h"]))
                        blob.append(part)
            cols = dict(zip(("key", "tag", "lo", "hi", "rep", "step", "h"), np.array(rows, np.int64).reshape(-1, 7).T, strict=True))
            cols["rep"], cols["step"] = cols["rep"].astype(np.int32), cols["step"].astype(np.int32)
            p = buckets + (cols["h"].copy().view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            yield _batch(len(rows), WANTED, p=p, entries=blob, **cols)
        if size:
            yield from combined(_windows(np.array(places, np.int64), crowd), buckets)

    return met.mapInArrow(run, OUT)


def _compared(rows: DataFrame, buckets: int) -> DataFrame:
    p = F.when(F.col("kind") == COVERED, -1 - F.pmod(F.xxhash64("key", "tag"), F.lit(buckets))).otherwise(F.col("p"))

    def run(table: pa.Table) -> pa.Table:
        table = table.select(NAMES)
        strings = table.filter(pc.equal(table.column("kind"), WANTED))
        found = [b for b in _bucket(table.filter(pc.not_equal(table.column("kind"), WANTED))) if b.num_rows]
        if strings.num_rows:
            doc, tag, lo, rep, step = (strings.column(c).to_numpy() for c in ("key", "tag", "lo", "rep", "step"))
            gone = shared_windows(strings.column("h").to_numpy(), doc, strings.column("entries").to_pylist())
            gone = gone[np.lexsort((gone[:, 1], gone[:, 0]))]
            row, w = gone[:, 0], gone[:, 1]
            new = np.append(True, (row[1:] != row[:-1]) | (w[1:] != w[:-1] + 1)) if len(row) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            e = np.zeros(len(at), ENTRY)
            of = row[at]
            e["doc"], e["tag"], e["lo"], e["rep"], e["step"] = doc[of], tag[of], lo[of] + w[at], rep[of], step[of]
            e["more"] = w[np.append(at[1:], len(row)) - 1] - w[at] if len(at) else 0
            found.append(_covered(e))
        return pa.Table.from_batches(found, table.schema)

    return rows.withColumn("bucket", p).groupBy("bucket").applyInArrow(run, OUT)


def _touched(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose key may be among keys: a map of fixed size keeps most others from the shuffle of texts."""
    cells = docs.sparkSession.sparkContext.broadcast(id_cells(keys, "key", keys.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_hits(batch, cells.value)))

    return docs.mapInArrow(run, docs.schema)


def _hits(batch: pa.RecordBatch, cells: np.ndarray) -> np.ndarray:
    ids = mixed(batch.column("_key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
    return cell_of(ids, cells)


def covered_windows(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(key, tag, lo, hi): windows lo to hi of a row start a string that a smaller key has too. docs: _key long, _tag long, _text."""
    total = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(16, -(-total // (BUCKET_ROWS * 16)))
    met = stored(_bucketed(_scan(docs, buckets, crowded), buckets, crowded).select("key", "tag", "kind", "lo", "hi", "rep", "step", "h"), "stretches")
    parts = _compared(_fetched(docs, met.where(F.col("kind") != COVERED), buckets), buckets)
    return met.where(F.col("kind") == COVERED).select("key", "tag", "lo", "hi").unionByName(parts.select("key", "tag", "lo", "hi"))


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"


def suffix_dedup(docs: DataFrame, *, text: str = "text", key: str = "doc_id", with_text: bool = True, crowded: int = CROWDED) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text, the bytes that remain) of every row.

    Texts are their UTF-8 bytes, null texts empty. A byte goes if a 50-byte string
    over it also starts in a row with a smaller key, judged on the texts as they came;
    repeats within a row, and texts below 50 bytes, lose nothing. key: whole numbers.

    A null key is larger than all others. Rows that share a key (null too) lose nothing
    to each other, and each is judged by its own text; rows that repeat whole are judged
    alike. A very long text is taken in parts. Other columns are not carried, whatever
    their names; an empty table gives no rows.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = docs.select(F.col(f"`{key}`").alias("_own"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(int(LAST))).alias("_key"), F.xxhash64(body).alias("_tag"), body.alias("_text"))
    name = docs.schema["_own"].dataType.simpleString()
    rows = docs.select("_key", "_tag", "_text")
    covered = stored(covered_windows(rows, crowded).groupBy("key", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("gone")), "covered")
    cells = docs.sparkSession.sparkContext.broadcast(id_cells(covered, "key", covered.count()))
    extra = RESULT if with_text else RESULT.rpartition(",")[0]
    schema = f"_own {name}, {extra}"

    def result(keys: pa.Array, bodies: Iterator[bytes], gone: Iterator) -> pa.RecordBatch:
        rows = []
        for body, cuts in zip(bodies, gone, strict=True):
            removed = spans = 0
            left = body
            if cuts:
                lo, hi = (np.array([c[k] for c in cuts], np.int64) for k in ("lo", "hi"))
                edge = np.zeros(len(body) + 1, np.int64)
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi + LENGTH, -1)
                away = np.cumsum(edge[:-1]) > 0
                left = np.frombuffer(body, np.uint8)[~away].tobytes()
                removed = int(away.sum())
                spans = int(away[0]) + int((away[1:] & ~away[:-1]).sum())
            rows.append((len(body), removed, spans, hashlib.sha256(left).hexdigest(), *([left] if with_text else [])))
        cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[: 5 if with_text else 4])]
        return pa.RecordBatch.from_arrays([keys, *cols], names=["_own", *(x.split()[0] for x in extra.split(", "))])

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~_hits(batch, cells.value)))
            yield result(batch.column("_own"), _texts(batch), iter([None] * batch.num_rows))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield result(batch.column("_own"), _texts(batch), (x.as_py() for x in batch.column("gone")))

    may = _touched(docs, covered.select("key")).join(covered.hint("merge"), (F.col("_key") == F.col("key")) & (F.col("_tag") == F.col("tag")), "left").select("_own", "_text", "gone")
    every = docs.mapInArrow(untouched, schema).unionByName(may.mapInArrow(cut, schema))
    return every.select(F.col("_own").alias(key), *[x.split()[0] for x in extra.split(", ")])


def suffix_digest(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs, with_text=False)
