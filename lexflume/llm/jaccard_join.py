"""N-gram Jaccard self-join: grouped prefix join, exact, without listing all pairs of a large group.

1. A sketch counts, over all documents, how often shingles fall in each of its cells,
   2^20 of them, and more for a larger corpus, up to 2^24. The order of shingles, rare
   cells first, is taken from it; any order gives the same result, this one keeps
   passages that many documents share out of the prefixes.
2. Documents of identical size and prefix are one group; identical sets are one node.
   Groups meet in buckets of prefix shingles. Groups that share a shingle which few
   have are paired if sizes and positions allow the overlap; in a crowded shingle each
   meets its neighbours and a few hubs first.
3. Parity bitmaps bound the overlap of a pair from above; pairs beyond it go. Then every
   node is verified against a few of its best partners, on the whole sets, and linked
   nodes merge; twice.
4. Only pairs that are still in different components are left: those of step 2, members
   of groups, and the crowded shingles across components. They are verified alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from lexflume.llm._common import compact, components, frozen, nested, tidy
from lexflume.llm.shingles import WORDS, all_sets, mixed

#: Least and most bits of a cell's number, numbers to a cell that more bits are taken for, and cells in one row while they are summed.
CELL_BITS, PER_CELL, SLICE = (20, 24), 64, 1 << 12
#: Groups in a shingle up to which all its pairs are listed at once; neighbours and hubs that each meets first beyond.
FEW, NEIGHBOURS, HUBS = 32, 12, 12
#: Partners that each node is verified against in each of the rounds that merge components first.
ROUNDS = (4, 12)
#: Prefix shingles a bucket is meant to hold, whatever the corpus.
BUCKET_ROWS = 250_000


def least_overlap(a, b):
    """Of sets of sizes a and b, the smallest intersection with 100 * I >= 75 * U."""
    return (3 * (a + b) + 6) // 7


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


# ---------------------------------------------------------------- the sketch


def cell_bits(n: int, per_cell: int = PER_CELL) -> int:
    """So many bits that about per_cell of n numbers fall in a cell, within CELL_BITS."""
    return int(min(max((max(n, 1) // per_cell).bit_length() - 1, CELL_BITS[0]), CELL_BITS[1]))


def cell_of(x: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """What the cells, a power of two of them, say of hashes."""
    return cells[(x >> np.uint64(65 - len(cells).bit_length())).astype(np.int64)]


def _summed(parts: DataFrame, bits: int) -> np.ndarray:
    """The sums of 2^bits counters from rows (slice, counts); every slice is summed as it streams by, and only sums travel on."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                v = np.frombuffer(x.as_py(), np.int32)
                total[k] = total[k] + v if k in total else v.astype(np.int64)
        keys = list(total)
        # what order and filters need: eight steps a doubling, in one byte
        steps = [np.minimum(255, np.ceil(8 * np.log2(1 + total[k]))).astype(np.uint8).tobytes() for k in keys]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(steps, pa.binary())], names=["slice", "counts"])

    out = np.zeros(1 << bits, np.uint8)
    for r in parts.repartition("slice").mapInArrow(add, "slice int, counts binary").collect():  # a byte a cell, 16 MB at most
        out[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["counts"], np.uint8)
    return out


def _count_cells(batches: Iterator[pa.RecordBatch], hashes, bits: int) -> Iterator[pa.RecordBatch]:
    counts, held, n, shift = np.zeros(1 << bits, np.int32), [], 0, np.uint64(64 - bits)
    for batch in batches:
        for h in hashes(batch):
            held.append((h >> shift).astype(np.int32))
            n += len(h)
            if n > 500_000:
                counts += np.bincount(np.concatenate(held), minlength=len(counts)).astype(np.int32)
                held, n = [], 0
    if held:
        counts += np.bincount(np.concatenate(held), minlength=len(counts)).astype(np.int32)
    used = [k for k in range(len(counts) // SLICE) if counts[k * SLICE : (k + 1) * SLICE].any()]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([counts[k * SLICE : (k + 1) * SLICE].tobytes() for k in used], pa.binary())], names=["slice", "counts"])


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in batch.column("_text").cast(pa.binary()))


def shingle_cells(docs: DataFrame) -> np.ndarray:
    """In steps of a logarithm, how many documents have a shingle in each cell; about one shingle to six bytes is reckoned with."""
    bits = cell_bits((docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0) // 6)
    return _summed(docs.select("_text").mapInArrow(lambda it: _count_cells(it, lambda b: all_sets(_texts(b)), bits), "slice int, counts binary"), bits)


def id_cells(ids: DataFrame, name: str, n: int) -> np.ndarray:
    """The cells in which any of the n ids falls."""
    bits = cell_bits(n, 1)

    def hashes(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [mixed(batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))]

    return _summed(ids.select(name).mapInArrow(lambda it: _count_cells(it, hashes, bits), "slice int, counts binary"), bits) > 0


# ---------------------------------------------------------------- documents


def ordered(s: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The set in the global order: step of its cell, then hash."""
    key = (cell_of(s, steps).astype(np.uint64) << np.uint64(56)) | (s & np.uint64((1 << 56) - 1))
    key.sort()
    return key


def bitmap(s: np.ndarray) -> bytes:
    """Parity of the set's elements in each of a power of two of places, four to eight for each element, 256 at least."""
    places = 1 << max(8, int(4 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_link(x: bytes, y: bytes, a: int, b: int) -> bool:
    """False only if the bitmaps prove the overlap of sets of sizes a and b too small."""
    p, q = np.unpackbits(np.frombuffer(x, np.uint8)), np.unpackbits(np.frombuffer(y, np.uint8))
    while len(p) > len(q):
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    while len(q) > len(p):
        q = q[: len(q) // 2] ^ q[len(q) // 2 :]
    apart = int((p ^ q).sum())
    return a + b - apart >= 2 * least_overlap(a, b)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def _group(key: np.ndarray, n: int) -> int:
    return xxh3_64_intdigest(key[: prefix_length(n)].tobytes(), seed=n)


def facts(docs: DataFrame, shared) -> DataFrame:
    """(_key, n, gh, s1, s2, bits) of each row: set size, hash of size and prefix, hash and bitmap of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = shared.value
        for batch in batches:
            n, gh, s1, s2, bits = [], [], [], [], []
            for s in all_sets(_texts(batch)):
                d = xxh3_128_digest(s.tobytes())
                n.append(len(s))
                gh.append(_group(ordered(s, steps), len(s)) if len(s) else 0)
                s1.append(int.from_bytes(d[:8], "little"))
                s2.append(int.from_bytes(d[8:], "little"))
                bits.append(bitmap(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(n, pa.int64()), _signed(gh), _signed(s1), _signed(s2), pa.array(bits, pa.binary())], names=["_key", "n", "gh", "s1", "s2", "bits"])

    return docs.mapInArrow(run, "_key long, n long, gh long, s1 long, s2 long, bits binary")


_ENTRY = np.dtype([("token", "<u8"), ("gh", "<u8"), ("n", "<u4"), ("pos", "<u4")])


def _bucket_parts(docs: DataFrame, shared, buckets: int) -> DataFrame:
    """(p, entries): the prefix shingles of documents, packed by bucket."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        e = np.concatenate(held) if held else np.zeros(0, _ENTRY)
        e = np.unique(e)
        p = (mixed(e["token"]) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(p, kind="stable")
        e, p = e[by], p[by]
        keys, at = np.unique(p, return_index=True)
        parts = [x.tobytes() for x in np.split(e, at[1:])] if len(keys) else []
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(parts, pa.binary())], names=["p", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, held, size = shared.value, [], 0
        for batch in batches:
            for s in all_sets(_texts(batch)):
                if not len(s):
                    continue
                n, key = len(s), ordered(s, steps)
                e = np.empty(prefix_length(n), _ENTRY)
                e["token"], e["gh"], e["n"], e["pos"] = key[: len(e)], _group(key, n), n, np.arange(len(e))
                held.append(e)
                size += len(e)
                if size > 1_000_000:
                    yield flush(held)
                    held, size = [], 0
        yield flush(held)

    return docs.select("_text").mapInArrow(run, "p long, entries binary")


def pairs_of(e: np.ndarray, few: int, neighbours: int, hubs: int) -> tuple[np.ndarray, np.ndarray]:
    """From a bucket's entries: rows (smaller gh, larger gh, shingles met in), and the entries of crowded shingles, those in more than few groups."""
    e = np.unique(e)  # a document's copies give equal entries
    e = e[np.lexsort((e["gh"], e["n"], e["token"]))]
    new = np.concatenate([[True], e["token"][1:] != e["token"][:-1]])
    run = np.cumsum(new) - 1
    size = np.bincount(run)
    e, run = e[size[run] > 1], run[size[run] > 1]
    crowded = size[run] > few
    found = []

    def meet(i: np.ndarray, j: np.ndarray) -> None:
        a, b = e[i], e[j]
        most = least_overlap(a["n"].astype(np.int64), b["n"].astype(np.int64))
        big, small = np.maximum(a["n"], b["n"]).astype(np.int64), np.minimum(a["n"], b["n"]).astype(np.int64)
        ok = (4 * small >= 3 * big) & (a["gh"] != b["gh"]) & (a["n"] - most >= a["pos"]) & (b["n"] - most >= b["pos"])
        x, y = a["gh"][ok], b["gh"][ok]
        found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], 1))

    for k in range(1, max(few, neighbours + 1)):
        i = np.flatnonzero(run[k:] == run[:-k]) if len(run) > k else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[~crowded[i] | (k <= neighbours)]
        meet(i, i + k)
    hot = np.flatnonzero(crowded)
    for part in np.split(hot, np.flatnonzero(np.diff(run[hot])) + 1) if len(hot) else []:
        for hub in part[np.argsort(e["gh"][part])[:hubs]]:
            meet(np.full(len(part), hub), part)
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    if len(pairs):
        pairs, counts = np.unique(pairs, axis=0, return_counts=True)
    else:
        counts = np.zeros(0, np.int64)
    return np.column_stack([pairs, counts.astype(np.uint64)]), e[crowded]


def meetings(docs: DataFrame, shared, buckets: int) -> DataFrame:
    """(hot, x, y, n, pos): with hot false groups x and y that meet in n shingles; else shingle x has group y of size n at pos."""

    def run(table: pa.Table) -> pa.Table:
        e = np.concatenate([np.frombuffer(x.as_py(), _ENTRY) for x in table.column("entries")])
        pairs, hot = pairs_of(e, FEW, NEIGHBOURS, HUBS)
        return pa.table({
            "hot": pa.array(np.repeat([False, True], [len(pairs), len(hot)])),
            "x": _signed(np.concatenate([pairs[:, 0], hot["token"]])),
            "y": _signed(np.concatenate([pairs[:, 1], hot["gh"]])),
            "n": pa.array(np.concatenate([pairs[:, 2].astype(np.int64), hot["n"].astype(np.int64)])),
            "pos": pa.array(np.concatenate([np.zeros(len(pairs), np.int64), hot["pos"].astype(np.int64)])),
        })

    return _bucket_parts(docs, shared, buckets).groupBy("p").applyInArrow(run, "hot boolean, x long, y long, n long, pos long")


# ---------------------------------------------------------------- pairs of nodes


def _with_side(pairs: DataFrame, table: DataFrame, side: str, columns: list[str]) -> DataFrame:
    return pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)


def near_enough(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b, met) whose bitmaps allow a link."""
    both = _with_side(_with_side(pairs, nodes, "a", ["n", "bits"]), nodes, "b", ["n", "bits"])
    both = both.where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [may_link(p, q, a, b) for p, q, a, b in zip(*(batch.column(c).to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b")), strict=True)]
            yield batch.select(["a", "b", "met"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "met", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long, met long")


def sets_of(needed: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in needed.

    Sets are built only for these: a map of bounded size of the cells of their ids
    keeps most others from being hashed, an exact join the rest.
    """
    cells = docs.sparkSession.sparkContext.broadcast(id_cells(needed, "node", needed.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = cells.value
        for batch in batches:
            ids = mixed(batch.column("_key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            batch = batch.filter(pa.array(cell_of(ids, hit)))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array([s.tobytes() for s in all_sets(_texts(batch))], pa.binary())], names=["node", "shingles"])

    sets = docs.where("_key is not null").mapInArrow(run, "node long, shingles binary")
    return frozen(sets.join(needed, "node", "left_semi"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, decided on the whole sets."""
    both = _with_side(_with_side(pairs, sets, "a", ["shingles"]), sets, "b", ["shingles"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * common >= 75 * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "shingles_a", "shingles_b").mapInArrow(check, "a long, b long").distinct()


def wide_sets(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """sets, with those of pairs' nodes added that aren't there: members of groups that weren't candidates themselves."""
    more = compact(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(sets.select("node"), "node", "left_anti"))
    return sets if more.isEmpty() else sets.unionByName(sets_of(more, docs))


def _best(pairs: DataFrame, partners: int) -> DataFrame:
    """For each node up to so many partners: of each share of them, by hash, the one met in most shingles."""
    each = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "met").unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v"), "met"))
    best = each.groupBy("u", F.pmod(F.xxhash64("v"), F.lit(partners)).alias("share")).agg(F.max(F.struct("met", "v")).alias("top"))
    return best.select(F.least("u", "top.v").alias("a"), F.greatest("u", "top.v").alias("b")).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends aren't in one component yet."""
    for side in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}")), side, "left")
    return pairs.where("coalesce(c_a, a) <> coalesce(c_b, b)").drop("c_a", "c_b")


def _across(hot: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """From crowded shingles, the pairs of nodes in different components whose sizes and positions allow a link."""
    e = hot.join(nodes.select("node", "gh"), "gh").join(labels, "node", "left").select("token", "node", "n", "pos", F.coalesce("component", "node").alias("c"))
    e = compact(e)
    split = e.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("token")
    e = e.join(split, "token", "left_semi")
    l, r = e.alias("l"), e.alias("r")
    most = "(3 * (l.n + r.n) + 6) div 7"
    met = l.join(r, F.expr(f"l.token = r.token and l.c < r.c and 4 * least(l.n, r.n) >= 3 * greatest(l.n, r.n) and l.n - {most} >= l.pos and r.n - {most} >= r.pos"))
    return met.groupBy(F.expr("least(l.node, r.node)").alias("a"), F.expr("greatest(l.node, r.node)").alias("b")).agg(F.count(F.lit(1)).alias("met"))


def jaccard_links(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts of all rows, node of each set, links between nodes) of docs; see similar_documents.

    The links are a subset that spans every component, not all of them: pairs that
    others have joined already are never looked at.
    """
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{text}`").alias("_text"))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(shingle_cells(docs))
    known = compact(facts(docs, shared))
    linkable = known.where("n > 0 and _key is not null")
    node = compact(linkable.groupBy("s1", "s2").agg(F.min("_key").alias("node"), F.first("n").alias("n"), F.first("gh").alias("gh")))
    nodes = node.join(linkable.select(F.col("_key").alias("node"), "s1", "s2", "bits"), ["node", "s1", "s2"]).dropDuplicates(["node", "s1", "s2"]).select("node", "n", "gh", "bits")
    total = linkable.agg(F.sum("n")).first()[0] or 0
    met = frozen(meetings(docs, shared, max(16, -(-total // (4 * BUCKET_ROWS)))))
    heads = node.groupBy("gh").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("members"))
    group_pairs = met.where("not hot").groupBy("x", "y").agg(F.sum("n").alias("met"))
    by_x = group_pairs.join(heads.select(F.col("gh").alias("x"), F.col("head").alias("hx"), F.col("members").alias("mx")), "x")
    by_xy = by_x.join(heads.select(F.col("gh").alias("y"), F.col("head").alias("hy"), F.col("members").alias("my")), "y")
    heads_met = by_xy.select(F.least("hx", "hy").alias("a"), F.greatest("hx", "hy").alias("b"), "met")
    within = node.join(heads.where("members > 1"), "gh").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"), F.col("n").alias("met"))
    tidy(spark)
    likely = compact(near_enough(heads_met.unionByName(within), nodes))
    hot = met.where("hot").select(F.col("x").alias("token"), F.col("y").alias("gh"), "n", "pos")
    crowd = hot.select("gh").distinct().join(node.select("gh", "node"), "gh").select("node")
    sets = sets_of(compact(likely.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowd).distinct()), docs)
    links, tried, left = None, None, likely
    for partners in ROUNDS:
        tidy(spark)
        best = compact(_best(left, partners))
        tried = best if tried is None else tried.unionByName(best)
        found = verified(best, sets)
        links = compact(found if links is None else links.unionByName(found))
        labels = components(links)
        left = compact(_apart(left.join(tried, ["a", "b"], "left_anti"), labels))
    # What is left: pairs in different components.
    member = node.join(heads.where("members > 1").select("gh"), "gh", "left_semi").join(labels, "node", "left").select("gh", "node", F.coalesce("component", "node").alias("c"))
    wide = by_xy.where("mx > 1 or my > 1").select("x", "y", "met")
    lone = node.select("gh", "node")
    of_x = wide.join(lone.select(F.col("gh").alias("x"), F.col("node").alias("a")), "x").join(lone.select(F.col("gh").alias("y"), F.col("node").alias("b")), "y")
    ordered_pair = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    l, r = member.alias("l"), member.alias("r")
    inside = l.join(r, F.expr("l.gh = r.gh and l.c < r.c")).select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b"), F.lit(1).cast("long").alias("met"))
    rest = _apart(left.unionByName(near_enough(_apart(of_x.select(*ordered_pair, "met"), labels).unionByName(inside), nodes)), labels)
    crowded = near_enough(_across(hot, node, labels), nodes)
    tidy(spark)
    rest = compact(rest.unionByName(crowded).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
    inside_sets = wide_sets(rest, sets, docs)
    more = verified(rest, inside_sets)
    found = compact(links.unionByName(more))
    tidy(spark)
    return known, node, found


def similar_documents(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_shingles and component_id of every row of docs.

    Words are runs outside ASCII white space with A-Z lower-cased; a set holds the
    distinct five-word shingles, or the whole sequence if there are fewer words. Two
    rows link if 100 * intersection >= 75 * union; component_id is the smallest key
    reachable by links. Rows without words (null and empty texts) have 0 shingles
    and link with nothing. key: whole numbers. Rows with one key are one document,
    linked if any of their texts is; rows whose key is null link with nothing and have
    no component; rows that repeat whole are judged alike. A very long text is hashed
    in parts. Other columns are not carried, whatever their names. An empty table gives
    no rows.
    """
    known, node, links = jaccard_links(docs, text=text, key=key)
    labels = components(links)
    of_set = node.join(labels, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    joined = known.select("_key", "n", "s1", "s2").join(of_set, ["s1", "s2"], "left")
    label = F.when((F.col("n") > 0) & F.col("_key").isNotNull(), F.col("component")).otherwise(F.col("_key"))
    return joined.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), label.alias("component_id"))


def drop_similar(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs without the rows that are linked with a smaller key, with all columns whatever their names.

    One document, the one of the smallest key, stays of each component, with all of
    its rows. Rows with a null key, and those without words, stay as they are; an
    empty table gives no rows.
    """
    gone = similar_documents(docs, text=text, key=key).where(F.col("component_id") < F.col(f"`{key}`")).select(F.col(f"`{key}`").alias("key")).distinct()
    rows = nested(docs).select("row", F.col(f"row.`{key}`").cast("long").alias("key"))
    return rows.join(gone, "key", "left_anti").select("row.*")
