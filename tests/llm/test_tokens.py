import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexflume.llm import packing as P
from lexflume.llm import token_counts as T


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_str(vocabulary)


def fuzz(n, seed):
    rng = random.Random(seed)
    signs = [*"aàéΣσİß1½²#!' \t\n中😀'sABCﬁÅ\x00\x01\x1c\x85​　", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", "'VE", "the", " \x01 ", ".", ",", "!?", "don't.", "<|endoftext|>."]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_counts_are_the_librarys(spark, table, odd_texts, vocabulary, library):
    texts = [*odd_texts, *fuzz(2000, 1)]
    got = {r["doc_id"]: r for r in T.token_counts(table(texts), vocabulary).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 2048)
        assert got[i]["copy"] == "x"


def test_merging_takes_lowest_rank_first(vocabulary):
    bpe = T.HeapBpe(vocabulary)
    bpe.rank = {("b", "c"): 0, ("a", "b"): 1, ("a", "bc"): 2}
    assert bpe.merged_length(list("abc")) == 1 and bpe.merged_length(list("ab")) == 1 and bpe.merged_length(list("abab")) == 2 and bpe.merged_length([]) == 0


def test_memo_bound_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(T, "MEMO_WORDS", 3)
    bpe = T.HeapBpe(vocabulary)
    for t in fuzz(300, 2):
        assert bpe.count(t.encode()) == len(library.encode(t, add_special_tokens=False).ids)


def test_packing_round_trip(spark, table, odd_texts, vocabulary, library):
    texts = [*odd_texts, *fuzz(300, 3)]
    rows = P.pack(table(texts).repartition(3), vocabulary, size=64, ids=True).collect()
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_bin.setdefault(r["sequence_id"], []).append(r)
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["start"] for r in parts] == list(range(0, len(ids), 64)) and b"".join(r["ids"] for r in parts) == ids.tobytes()
        assert all(zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in parts)
    for held in by_bin.values():
        held.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in held] == np.cumsum([0, *(r["length"] for r in held)])[:-1].tolist() and sum(r["length"] for r in held) <= 64
    assert len(by_bin) <= 1.1 * sum(r["length"] for r in rows) / 64 + 3


class PlainBins:
    """Best fit over a list of open bins (free, number), the tightest that fits first; the fullest closes."""

    def __init__(self, size, most):
        self.size, self.most, self.open, self.made = size, most, [], 0

    def place(self, length):
        fits = [b for b in self.open if b[0] >= length]
        if fits:
            free = min(f for f, _ in fits)
            held = [b for b in self.open if b[0] == free][-1]
            self.open.remove(held)
        else:
            if len(self.open) == self.most and length < self.size:
                free = min(f for f, _ in self.open)
                self.open.remove([b for b in self.open if b[0] == free][-1])
            held = (self.size, self.made)
            self.made += 1
        if held[0] > length:
            self.open.append((held[0] - length, held[1]))
        return held[1], self.size - held[0]


@pytest.mark.parametrize(("size", "most"), [(64, 8), (100, 1), (1000, 50)])
def test_bitset_places_as_a_plain_list_does(size, most):
    rng = random.Random(size)
    a, b = P.OpenBins(size, most), PlainBins(size, most)
    for _ in range(3000):
        n = min(size, 1 + int(rng.expovariate(4 / size)))
        assert a.place(n) == b.place(n) and a.count == len(b.open) <= most


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_few_sequences_however_the_input_is_dealt(spark, vocabulary, parts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(parts, "doc_id")
    rows = P.pack(docs, vocabulary).select("sequence_id", "offset", "length").collect()
    floor, used = -(-sum(r["length"] for r in rows) // 4096), {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 4096 and len(used) <= 1.01 * floor + 1


def test_packing_keeps_columns_of_any_name(spark, vocabulary):
    df = spark.createDataFrame([(None, "a b", "s", 1, 2), (None, None, None, 3, 4), (7, "", "t", 5, 6)], "doc_id long, text string, `row` string, used int, `to.x` int").withColumns({"sequence_id": F.lit("old"), "shift": F.lit(0)})
    rows = P.pack(df, vocabulary).collect()
    assert sorted(r["to.x"] for r in rows) == [2, 4, 6] and {r["row"] for r in rows} == {"s", None, "t"} and sorted(r["used"] for r in rows) == [1, 3, 5]
    assert len({r["sequence_id"] for r in rows}) == 1 and sorted(r["length"] for r in rows) == [1, 1, 3]
    assert P.pack(spark.createDataFrame([("a",)], "text string"), vocabulary).columns == ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_fullest_bin_closes_first():
    b = P.OpenBins(10, 2)
    assert [b.place(n) for n in (6, 7, 5)] == [(0, 0), (1, 0), (2, 0)]  # both open bins are too full; bin 1 closes
    assert b.place(3) == (0, 6)  # bin 1 would fit tightest but is closed
    assert b.place(10) == (3, 0) and b.count == 2


def test_two_generations_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(P, "MEMO_WORDS", 5)
    w, texts = P.WordIds(vocabulary), fuzz(300, 4)
    for k in range(0, 300, 7):
        part = texts[k : k + 7]
        assert w.encode([t.encode() for t in part]) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]


def test_empty_tables(spark, table, vocabulary):
    assert T.token_counts(table([]), vocabulary).count() == 0 and P.pack(table([]), vocabulary).count() == 0
