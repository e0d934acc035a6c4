import hashlib
import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexflume.llm import _common as C
from lexflume.llm import exact_dedup as X
from lexflume.llm import jaccard_join as J
from lexflume.llm import span_dedup as S
from lexflume.llm import suffix_dedup as U
from lexflume.llm.suffix_order import suffix_order

from .conftest import brute_components


def test_exact_groups(spark, table, odd_texts):
    texts = [*odd_texts, "x" * 3000 + "a", "x" * 3000 + "b", "x" * 3000 + " a", "x" * 128, "x" * 128 + " "]
    bare = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in texts]
    got = {r["doc_id"]: r for r in X.exact_dedup(table(texts)).collect()}
    for i, b in enumerate(bare):
        group = [k for k, x in enumerate(bare) if x == b]
        best = min(group, key=lambda k: (-len(texts[k] or ""), k))
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"], got[i]["text_sha256"]) == (best, len(group), i == best, hashlib.sha256(b.encode()).hexdigest())
    kept = X.drop_exact_copies(table(texts))
    assert kept.columns == table([]).columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({got[i]["keep_id"] for i in got})


def test_exact_repeated_rows_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "b")], "doc_id long, text string")
    rows = X.exact_dedup(df).collect()
    assert sum(r["kept"] for r in rows) == 2 and {r["keep_id"] for r in rows if r["group_size"] == 3} == {1}
    assert X.drop_exact_copies(df).count() == 2 and X.exact_dedup(df.limit(0)).count() == 0


def near_texts(seed=3, n=160):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    bases, out = [[word() for _ in range(rng.randint(3, 60))] for _ in range(12)], []
    for _ in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = word()
        out.append(" ".join(w).upper() if rng.random() < 0.2 else "  ".join(w))
    return out


@pytest.mark.parametrize("switches", [{"FEW": 4}, {"FEW": 2, "NEIGHBOURS": 1, "HUBS": 1, "ROUNDS": (1,), "CELL_BITS": (12, 12), "BUCKET_ROWS": 50}])
def test_components_of_near_copies(spark, table, odd_texts, monkeypatch, switches):
    for name, value in switches.items():  # so that shingles are crowded here; then hardly anything meets or merges early
        monkeypatch.setattr(J, name, value)
    texts = [*near_texts(), *odd_texts]
    sizes, roots = brute_components(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.similar_documents(table(texts)).collect()}
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}
    left = J.drop_similar(table(texts))
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(roots)) and set(left.columns) == set(table([]).columns)


def test_limits_reach_the_tasks(spark, table, monkeypatch):
    docs = table(near_texts()).select(F.col("doc_id").alias("_key"), F.col("text").alias("_text"))
    shared = spark.sparkContext.broadcast(J.shingle_cells(docs))
    plain = J.meetings(docs, shared, 16).where("hot").count()
    monkeypatch.setattr(J, "FEW", 2)
    assert J.meetings(docs, shared, 16).where("hot").count() > plain


def test_components_without_keys_or_rows(spark, table):
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (5, "A B c d e f")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in J.similar_documents(df).collect()) == [(0, 0), (3, 3), (3, 3), (5, 3)]
    assert J.similar_documents(table([])).count() == 0


@pytest.mark.parametrize("n", range(7))
def test_few_words_alone_in_a_slab(n):
    from lexflume.llm import shingles as H

    assert [len(s) for s in H.all_sets(iter([b"a b c d e f"[: max(2 * n - 1, 0)]]))] == [min(n, 1) if n < 6 else 2]


def test_texts_under_one_id_all_link(spark):
    words = lambda tag, n: [f"{tag}{i}" for i in range(n)]
    short, long = words("s", 60), words("l", 300)
    df = spark.createDataFrame([(1, " ".join(short)), (1, " ".join(long)), (2, " ".join([*short, "x"])), (3, " ".join([*long, "x"]))], "doc_id long, text string")
    assert {r["component_id"] for r in J.similar_documents(df).collect()} == {1}


def test_sketch_grows_with_the_corpus():
    assert [J.cell_bits(n) for n in (0, 1, 1 << 26, 1 << 28, 1 << 40)] == [20, 20, 20, 22, 24]
    x = np.array([0, 1 << 63, (1 << 64) - 1], np.uint64)
    for bits in (20, 24):
        cells = np.zeros(1 << bits, np.uint8)
        cells[[1 << (bits - 1), -1]] = 1, 2
        assert J.cell_of(x, cells).tolist() == [0, 1, 2]


def test_bitmap_never_drops_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, len(a) // 10, dtype=np.uint64)]))
        i = len(np.intersect1d(a, b))
        if len(b) and 100 * i >= 75 * (len(a) + len(b) - i):
            assert J.may_link(J.bitmap(a), J.bitmap(b), len(a), len(b))


@pytest.mark.parametrize("local", [10**6, 40, 5])
def test_connected_components(spark, monkeypatch, local):
    monkeypatch.setattr(C, "LOCAL_EDGES", local)
    rng = random.Random(local)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(900 + i, 901 + i) for i in range(40)]
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            top[max(x, y)] = min(x, y)
    assert dict(C.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()) == {x: root(x) for x in list(top)}


def brute_sentences(text, longest=16):
    """[(start, words)] by the words of the docstrings, one word after the other."""
    found = [(m.start(), m.group(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    whole = [[]]
    for k, (at, w, end) in enumerate(found):
        whole[-1].append((at, bytes(c + 32 if 65 <= c <= 90 else c for c in w)))
        gap = text[end : found[k + 1][0]] if k + 1 < len(found) else b"\n"
        if w[-1:] in (b".", b"!", b"?") or b"\n" in gap:
            whole.append([])
    out = []
    for words in whole:
        part = []
        for at, w in words:
            part.append((at, w))
            if len(part) == longest or (len(words) > longest and sum(w) % 6 == 0):
                out.append(part)
                part = []
        out.append(part)
    return [(p[0][0], [w for _, w in p]) for p in out if p]


def brute_spans(rows):
    """rows of (key, tag, text) -> {(key, tag): (text left, sentences, gone, characters gone)}; the plain way, on tuples of words."""
    seen, out = set(), {}
    for key, tag, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        body = (text or "").encode()
        found, away = brute_sentences(body), set()
        for i in range(len(found)):
            for j in range(i + 3, len(found) + 1):
                span = tuple(w for _, words in found[i:j] for w in words)
                if len(span) >= 15:
                    if span in seen:
                        away |= set(range(i, j))
                    seen.add(span)
                    break
        edge = [at for at, _ in found] + [len(body)]
        cut = b"".join(body[edge[i] : edge[i + 1]] for i in sorted(away))
        left = body[: edge[0]] + b"".join(body[edge[i] : edge[i + 1]] for i in range(len(found)) if i not in away)
        out[key, tag] = (None if text is None else left.decode(), len(found), len(away), len(cut.decode()))
    return out


def check_spans(df):
    tagged = df.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    rows = [tuple(r) for r in tagged.collect()]
    want = brute_spans(rows)
    got = S.span_dedup(tagged.repartition(5)).collect()
    assert sorted(map(repr, (want[k, t] for k, t, _ in rows))) == sorted(map(repr, ((r["text"], r["n_sentences"], r["n_removed"], r["n_removed_chars"]) for r in got)))
    assert all((r["text"], r["n_sentences"], r["n_removed"], r["n_removed_chars"]) == want[r["doc_id"], r["tag"]] for r in got)
    return got


@pytest.mark.parametrize("flush", [500_000, 50])
def test_spans_against_brute_force(spark, table, odd_texts, monkeypatch, flush):
    rng = random.Random(11)
    lines = [" ".join(rng.choice("alpha beta Gamma delta epsilon zeta eta".split()) for _ in range(rng.randint(2, 30))) + rng.choice([".", "!", "\n", "?"]) for _ in range(60)]
    passage = " ".join(f"word{i}" + ("." if i % 9 == 8 else "") for i in range(60))
    texts = [" ".join(rng.choice(lines) for _ in range(rng.randint(0, 12))) for _ in range(60)] + odd_texts + [f"Own start {k}.\n{passage}\nOwn end {k}." for k in range(3)] + [" \n\n" + lines[0] * 3, "same " * 90]
    monkeypatch.setattr(S, "FLUSH_SPANS", flush)
    got = {r["doc_id"]: r["text"] for r in check_spans(table(texts))}
    k = len(texts) - 5
    assert "word30" in got[k] and "word30" not in got[k + 2] and "Own start 2." in got[k + 2]
    assert S.span_dedup(table([])).count() == 0


def test_rows_that_share_a_key_are_cut_apart(spark):
    say = lambda tag: " ".join(f"{tag}{i}" + "." * (i % 7 == 6) for i in range(42))
    rows = [(1, say("p")), (2, say("p")), (2, say("o")), (None, say("q")), (None, say("r")), (3, say("q") + " " + say("r")), (4, say("s")), (4, say("s")), (5, None), (5, say("s"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["text"] for r in check_spans(df)}
    assert {say("o"), say("p"), say("q"), say("r"), say("s")} <= left and "" in left


def test_span_columns_may_have_any_name(spark):
    say = " ".join(f"w{i}" + "." * (i % 7 == 6) for i in range(42))
    df = spark.createDataFrame([(1, say, 1, 2, "c"), (2, say, 3, 4, None)], "doc_id long, text string, `row` int, cuts int, `of.key` string").withColumns({"key": F.lit("k"), "tag": F.lit(None).cast("string"), "n_removed": F.lit("old"), "_cut": F.lit(1), "_of": F.lit(1)})
    got = {r["doc_id"]: r for r in S.span_dedup(df).collect()}
    assert got[2]["text"] == "" and got[2]["row"] == 3 and got[2]["of.key"] is None and got[1]["n_removed"] == 0 and got[1]["key"] == "k"
    assert {r["doc_id"]: r["n_removed"] for r in S.span_dedup(spark.createDataFrame([("b", say), ("a", say), ("B", say)], "doc_id string, text string")).collect()} == {"B": 0, "a": 6, "b": 6}


@pytest.mark.parametrize("stops", [0, 5, 12, 40])
def test_passages_go_at_any_offset(spark, table, stops):
    rng = random.Random(stops)
    prose = lambda n, tag: " ".join(f"{tag}{rng.randrange(10**6)}" + ("." if stops and rng.random() < 1 / stops else "") for _ in range(n))
    passages = [prose(n, f"p{k}x") for k, n in enumerate([50, 55, 60, 70, 90, 120, 200] * 4)]
    texts = [f"{prose(rng.randint(0, 40), 'a')} {p} {prose(rng.randint(0, 40), 'b')}" for p in passages for _ in range(3)]
    got = {r["doc_id"]: r["text"] for r in S.span_dedup(table(texts).repartition(3)).collect()}
    shares = []
    for k, t in enumerate(texts):
        left, own = set(got[k].split()), passages[k // 3].split()
        assert all(w in left for w in t.split() if w not in own) and (k % 3 or got[k] == t)
        shares += [sum(w not in left for w in own) / len(own)] * (k % 3 > 0)
    assert min(shares) >= 0.2 and sum(x >= 0.5 for x in shares) >= 0.95 * len(shares) and sum(shares) / len(shares) > 0.75


def test_suffix_order_is_sorted_order():
    rng = random.Random(2)
    for _ in range(60):
        lanes = []
        for _ in range(rng.randint(1, 10)):
            t = [rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 50))]
            lanes.append((t if rng.random() < 0.7 else (t[:4] * 20)[:60]) + [0])
        size = np.array([len(t) for t in lanes])
        base = np.concatenate([[0], np.cumsum(size)[:-1]])
        got = suffix_order(np.array([x for t in lanes for x in t]), base, size)
        for t, b in zip(lanes, base, strict=True):
            assert [g - b for g in got[b : b + len(t)]] == sorted(range(len(t)), key=lambda i: t[i:])


def brute_cut(rows):
    """rows of (key, text) -> their results; a null key is larger than all others."""
    order, least, out = [k if k is not None else 1 << 63 for k, _ in rows], {}, []
    for k, (_, t) in zip(order, rows, strict=True):
        body = (t or "").encode()
        for i in range(len(body) - 49):
            s = body[i : i + 50]
            least[s] = min(least.get(s, k), k)
    for k, (_, t) in zip(order, rows, strict=True):
        body = (t or "").encode()
        away = np.zeros(len(body), bool)
        for i in range(len(body) - 49):
            if least[body[i : i + 50]] < k:
                away[i : i + 50] = True
        left = np.frombuffer(body, np.uint8)[~away].tobytes()
        spans = int(away[:1].sum()) + int((away[1:] & ~away[:-1]).sum())
        out.append((len(body), int(away.sum()), spans, hashlib.sha256(left).hexdigest(), left))
    return out


def check_cuts(df, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept_text"])) for r in U.suffix_dedup(df.repartition(5), **options).collect()]
    want = [(k, *x) for (k, _), x in zip(rows, brute_cut(rows), strict=True)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def passages(rng, n=150):
    bases = ["".join(rng.choice("ab cé") for _ in range(rng.randint(30, 300))) for _ in range(15)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            b = rng.choice(bases)
            i = rng.randrange(len(b))
            parts.append(b[i : i + rng.randint(0, 110)])
        out.append("".join([*parts, "xyz " * rng.choice([0, 0, 20]), "-" * rng.choice([0, 0, 49, 50, 51, 120]), "".join(rng.choice("qrstu") for _ in range(20))]))
    return out


@pytest.mark.parametrize(("crowded", "flush"), [(48, 500_000), (2, 500_000), (2, 60), (0, 60)])
def test_suffix_dedup_against_brute_force(spark, table, odd_texts, monkeypatch, crowded, flush):
    monkeypatch.setattr(U, "FLUSH_ROWS", flush)
    check_cuts(table([*odd_texts, *passages(random.Random(5))]), crowded=crowded)


def test_suffix_dedup_of_shared_and_null_keys(spark):
    rng = random.Random(6)
    keys = [rng.choice([None, None, 1, 2, 3, 3, 9, -4]) for _ in range(120)]
    rows = list(zip(keys, passages(rng, 120), strict=True))
    check_cuts(spark.createDataFrame([*rows, *rows[:9], (None, None), (3, None), (3, "")], "doc_id long, text string"))


def test_suffix_dedup_of_null_keys_repeats_and_nothing(spark, table):
    long = "abcdefghij" * 7
    df = spark.createDataFrame([(None, long), (4, long), (4, long), (2, None)], "doc_id int, text string")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in U.suffix_dedup(df).collect())
    assert got == [(0, 70), (2, 0), (4, 0), (4, 0)]
    assert U.suffix_dedup(table([])).count() == 0 and dict(U.suffix_dedup(df).dtypes)["doc_id"] == "int"


def test_texts_of_one_run_are_few_entries(spark, table):
    for unit in (b"-", b"ab", b"<td></td>", b"one two three "):
        e, n = U.stretches([unit * (200_000 // len(unit))])
        assert n[0] < 70 and sum(e["rep"].astype(int) * (e["more"] + 1)) == len(unit) * (200_000 // len(unit)) - 49
    check_cuts(table(["-" * 3000, "x" + "-" * 70, "ab" * 500, "b" * 20 + "ab" * 40 + "c", "ab" * 24 + "a", "one two three " * 30 + "-" * 55, "two three " + "one two three " * 9]))


def test_entries_survive_packing():
    e = np.zeros(100, U.ENTRY)
    rng = np.random.default_rng(3)
    for name, top in (("h", 1 << 63), ("s", 1 << 63), ("doc", 9), ("tag", 1 << 62), ("lo", 1 << 31), ("rep", 1 << 31), ("more", 31), ("step", 31), ("left", 255), ("right", 255)):
        e[name] = rng.integers(0, top, 100)
    e["doc"] -= 5
    got = U.unpacked(U.packed(e))
    assert (np.sort(got, order=list(U.ENTRY.names)) == np.sort(e, order=list(U.ENTRY.names))).all()


def peak_bytes(run):
    """Memory that Python and NumPy take at once while run's results pass by."""
    tracemalloc.start()
    for _ in run():
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_memory_of_stretches_is_bounded():
    """Of many short texts as of a very long one."""
    rng = np.random.default_rng(4)
    scan = U._scan(SimpleNamespace(mapInArrow=lambda run, schema: run), 16, U.CROWDED)
    for size, n in ((2000, 1000), (3_000_000, 1)):
        texts = [rng.integers(32, 127, size, dtype=np.uint8).tobytes().decode() for _ in range(n)]
        batch = pa.record_batch([np.arange(n), np.arange(n), pa.array(texts)], names=["_key", "_tag", "_text"])
        assert peak_bytes(lambda batch=batch: scan(iter([batch]))) < 48 << 20


def test_memory_of_packing_is_bounded():
    e = np.zeros(400_000, U.ENTRY)
    e["h"], e["s"] = np.random.default_rng(5).integers(0, 1 << 63, (2, len(e)))
    assert peak_bytes(lambda: U.combined(e, 100, U.CROWDED)) < 3 * e.nbytes
    got = [U.unpacked(x.as_py()) for b in U.combined(e, 100, U.CROWDED) for x in b.column("entries")]
    assert len(got) == 100 and (np.sort(np.concatenate(got)["h"]) == np.sort(e["h"])).all() and all(len(np.unique(x["h"] % np.uint64(100))) == 1 for x in got)


def test_cuts_of_small_tables_take_one_worker_a_task(spark, table):
    """A broadcast join would chain two Python steps, and the second worker of each core would keep its memory."""
    plan = U.suffix_dedup(table(["a" * 60, "a" * 70]))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_cuts_across_parts(spark, table):
    rng = random.Random(11)
    some = ["".join(rng.choice("abcdef ") for _ in range(n)) for n in (U.PART + 90, 300, 20_000, U.PART - 60, 5000)]
    check_cuts(table([some[2] + some[0], "-" + some[3] + some[1] + some[4], some[3][99:] + some[4] + some[0], some[0][-400:]]))


def test_results_do_not_depend_on_partitions(spark, table):
    texts = near_texts(9, 60)
    one = {r["doc_id"]: r["component_id"] for r in J.similar_documents(table(texts).coalesce(1)).collect()}
    assert one == {r["doc_id"]: r["component_id"] for r in J.similar_documents(table(texts).repartition(6, F.col("doc_id"))).collect()}


def test_long_texts_in_parts_are_the_same(spark, table, monkeypatch):
    from lexflume.llm import shingles as H

    rng = random.Random(8)
    text = " ".join("".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 9, 400]))) for _ in range(300)).encode()
    whole = next(H.all_sets(iter([text])))
    monkeypatch.setattr(H, "SLAB", 64)
    assert (next(H.all_sets(iter([text]))) == whole).all() and b"".join(H.pieces(text)) == text
    places: list = []
    monkeypatch.setattr(U, "PART", 100)
    cut = list(U._parts(0, text, places))
    assert sum(max(len(x) - U.LENGTH + 1, 0) for x in cut) == len(text) - U.LENGTH + 1
    assert all(text[s : s + len(x)] == x for (_, s), x in zip(places, cut, strict=True))
