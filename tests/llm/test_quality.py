import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lexflume.llm import license_scan as L
from lexflume.llm import mixing as M
from lexflume.llm import quality_classifier as Q
from lexflume.llm import quality_rules as R
from lexflume.llm.queries import ORACLE_SQL, QUERIES

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def test_base_counts_against_brute_force(spark, table, odd_texts):
    import re

    texts = [*odd_texts, "a b c a b c d", "x\ny\nx\n\n \nx", "# $ % & | < > * ##", "a b\x1fc d", "one two three"]
    got = {r["doc_id"]: r for r in R.quality_rules(table(texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = Counter(zip(words, words[1:], words[2:], strict=False))
        hit = {p for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and (not r["base_failed"] or not r["kept"])
    assert R.quality_rules(table([])).count() == 0


def test_distance_is_jensen_shannon(spark):
    df = spark.createDataFrame([([4, 0, 4], [1, 1, 2]), ([0, 0, 0], [1, 1, 1]), ([5, 5], [10, 10])], "p array<bigint>, q array<bigint>")
    got = [r[0] for r in df.select(R.distance("p", "q")).collect()]
    p, q = np.array([0.5, 0, 0.5]), np.array([0.25, 0.25, 0.5])
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m, strict=True) if x)
    assert got[0] == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2)) and got[1] is None and got[2] == pytest.approx(0)


def test_rules_keep_good_documents_and_find_bad_ones(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    r = R.quality_rules(d).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("not base_failed").toPandas()
    assert r[r.quality == 1].kept.mean() > 0.99 and r[r.quality == 0].kept.mean() < 0.3


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want, got = con.sql(ORACLE_SQL[name]), QUERIES[name](spark, SMALL)
    order = sorted(got.columns)
    assert order == sorted(want.columns)

    def cells(rows):
        return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)

    assert cells(got.select(order).collect()) == cells(want.select(*order).fetchall())


def test_votes_recover_accuracies():
    rng = np.random.default_rng(4)
    truth, right = rng.random(20000) < 0.8, [0.95, 0.9, 0.85, 0.8, 0.9]
    cast = np.stack([np.where(rng.random(20000) < 0.3, Q.ABSTAIN, np.where((rng.random(20000) < p) == truth, Q.GOOD, Q.BAD)) for p in right], 1)
    found, counts = np.unique(cast, axis=0, return_counts=True)
    model = Q.fit_labels(found, counts.astype(float))
    assert model.prior == pytest.approx(0.8, abs=0.03) and np.allclose(model.accuracies(), right, atol=0.03)


def test_classifier_on_held_out_labels(spark):
    train, test = (spark.read.parquet(f"/root/testdata/{s}/documents.parquet") for s in ("sf0.01", "sf0.1"))
    scored = Q.classify(test.select("doc_id", "text"), Q.fit(train)).join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").toPandas()
    assert scored[scored.quality == 1].kept.mean() > 0.985 and scored[scored.quality == 0].kept.mean() < 0.35


def test_sample_is_bounded_and_not_empty_at_any_size(spark):
    assert Q.cutoff(4 * 10**9, 3000) * 4 * 10**9 == pytest.approx(6000 * 2**63, rel=1e-6) and Q.cutoff(10**14, 3000) > 0
    assert Q.cutoff(10, 3000) == Q.cutoff(6000, 3000) == 2**63 - 1 and Q.cutoff(0, 3000) > 0
    many = spark.range(100_000).select("id", F.lit("t").alias("text"))
    assert Q.train_sample(many, key="id", train_rows=500).count() == 500
    same = spark.range(100_000).select(F.lit(None).cast("long").alias("id"), F.concat(F.lit("t"), (F.col("id") % 7).cast("string")).alias("text"))
    assert sorted(r["text"] for r in Q.train_sample(same, key="id", train_rows=500).collect()) == [f"t{i}" for i in range(7)]
    one = [r["text"] for r in Q.train_sample(many.withColumn("text", F.col("id").cast("string")).repartition(7), key="id", train_rows=50).collect()]
    assert one == [r["text"] for r in Q.train_sample(many.withColumn("text", F.col("id").cast("string")).repartition(2), key="id", train_rows=50).collect()]


def test_repetition_does_not_depend_on_length():
    words = [b"w%d" % i for i in range(200)]
    few, many = (Q.measures(b" ".join(words[:k] * n), words[:k] * n)[6] for k, n in ((20, 20), (20, 500)))
    assert few == many == 0.05 and Q.votes(Q.measures(b" ".join(words[:20] * 500), words[:20] * 500))[5] == Q.BAD
    assert Q.measures(b"", words * 50)[6] == 0.5


def test_one_sided_samples_score_their_mean():
    w, b = Q.fit_scorer(np.ones((4, 3), np.float32), np.array([0.9, 0.8, 0.9, 0.8], np.float32))
    assert not w.any() and 1 / (1 + math.exp(-b)) == pytest.approx(0.85)


def plain_classifier(rows):
    """The classifier done plainly: one document after the other, dense vectors, EM over documents."""
    import zlib

    def measured(t):
        words = t.split()
        n, lines = len(words), [x for x in t.split(b"\n") if x.split()]
        letters = sum(65 <= c <= 90 or 97 <= c <= 122 for c in t)
        fresh = sum(w not in words[k - k % 400 : k] for k, w in enumerate(words))
        div = lambda a, b: a / b if b else 0.0
        return n, div(sum(c in b"#*$%&|<>" for c in t), n), div(sum(65 <= c <= 90 for c in t), letters), div(sum(c in b".!?" for c in t), n), div(sum(w in Q.COMMON for w in words), n), div(len(lines) - len(set(lines)), len(lines)), div(fresh, n), div(len(t), n)

    def cast(m):
        n, symbols, upper, stops, common, again, fresh, size = m
        if n < 20:
            return (1,) * 7
        good = (symbols < 0.05, upper < 0.15, 0.01 < stops < 0.35, common > 0.15, again < 0.1, fresh > 0.45, 4 < size < 11)
        bad = (symbols > 0.2, upper > 0.4, stops > 0.7, common < 0.08, again > 0.3, fresh < 0.25, size > 30)
        return tuple(2 if g else 0 if b else 1 for g, b in zip(good, bad, strict=True))

    texts = [(t or "").encode() for t in rows]
    found = [measured(t) for t in texts]
    votes = [cast(m) for m in found]
    belief = [1 / (1 + math.exp(2 * v.count(0) - 3)) for v in votes]
    for _ in range(200):
        prior = min(max(sum(belief) / len(belief), 0.01), 0.99)
        rate = [[(1 + sum(w for v, w in zip(votes, side, strict=True) if v[k] == 2)) / (2 + sum(w for v, w in zip(votes, side, strict=True) if v[k] != 1)) for side in ([1 - b for b in belief], belief)] for k in range(7)]
        new = []
        for v in votes:
            odds = math.log(prior / (1 - prior))
            for k, x in enumerate(v):
                if x != 1:
                    p = [r if x == 2 else 1 - r for r in rate[k]]
                    odds += math.log(p[1] / p[0])
            new.append(1 / (1 + math.exp(-odds)))
        moved, belief = max(abs(a - b) for a, b in zip(new, belief, strict=True)), new
        if moved < 1e-6:
            break

    def signs(word):
        kind = ["A" if 65 <= c <= 90 else "a" if c >= 128 or 97 <= c <= 122 else "0" if 48 <= c <= 57 else chr(c) for c in word]
        return "".join(c for k, c in enumerate(kind) if not k or kind[k - 1] != c).encode("latin1")

    def dense(t, m):
        x = np.zeros(4096)
        for w in t.split():
            x[zlib.crc32(b"w" + w.lower()) % 4096] += 1 / m[0]
            x[zlib.crc32(b"s" + signs(w)) % 4096] += 1 / m[0]
        steps = [min(int(math.log2(m[0] + 1)), 20), *(min(int(v * 20), 40) for v in m[1:7]), min(int(m[7]), 40)]
        for k, s in enumerate(steps):
            x[zlib.crc32(f"m{k}:{s}".encode()) % 4096] += 0.25
        return x

    x, y = np.array([dense(t, m) for t, m in zip(texts, found, strict=True)]), np.array(belief)
    weight = y / y.sum() + (1 - y) / (1 - y).sum()
    weight /= weight.sum()
    w, b, first, second = np.zeros(4096), 0.0, np.zeros(4097), np.zeros(4097)
    for t in range(1, 301):
        e = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
        g = np.append(x.T @ e + 1e-5 * w, e.sum())
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g**2
        step = 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return belief, list(1 / (1 + np.exp(-(x @ w + b))))


def test_classifier_against_a_plain_one(spark, odd_texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").dropDuplicates(["text"]).orderBy("doc_id").limit(120).collect()
    texts = dict(enumerate(dict.fromkeys([*(r["text"] for r in docs), *odd_texts])))
    belief, score = plain_classifier(list(texts.values()))
    got = {r["doc_id"]: r for r in Q.quality_classifier(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)).collect()}
    assert all(abs(got[i]["posterior"] - belief[i]) < 1e-4 and abs(got[i]["score"] - score[i]) < 0.02 for i in texts)
    assert all(got[i]["kept"] == (score[i] >= 0.25) for i in texts if abs(score[i] - 0.25) > 0.03) and 0 < sum(r["kept"] for r in got.values()) < len(texts)


def test_classifier_takes_odd_rows(spark, table, odd_texts):
    out = Q.quality_classifier(table(odd_texts))
    rows = out.collect()
    assert len(rows) == len(odd_texts) and all(0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 for r in rows) and {r["copy"] for r in rows} == {"x"}
    same = defaultdict(set)
    for r in rows:
        same[r["text"] or ""].add((r["score"], r["kept"]))
    assert all(len(v) == 1 for v in same.values())
    assert Q.quality_classifier(table([])).count() == 0


def test_mixing_draws_poisson_counts(spark, table):
    d = table([f"t{i}" for i in range(6000)], ["hot" if i % 3 else (None if i % 2 else "b") for i in range(6000)])
    out = M.mix(d, weights={"hot": 1.0, "b": 1.0}, total=4000)
    rows = out.select("doc_id", "source", "copy", "shuffle_key").collect()
    by = Counter(r["source"] for r in rows)
    assert None not in by and abs(by["hot"] - 2000) < 200 and abs(by["b"] - 2000) < 200
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows) == len({r["shuffle_key"] for r in rows})
    counts = Counter(r["doc_id"] for r in rows if r["source"] == "b")
    share = [sum(v == k for v in counts.values()) / 1000 for k in (1, 2, 3)]
    assert np.allclose(share, [math.exp(-2) * 2**k / math.factorial(k) for k in (1, 2, 3)], atol=0.04)
    again = M.mix(d.repartition(7), weights={"hot": 1.0, "b": 1.0}, total=4000).select("doc_id", "copy").collect()
    assert sorted(map(tuple, again)) == sorted((r["doc_id"], r["copy"]) for r in rows)


def test_mixing_without_a_broadcast_is_the_same(spark, table, monkeypatch):
    d = table([str(i) for i in range(300)], ["hot" if i % 3 else f"s{i}" for i in range(300)])
    rows = lambda: sorted(map(tuple, M.mix(d).select("doc_id", "copy", "shuffle_key").collect()))
    broadcast = rows()
    monkeypatch.setattr(M, "BROADCAST_TERMS", 0)
    assert broadcast and rows() == broadcast


def test_mixing_of_nulls_extremes_and_nothing(spark, table):
    d = table([None, "", "a"], [None, "x", "x"])
    assert M.mix(d).columns == [*[c for c in d.columns if c != "copy"], "copy", "shuffle_key"]
    many = M.mix(table(["t"], ["s"]), total=3000).count()
    assert abs(many - 3000) < 300
    assert M.mix(table([])).count() == 0 and M.mix(d, weights={"nobody": 1.0}).count() == 0
    keys = [r["shuffle_key"] for r in M.mix(table([str(i) for i in range(50)])).coalesce(1).select("shuffle_key").collect()]
    assert len(keys) > 20 and keys != sorted(keys, reverse=True)


def test_licences_by_canonical_text(spark, table):
    mit = next(t for k, t in L.KNOWN if k == "MIT")
    texts = ["MIT License\n\nCopyright (c) 2020 A. N. Other\n\n" + mit.upper().replace(" ", "  "), mit.replace("sublicense", "sub-licence").replace(",", " ;"), mit + " And more.", None, "", "Intro.\nReleased under the MIT Licence\nLicensed under CC BY-NC 4.0!\nReleased under the MIT License.", "released under the MIT license"]
    got = {r["doc_id"]: (r["license_id"], r["notice_ids"], r["n_notice_lines"]) for r in L.license_scan(table(texts)).collect()}
    assert got[0][0] == "MIT" and got[1][0] == "MIT" and got[2] == (None, None, 0) and got[3] == got[4] == (None, None, 0)
    assert got[5] == (None, "CC-BY-NC-4.0,MIT", 3) and got[6] == ("MIT", "MIT", 1)
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["digest"] for r in L.license_scan(table([None, "", "...", "Copyright (c) 2024 X"])).collect()} == {empty}
    assert L.license_scan(table([])).count() == 0


def test_licences_of_repeated_rows_and_null_keys(spark):
    note = "Released under the MIT License."
    df = spark.createDataFrame([(1, note + "\nx", "a"), (1, note + "\nx", "b"), (None, note + "\nx", "c"), (None, "x", "d"), (None, None, "e")], "doc_id long, text string, digest string")
    got = [(r["doc_id"], r["notice_ids"], r["n_notice_lines"]) for r in L.license_scan(df).collect()]
    assert sorted(got, key=repr) == sorted([(1, "MIT", 1), (1, "MIT", 1), (None, "MIT", 1), (None, None, 0), (None, None, 0)], key=repr)
    assert {r["license_id"] for r in L.license_scan(df, known=[]).collect()} == {None}


def test_mixing_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(i, None, "s", i, "u", 1, "old") for i in range(40)], "doc_id long, text string, source string, cdf int, u string, _source int, copy string").withColumns({"_u": F.lit(1), "_count": F.lit(2), "n": F.lit(3), "row": F.lit("r"), "a.b": F.lit(4)})
    rows = M.mix(df, total=200).collect()
    assert abs(len(rows) - 200) < 80 and all(r["cdf"] == r["doc_id"] and (r["u"], r["_source"], r["n"], r["row"], r["a.b"]) == ("u", 1, 3, "r", 4) for r in rows) and {r["copy"] for r in rows} >= {0, 1, 2}


def test_entire_licences(spark, table):
    whole = {k: open(f"/usr/share/common-licenses/{f}").read() for k, f in {"Apache-2.0": "Apache-2.0", "GPL-2.0-only": "GPL-2", "GPL-3.0-only": "GPL-3", "LGPL-2.1-only": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}.items()}
    texts = [*whole.values(), whole["Apache-2.0"].partition("END OF TERMS")[0].upper(), whole["MPL-2.0"] + " And more.", whole["MPL-2.0"][:-400]]
    got = {r["doc_id"]: r["license_id"] for r in L.license_scan(table(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [*whole, "Apache-2.0", None, None]
    assert {k for k, _ in L.entire_texts()} == set(L.TEXTS)


def test_wrapped_copyright_words_stay(spark):
    df = spark.createDataFrame([("AUTHORS OR\nCOPYRIGHT HOLDERS BE LIABLE",)], "t string")
    assert df.select(L.canonical(F.col("t"))).first()[0] == "authors or copyright holders be liable"
