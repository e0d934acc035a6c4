"""The pipeline against what its stages say, done plainly."""

import re
from collections import Counter

from public_tokenizers import path
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from lexflume.llm._common import frozen
from lexflume.llm.mixing import TEMPERATURE

from .conftest import brute_components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram jaccard join", "mixing sources", "best-fit packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = frozen(stage(spark, docs, SF))
        after[name] = docs.collect()
        if name != "best-fit packing":
            assert docs.columns == columns
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    kept = {r["doc_id"]: r["text"] for r in after["quality classifier"]}
    assert len(good - set(kept)) <= 0.03 * len(good)
    best = {}
    for k, t in sorted(kept.items()):
        bare = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        if bare not in best or len(t or "") > len(kept[best[bare]] or ""):
            best[bare] = k
    assert sorted(r["doc_id"] for r in after["exact dedup"]) == sorted(best.values())
    rows = sorted((r["doc_id"], r["text"]) for r in after["exact dedup"])
    _, roots = brute_components([t for _, t in rows])
    assert sorted(r["doc_id"] for r in after["n-gram jaccard join"]) == sorted({rows[k][0] for k in roots})
    sources = Counter(r["source"] for r in after["n-gram jaccard join"])
    total, weight = sum(sources.values()), sum(n**TEMPERATURE for n in sources.values())
    assert abs(len(after["mixing sources"]) - total) < 5 * total**0.5
    assert {r["doc_id"] for r in after["mixing sources"]} <= {rows[k][0] for k in roots} and weight > 0
    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = sum(len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in after["mixing sources"])
    assert sum(r["length"] for r in after["best-fit packing"]) == want


def test_run_and_registration(spark):
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 11)} == {re.match(r"op\d+_", n)[0] for n in names if n.startswith("op")}
    assert names["pipeline"](spark, SF).count() > 0


ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, copy string, kept int, `row` string, key string, `id` string, cdf string"


def test_stages_take_odd_rows_and_clashing_columns(spark):
    say = lambda tag, n=60: " ".join(f"{tag}{i}" for i in range(n))
    texts = [(1, None), (2, ""), (3, "  "), (4, say("a")), (4, say("a")), (4, say("b")), (None, say("a")), (None, say("c")), (5, say("a") + " more"), (6, say("long", 40000)), (7, say("A").upper()), (8, say("d") + " " + say("d"))]
    rows = [(k, t, "en", None if i % 3 else "s", None, f"s{i}", f"c{i}", i, f"r{i}", f"k{i}", f"i{i}", "f") for i, (k, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, ODD)
    by = {r[5]: r for r in rows}
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, df, SF)
        assert got.columns == df.columns, name
        out = [tuple(r) for r in got.collect()]
        assert all(by[r[5]] == r for r in out), name
        assert name == "mixing sources" or len({r[5] for r in out}) == len(out)
        kept = sorted(r[5] for r in out)
        if name == "exact dedup":
            assert sorted((r[0] or 0, (r[1] or "").strip()[:3]) for r in out) == [(0, "c0 "), (3, ""), (4, "a0 "), (4, "b0 "), (5, "a0 "), (6, "lon"), (7, "A0 "), (8, "d0 ")], kept
        if name == "n-gram jaccard join":
            assert kept == sorted(["s0", "s1", "s2", "s3", "s4", "s5", "s6", "s7", "s9", "s11"])
        assert stage(spark, df.limit(0), SF).count() == 0
    packed = corpus_pipeline.STAGES[4][1](spark, df, SF).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(k for k, _ in texts)
    assert corpus_pipeline.STAGES[4][1](spark, df.limit(0), SF).count() == 0
