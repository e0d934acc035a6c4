import numpy as np
import pytest
from pyspark.sql import functions as F

from lexflume.operators import audit as A
from lexflume.operators import embed as E
from lexflume.operators import ingest as I
from lexflume.operators import preprocess as P
from lexflume.operators import reduce as D
from lexflume.operators import sampling as S
from lexflume.operators import tfidf as M
from lexflume.operators import validate as V

SF = "/root/testdata/sf0.001"


def reps(spark):
    rows = [(30, "a quiet day", "quiet"), (31, "two words", None), (32, "   ", "x"), (35, "rates again", "rate again")]
    return spark.createDataFrame(rows, "source_row_id long, a string, b string")


def test_registered_vectors_have_the_whole_vocabulary(spark):
    from lexflume.plans.catalog import QUERIES

    sizes = {int(r["features"].strip("(").partition(",")[0]) for r in QUERIES["tfidf_roundtrip"](spark, "/root/testdata/sf0.001").collect()}
    terms = QUERIES["tfidf_combined_6000"](spark, "/root/testdata/sf0.001").select("term").distinct().toPandas()["term"]
    assert sizes == {6000} and terms.str.startswith("word__").sum() > 300 and terms.str.startswith("char__").sum() > 300


def test_contract_passes_and_blocks(spark):
    good = V.input_contract(reps(spark), id_column="source_row_id", representations=["a", "b"])
    assert not V.blocks(V.report(spark, good))
    bad = V.report(spark, V.input_contract(reps(spark).drop("a", "b"), id_column="source_row_id", representations=["a"]))
    assert V.blocks(bad) and bad.where("check_name = 'at_least_one_representation'").first()["severity"] == "critical"
    warned = V.report(spark, V.input_contract(reps(spark), id_column="source_row_id", representations=["a", "zz"]))
    assert not V.blocks(warned) and warned.where("status = 'fail'").first()["severity"] == "warning"
    assert V.blocks(V.report(spark, V.input_contract(reps(spark), id_column="nope", representations=["a"])))


def test_feature_output_finds_nan_and_lost_rows(spark):
    src = reps(spark)
    nan = src.select("source_row_id", F.lit(float("nan")).alias("x"))
    failed = {r["check_name"] for r in V.report(spark, V.feature_output(nan, src, id_column="source_row_id")).where("status = 'fail'").collect()}
    assert failed == {"nan_count"}
    failed = {r["check_name"] for r in V.report(spark, V.feature_output(src.limit(3).select("source_row_id", "a"), src, id_column="source_row_id")).where("status = 'fail'").collect()}
    assert {"row_count_match", "id_keys_match", "all_numeric"} <= failed


def test_row_ids_are_contiguous(spark):
    df = spark.range(0, 100).select((F.col("id") * 7 % 101).alias("k"))
    out = P.assign_row_id(df, ["k"])
    assert [r["source_row_id"] for r in out.orderBy("k").collect()] == list(range(100))
    assert sorted(r["source_row_id"] for r in P.assign_row_id(df).collect()) == list(range(100))


def test_label_mentions(spark):
    labels = ["Bitcoin, Ethereum", "Bitcoin Cash", "[BTC]", "'bitcoin' | x", None, "eth & btc", "AT&T"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(P.label_mentions(F.col("c"), "bitcoin|btc")).collect()]
    assert got == [True, False, True, True, False, True, False]


def test_best_row_wins_and_rows_without_keys_stay(spark):
    rows = [(1, "u", "t", "d", "x"), (2, "u", "t", "d", "xx"), (3, "", "t", "d", "x"), (4, "", "t", "d", "x"), (5, "", "", "", "x"), (6, "", "", "", "x")]
    df = spark.createDataFrame(rows, "source_row_id long, u string, t string, d string, x string")
    out = P.dedup_articles(df, url_key="u", title_key="t", description_key="d", texts=["x"])
    assert sorted(r["source_row_id"] for r in out.collect()) == [2, 3, 5, 6]


def test_merge_order_and_null_keys(spark):
    cols = "ingest_seq long, release_number string, canonical_url string, content_hash string"
    old = spark.createDataFrame([(1, "a", "u1", "h1"), (2, None, "u2", "h2")], cols)
    new = spark.createDataFrame([(3, "a", "u3", "h3"), (4, None, "u4", "h3")], cols)
    assert [r["ingest_seq"] for r in I.merge_incremental(old, new).collect()] == [4]


def test_frame_assertions_raise(spark):
    with pytest.raises(ValueError, match="missing output columns"):
        I.assert_frame(spark.range(1))


def test_samples_are_the_same_on_any_partitioning(spark):
    df = spark.range(200).select(F.col("id"), F.when(F.col("id") % 50 == 0, "").otherwise("t").alias("t"))
    ids = lambda d: [r["id"] for r in d.collect()]
    for f in (lambda d: S.priority_sample(d, 20, "id"), lambda d: S.smoke_sample(d, 20, "id", ["t"]), lambda d: S.smoke_sample_capped(d, 20, "id", ["t"], 2)):
        assert ids(f(df.repartition(1))) == ids(f(df.repartition(7))) and len(ids(f(df))) == 20
    assert {0, 50, 100, 150} <= set(ids(S.smoke_sample(df, 20, "id", ["t"])))
    assert ids(S.smoke_sample(df, 3, "id", ["t"])) == [0, 50, 100]


def test_tfidf_fit_and_transform_are_apart(spark):
    train = spark.createDataFrame([(1, "red fish"), (2, "red boat"), (3, "")], "i long, t string")
    r = M.Recipe(min_df=1, max_df=1.0, max_features=10)
    model = M.fit(train, "i", "t", r)
    out = {(x["i"], x["term"]): x["weight"] for x in M.transform(spark.createDataFrame([(9, "red new")], "i long, t string"), model, "i", "t", r).collect()}
    assert out == {(9, "red"): 1.0}
    w = M.transform(train, model, "i", "t", r)
    assert M.report(train, w, "i", 10).first()["zero_vectors"] == 1
    norms = w.groupBy("i").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(x["n"] - 1) < 1e-9 for x in norms)
    vectors = M.hstacked(M.vectors(train, w, "i", 10), ["features"], "all").collect()
    assert len(vectors) == 3 and vectors[0]["all"].size == 10


def test_char_terms_of_short_words(spark):
    got = {r["term"]: r["tf"] for r in M.terms(spark.createDataFrame([(1, "ab a")], "i long, t string"), "i", "t", M.CHAR_RECIPE).collect()}
    assert got == {" ab": 1, "ab ": 1, " ab ": 1, " a ": 1}


@pytest.mark.parametrize("bad", [{"low": 2, "high": 1}, {"min_df": 0}, {"max_df": 1.5}, {"analyzer": "x"}])
def test_recipes_are_checked(bad):
    with pytest.raises(ValueError):
        M.Recipe(**bad)


def test_pca_equals_numpy(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    model, centre, k = D.pca(df, "vec_id", "embedding", 8)
    x = np.array([r["embedding"] for r in df.orderBy("vec_id").collect()], float)
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(model.explainedVariance.toArray(), (s**2 / (s**2).sum())[:k], atol=1e-9)
    got = np.array([r["reduced"] for r in D.pca_transform(df, model, centre, "vec_id", "embedding").orderBy("vec_id").collect()])
    assert np.allclose(np.abs(got), np.abs((u * s)[:, :k]), atol=1e-8)
    with pytest.raises(ValueError):
        D.components(4, 1, 5)


def test_svd_equals_numpy(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(1)
    x = rng.random((25, 12)) * (rng.random((25, 12)) < 0.3)
    df = spark.createDataFrame([(i, Vectors.dense(r).toSparse()) if hasattr(Vectors.dense(r), "toSparse") else (i, Vectors.sparse(12, {j: float(v) for j, v in enumerate(r) if v})) for i, r in enumerate(x)], ["i", "features"])
    s = [r["singular_value"] for r in D.svd(df, "i", "features", 4).orderBy("component").collect()]
    assert np.allclose(s, np.linalg.svd(x, compute_uv=False)[:4], atol=1e-8)


def test_masked_mean_pool(spark):
    df = spark.createDataFrame([([[1.0, 3.0], [3.0, 5.0], [100.0, 100.0]], [1.0, 1.0, 0.0]), ([[1.0, 1.0]], [0.0])], "h array<array<double>>, m array<double>")
    assert [r[0] for r in df.select(E.masked_mean_pool(F.col("h"), F.col("m"))).collect()] == [[2.0, 4.0], [0.0, 0.0]]


def test_resumed_encoding_is_complete_and_guarded(spark, tmp_path):
    df, path = reps(spark), str(tmp_path / "vectors")
    assert E.resume_encoding(df, "source_row_id", "a", path, at_most=3).count() == 3
    assert E.resume_encoding(df, "source_row_id", "a", path).count() == 4
    assert E.resume_encoding(df, "source_row_id", "a", path).count() == 4
    with pytest.raises(ValueError):
        E.resume_encoding(df, "source_row_id", "b", path)
    for bad in ({"pooling": "max"}, {"max_length": 1024}):
        with pytest.raises(ValueError):
            E.EncoderSpec(**bad)


def test_monotonic_check_spans_ranges(spark):
    df = spark.range(500).select(F.col("id").alias("p"), F.when(F.col("id") == 250, 0).otherwise(F.col("id")).alias("v"))
    assert A.id_monotonic(df, "p", "v", 7).first()["decreases"] == 1
    assert A.id_monotonic(spark.range(500).select(F.col("id").alias("p"), F.col("id").alias("v")), "p", "v", 7).first()["is_monotonic"]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "source_row_id long, a string, b string")
    from lexflume.operators.features import representation_comparison

    r = representation_comparison(df, ["a"]).first()
    assert r["row_count"] == 0 and r["null_pct"] == 0.0 and r["max_word_count"] == 0
    assert A.duplicate_key_audit(df, ["a"]).first()["total_rows"] == 0
    assert V.blocks(V.report(spark, V.input_contract(df, id_column="source_row_id", representations=["a"])))
