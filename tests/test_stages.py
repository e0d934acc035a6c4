import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexflume.functions import text as X
from lexflume.operators import embed as E
from lexflume.operators import preprocess as P
from lexflume.operators import reduce as R
from lexflume.operators import tfidf as M
from lexflume.plans import catalog as K
from lexflume.plans import config as C
from lexflume.plans import stages as G
from lexflume.sources import files as Y
from lexflume.sources import web as W
from lexflume.streaming import dedup as D

SF = "/root/testdata/sf0.001"


def record(spark, path):
    return json.loads(spark.read.text(path).first()[0])


def test_settings_are_laid_over_defaults(tmp_path):
    over = {"audit": {"percentile": 0.5}, "input": {"representations": ["Filtered_Text"]}}
    (tmp_path / "c.json").write_text(json.dumps(over))
    got = C.load(tmp_path / "c.json")
    assert got["audit"] == {"percentile": 0.5, "very_short_max_words": 3, "very_short_max_characters": 20} and got["input"]["representations"] == ["Filtered_Text"]
    assert C.DEFAULTS["audit"]["percentile"] == 0.95 and C.load() == C.DEFAULTS
    (tmp_path / "d.json").write_text("[1]")
    with pytest.raises(TypeError):
        C.load(tmp_path / "d.json")


@pytest.mark.parametrize(("path", "value"), [
    ("input.id_column", " "), ("input.representations", []), ("input.representations", ["Filtered_Text"] * 2), ("input.representations", ["other"]), ("input.reference_row_count", 0), ("validation.fail_on_severity", ["bad"]), ("validation.fail_on_severity", []), ("validation.row_count_warning_ratio", -1),
    ("audit.percentile", 0), ("audit.percentile", 1.1), ("audit.very_short_max_words", -1), ("audit.very_short_max_words", 1.5), ("features.currency_symbols", []), ("features.keyword_groups", {"a": []}), ("features.representation_prefixes", {"text_title_description": "x", "Filtered_Text": "x "}), ("features.representation_prefixes", None),
])
def test_bad_settings_are_refused(path, value):
    config = C.merged(C.DEFAULTS, {})
    part, name = path.split(".")
    config[part][name] = value
    with pytest.raises(ValueError, match="features" if value == ["other"] else path):
        C.validate(config)


def test_collection_settings():
    good = {"source": {"name": "S", "base_url": "https://x.org", "max_pages": 2}, "http": {"allowed_hosts": ["x.org"], "user_agent": "me", "delay_seconds": 0}, "filter": {"keywords": ["a"], "required_matches": 1}}
    C.validate(good, C.COLLECTION_RULES)
    for path in ("source.base_url", "http.allowed_hosts", "filter.required_matches"):
        bad = C.merged(good, {path.split(".")[0]: {path.split(".")[1]: None}})
        with pytest.raises(ValueError, match=path):
            C.validate(bad, C.COLLECTION_RULES)


def site(answers):
    asked, now = [], [0.0]

    def ask(url, headers, seconds):
        asked.append((now[0], url))
        a = answers.get(url.partition("?")[0])
        a = a.pop(0) if isinstance(a, list) else a
        if isinstance(a, Exception):
            raise a
        return a

    def sleep(seconds):
        now[0] += seconds

    return W.Fetcher(["x.org"], "me", delay=2.0, ask=ask, sleep=sleep, clock=lambda: now[0]), asked


def test_fetching_is_polite(spark, tmp_path):
    page = W.Answer("https://x.org/a", 200, "text/html", "<p>a</p>")
    fetcher, asked = site({"https://x.org/a": page, "https://x.org/b": [W.Answer("", 503, "", ""), OSError("gone"), page], "https://x.org/c": W.Answer("", 429, "", ""), "https://x.org/d": W.Answer("https://x.org/d", 200, "image/png", ""), "https://x.org/e": W.Answer("https://y.org/", 200, "text/html", "")})
    pages, failed = W.fetched(spark, fetcher, [f"https://x.org/{k}" for k in "abcde"] + ["https://y.org/a", "https://[x"])
    assert [r["html"] for r in pages.collect()] == ["<p>a</p>"] * 2
    assert [(r["url"][-1], r["error"].split(":")[0]) for r in failed.collect()] == [("c", "answer 429"), ("d", "image/png is no page"), ("e", "led to a host that isn't allowed"), ("a", "host not allowed"), ("x", "host not allowed")]
    assert all(b[0] - a[0] >= 2 for a, b in zip(asked, asked[1:], strict=False)) and len(asked) == 7
    W.store_pages(pages, str(tmp_path / "raw"))
    W.store_pages(pages, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 4


def test_listing_stops_at_an_empty_page_or_an_error():
    full = W.Answer("https://x.org/list", 200, "text/html", "<div><a href='/news/press-release/2020-1'>One</a></div>")
    empty = W.Answer("https://x.org/list", 200, "text/html", "<p></p>")
    fetcher, asked = site({"https://x.org/list": [full, full, empty, full]})
    found = list(W.listing_pages(fetcher, "https://x.org/list", "bitcoin"))
    assert [(r["release_number"], r["page"]) for r in found] == [("2020-1", 0), ("2020-1", 1)] and len(asked) == 3 and "combine=bitcoin&page=1&year=All" in asked[1][1]
    failures = []
    fetcher, _ = site({"https://x.org/list": [full, W.Answer("", 403, "", "")]})
    assert len(list(W.listing_pages(fetcher, "https://x.org/list", "q", failures=failures))) == 1 and failures[0][1] == "listing_page_1"


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b\nc', None), (2, "", "é"), (3, " \t x  ", "\n")], "`id, x` int, t string, u string")
    Y.write_csv(df, str(tmp_path / "p.csv"))
    assert sorted(map(repr, Y.read_csv(spark, str(tmp_path / "p.csv"), df.schema).collect())) == sorted(map(repr, df.collect()))
    path = str(tmp_path / "t.csv")
    Y.write_csv(df.coalesce(1), path, bom=True)
    assert Y.header(spark, path) == ["id, x", "t", "u"] and Y.exists(spark, path)
    assert sorted(map(repr, Y.read_csv(spark, path, df.schema).collect())) == sorted(map(repr, df.collect()))
    assert Y.read_existing(spark, path, df.schema).count() == 3 and Y.read_existing(spark, path + "x", df.schema) is None
    Y.write_jsonl(df.select("u", "t").where("t not like '%x%'"), str(tmp_path / "j"))
    assert {r[0] for r in spark.read.text(str(tmp_path / "j")).collect()} == {'{"t":"a \\"q\\", b\\nc","u":null}', '{"t":"","u":"é"}'}
    (tmp_path / "f.bin").write_bytes(b"x" * 2048)
    m = Y.file_metadata(spark, str(tmp_path / "f.bin")).first()
    assert (m["length"], m["size"]) == (2048, "2.00 KB") and m["mb"] == 2048 / 2**20
    assert Y.first_that_exists(spark, [path + "x", path]) == path
    with pytest.raises(FileNotFoundError):
        Y.first_that_exists(spark, [path + "x"])
    assert Y.inside("/a/b", "c/../d") == "/a/b/d" and X.file_token("a b/c: é.txt") == "a_b_c_.txt" and X.file_token("//") == "_"
    for out in ("../c", "/etc", "c/../../bc"):
        with pytest.raises(ValueError):
            Y.inside("/a/b", out)


def test_schema_helpers(spark):
    found = P.resolve_schema(["Title", "link", "body", "Coin Type"])
    assert found == {"url": "link", "title": "Title", "full_text": "body", "coin_type": "Coin Type"}
    with pytest.raises(ValueError, match="description"):
        P.require_schema(["Title", "link"], ["title", "description"])
    df = spark.createDataFrame([("", "b"), ("a", "b"), (None, None)], "p string, q string")
    assert [r[0] for r in df.select(P.detector_input("p", "q")).collect()] == ["b", "a", None]
    P.same_types(df, df.withColumn("z", F.lit(1)))
    with pytest.raises(ValueError):
        P.same_types(df, df.withColumn("q", F.lit(1)))


def test_preprocessing_accounts_for_every_row(spark, tmp_path):
    raw = K.raw_articles(spark, SF)
    out = G.preprocess(spark, raw, str(tmp_path / "out"), labels=["Bitcoin", " btc"], language=F.col("lang"))
    counts = spark.read.parquet(str(tmp_path / "out_accounting")).orderBy("position").collect()
    assert counts[0]["rows"] == raw.count() and counts[-1]["rows"] == out.count() and sum(r["removed"] for r in counts) == counts[0]["rows"] - counts[-1]["rows"]
    assert set(raw.columns) <= set(out.columns) and not set(G.KEPT_KEYS) & set(out.columns)
    seen = []
    detector = F.when(P.detector_input("primary", "fallback").contains("T 1"), "en").otherwise("xx")
    seen = G.preprocessed(raw, labels=["btc"], language=detector)[0].select("text_title_description").collect()
    assert seen and all("T 1" in r[0] for r in seen)
    with pytest.raises(ValueError):
        G.preprocess(spark, raw, str(tmp_path / "none"), labels=["dogecoin"])
    assert not (tmp_path / "none").exists()
    with pytest.raises(ValueError):
        G.preprocessed(raw, labels=[])


def test_row_feature_stage_completes_or_says_why_not(spark, tmp_path):
    df, config = K.articles(spark, SF), K._stage_config()
    done = G.row_feature_stage(spark, df, str(tmp_path / "a"), config)
    kept = record(spark, str(tmp_path / "a/record"))
    assert kept["status"] == "completed_with_warnings" and kept["skipped"] == ["nowhere"] and kept["feature_rows"] == df.count() == done.output.count()
    config["validation"]["continue_with_available_representations"] = False
    with pytest.raises(G.Blocked):
        G.row_feature_stage(spark, df, str(tmp_path / "b"), config)
    assert record(spark, str(tmp_path / "b/record"))["status"] == "blocked" and not (tmp_path / "b/candidate").exists()
    with pytest.raises(G.Blocked, match="contract"):
        G.row_feature_stage(spark, df.drop("source_row_id"), str(tmp_path / "c"), K._stage_config())
    assert record(spark, str(tmp_path / "c/record"))["contract"]["critical"] >= 1
    with pytest.raises(G.Blocked, match="can't be read"):
        G.row_feature_stage(spark, str(tmp_path / "nothing"), str(tmp_path / "d"), K._stage_config())


def test_collection_adds_to_what_is_there(spark, tmp_path):
    pages, folder = K.releases(spark, SF).where("page_id % 7 <> 0 and page_id < 40"), str(tmp_path / "c")
    first = G.collect(spark, pages.where("page_id < 20"), folder, keywords=["court"], scraped_at="2025-01-01")
    both = G.collect(spark, pages, folder, keywords=["court"], scraped_at="2025-02-01")
    assert first.count() < both.count() == pages.count() and both.where("document_id is null").isEmpty()
    assert spark.read.parquet(f"{folder}/summary").first()["records"] == both.count()
    none = G.collected(pages, keywords=["nobody says this"], scraped_at="x")
    assert none[0].isEmpty()


def test_methods_in_one_inventory(spark, tmp_path):
    df = K.docs(spark, SF).limit(40)
    tfidf = M.benchmark(df, "doc_id", ["text"], {"word": M.Recipe(max_features=50), "char": M.Recipe("char_wb", 3, 4, max_features=60)}, str(tmp_path))
    encoders = E.encoder_benchmark(df, "doc_id", ["text", "source"], [E.EncoderSpec(), E.EncoderSpec("other", "cls", 4, 3)])
    rows = G.method_benchmark(spark, {"row_features": None, "tfidf": tfidf, "encoder": encoders, "reduction": None}).collect()
    assert len(rows) == 6 and len(rows[0]) == 12 and {r["dimensions"] for r in rows} == {50, 60, 8, 3} and all(r["elapsed_seconds"] > 0 and r["finite_values"] for r in rows)
    assert encoders.where("method = 'other' and representation = 'text'").first()["truncated"] > 0
    model, recipe = M.load(spark, str(tmp_path / "text__char"))
    again = M.fit(df, "doc_id", "text", recipe)
    assert recipe == M.Recipe("char_wb", 3, 4, max_features=60) and sorted(map(tuple, model.select("term", "column", "idf").collect())) == sorted(map(tuple, again.collect()))
    assert M.recipe_of({"analyzer": "word", "min_df": 1}) == M.Recipe(min_df=1)
    with pytest.raises(ValueError, match="unknown"):
        M.recipe_of({"ngrams": 1})


def test_stand_in_encoder_and_its_record(spark):
    spec = E.EncoderSpec(dimensions=5, max_length=3)
    vectors, counts, cut = E.HashEncoder(spec).encode(["a b", "", "a b c d", "a b c"])
    assert counts.tolist() == [2, 0, 4, 3] and cut.tolist() == [False, False, True, False] and not vectors[1].any() and np.array_equal(vectors[2], vectors[3])
    with pytest.raises(ValueError, match="revision"):
        E.bundle_record(spec)
    assert E.bundle_record(E.EncoderSpec(revision="abc"))["frozen"] and E.bundle_record(spec, pinned=False)["dimensions"] == 5
    df = spark.createDataFrame([(1, "a b"), (2, "a b c d")], "i long, t string")
    r = E.token_report(E.encode(df, "i", "t", spec)).first()
    assert (r["rows"], r["truncated"], r["truncated_pct"], r["median_tokens"], r["max_tokens"]) == (2, 1, 50.0, 3.0, 4)


def test_resume_refuses_other_rows_of_the_same_size(spark, tmp_path):
    rows = lambda ids: spark.createDataFrame([(i, f"t{i}") for i in ids], "i long, t string")
    E.resume_encoding(rows([1, 2, 5]), "i", "t", str(tmp_path / "v"))
    with pytest.raises(ValueError):
        E.resume_encoding(rows([1, 3, 5]), "i", "t", str(tmp_path / "v"))


def test_merged_stream_survives_a_restart(spark, tmp_path):
    cols = "ingest_seq long, release_number string, canonical_url string, content_hash string"
    rows = [(1, "a", "u1", "h1"), (2, "b", "u2", "h2"), (3, "a", "u3", "h3"), (4, "c", "u4", "h4")]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (rows[:2], rows[2:]):
        spark.createDataFrame(part, cols).coalesce(1).write.mode("append").parquet(source)
        query = D.merge_batches(spark.readStream.schema(cols).parquet(source), target).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(r["ingest_seq"] for r in D.merged_table(spark, target).collect()) == [2, 3, 4] and len(D.versions(spark, target)) == 2
    (tmp_path / "out/v9").mkdir()
    assert len(D.versions(spark, target)) == 2  # a write that never committed doesn't count


def test_windowed_counts(spark, tmp_path):
    at = lambda h, m: f"2024-01-01 {h:02d}:{m:02d}:00"
    df = spark.createDataFrame([(at(1, 5), "a"), (at(1, 50), "a"), (at(2, 1), "a"), (at(1, 6), "b"), (at(9, 0), "z")], "t string, k string").select(F.to_timestamp("t").alias("t"), "k")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    counted = D.windowed_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "t", "k")
    query = counted.writeStream.format("memory").queryName("windowed").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["window"].start.hour, r["k"], r["n"]) for r in spark.table("windowed").collect()) == [(1, "a", 2), (1, "b", 1), (2, "a", 1), (9, "z", 1)]


def test_ties_of_position_don_t_hide_falls(spark):
    from lexflume.operators import audit as A

    df = spark.createDataFrame([(1, 0, 5), (1, 1, 3), (2, 2, 4)], "p int, t int, v int")
    assert A.id_monotonic(df, "p", "v", tie="t").first()["decreases"] == 1 and A.id_monotonic(df, "p", "v").first()["decreases"] == 1


def test_reduction_is_saved_with_its_steps(spark, tmp_path):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(40)], "k int, v array<double>")
    model, centre, k = R.pca(df, "k", "v", 3)
    made = R.pca_transform(df, model, centre, "k", "v")
    R.save_pca(made, model, centre, str(tmp_path / "r"))
    R.save_pca(made, model, centre, str(tmp_path / "r"))
    again = R.pca_transform(df, *R.load_pca(str(tmp_path / "r")), "k", "v").orderBy("k").collect()
    kept = spark.read.parquet(str(tmp_path / "r" / "rows")).orderBy("k").collect()
    assert k == 3 and len(kept) == 40 and again == kept == made.orderBy("k").collect()


def test_embeddings_are_saved_with_their_record(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b c"), (2, None), (3, "d " * 9)], "k int, t string")
    spec = E.EncoderSpec(max_length=4)
    with pytest.raises(ValueError):
        E.save_embeddings(E.encode(df, "k", "t", spec), spec, str(tmp_path / "e"))
    assert not (tmp_path / "e").exists()
    made = E.save_embeddings(E.encode(df, "k", "t", spec), spec, str(tmp_path / "e"), pinned=False)
    assert made["rows"] == 3 and made["truncated"] == 1 and made["max_tokens"] == 9 and made["pooling"] == "masked_mean"
    assert record(spark, str(tmp_path / "e" / "record")) == made and spark.read.parquet(str(tmp_path / "e" / "vectors")).count() == 3


def test_downloads_appear_whole(tmp_path, monkeypatch):
    (tmp_path / "source").write_bytes(b"abc" * 1000)
    url, target = f"file://{tmp_path}/source", tmp_path / "d" / "t"
    assert W.download(url, str(target), piece=7) and target.read_bytes() == b"abc" * 1000
    (tmp_path / "source").write_bytes(b"other")
    assert not W.download(url, str(target)) and target.stat().st_size == 3000

    def broken(source, out, piece):
        out.write(b"half")
        raise OSError("gone")

    monkeypatch.setattr(W.shutil, "copyfileobj", broken)
    with pytest.raises(OSError):
        W.download(url, str(tmp_path / "d" / "u"))
    assert [p.name for p in (tmp_path / "d").iterdir()] == ["t"]
