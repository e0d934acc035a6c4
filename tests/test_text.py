import unicodedata

import pytest
from pyspark.sql import functions as F

from lexflume.functions import html as H
from lexflume.functions import text as X
from lexflume.functions import urls as U

TWICE = "Up 3.5% at $12,000: BTC wins the SEC's approval, says an ETF desk!"
ROWS = [(11, TWICE, "btc win sec approval etf desk"), (40, "Will the Fed cut?", "fed cut"), (41, "   ", None), (77, "Quiet day", "day")]
GROUPS = {"crypto_assets": ["bitcoin", "btc"], "regulation": ["sec", "approval"], "instruments": ["etf"], "macro": ["fed", "rate cut"]}


def frame(spark):
    return spark.createDataFrame(ROWS, "source_row_id long, text_title_description string, Filtered_Text string")


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", column.alias("v"))
    return [r["v"] for r in df.orderBy("i").collect()]


def test_hand_computed_features(spark):
    r = frame(spark).where("source_row_id = 11").select(*X.representation_features("text_title_description", "p", groups=GROUPS)).first().asDict()
    want = {"number_count": 2, "percentage_count": 1, "currency_symbol_count": 1, "exclamation_mark_count": 1, "keyword_crypto_assets_count": 1, "keyword_regulation_count": 2, "keyword_instruments_count": 1}
    assert {k: r[f"p__{k}"] for k in want} == want


def test_features_have_24_columns_and_keep_duplicate_ids(spark):
    from lexflume.operators.features import row_features

    both = frame(spark).unionByName(frame(spark))
    out = row_features(both, id_column="source_row_id", prefixes={"text_title_description": "a", "Filtered_Text": "b"})
    assert len(out.columns) == 49 and out.count() == 8


def test_length_metrics_of_null_and_blank(spark):
    t = ["x", None, "  ", "BTC rises 5%"][1:]
    m = X.length_metrics("t")
    assert values(spark, t, m["is_null"]) == [1, 0, 0] and values(spark, t, m["is_empty"]) == [1, 1, 0] and values(spark, t, m["word_count"]) == [0, 0, 3]


def test_strip_is_pythons(spark):
    spaces = [chr(c) for c in range(1, 0x3100) if chr(c).isspace()]
    texts = [f"{s}a{s}b{s}" for s in spaces] + ["​x", ""]
    assert values(spark, texts, X.strip("t")) == [t.strip() for t in texts]
    assert values(spark, texts, F.size(X.split_words("t"))) == [len(t.split()) for t in texts]


@pytest.mark.parametrize(("raw", "clean"), [
    ("<p>BTC &amp; ETF</p>", "BTC & ETF"), ("&lt;p&gt;x&lt;/p&gt;", "x"), ("gain <5% today", "gain <5% today"), ("see https://a.b/c?d=1.", "see <URL>."), ("a<!-- b -->c", "a c"), ("＜p＞", "<p>"), ("a​b﻿", "ab"), (None, ""), ("  $67,500  5.2%  ", "$67,500 5.2%"),
    ('see "https://a.b/c" now', 'see "<URL>" now'), ("[https://x.y/z] ok", "[<URL>] ok"), ("xwww.foo.com", "xwww.foo.com"), ("(WWW.foo.com/a?b=c)!", "(<URL>!"), ("a 'www.b.c', d", "a '<URL>', d"),
])
def test_clean_text(spark, raw, clean):
    assert X.clean_one(raw) == clean
    assert values(spark, [raw], X.clean_text("t")) == [clean]


def test_cleaning_is_idempotent_on_ascii():
    for t in ("a  b", "x <b>y</b>", "gain <5% $2"):  # a replaced URL looks like a tag, so texts with one aren't
        assert X.clean_one(X.clean_one(t)) == X.clean_one(t)


def test_overlapping_keywords_count_twice(spark):
    found, n = X.keyword_hits(F.col("t"), ["bitcoin", "bitcoin etf"])
    assert values(spark, ["a Bitcoin ETF, bitcoins"], n) == [2] and values(spark, ["a Bitcoin  ETF"], found) == [["bitcoin", "bitcoin etf"]]


@pytest.mark.parametrize(("url", "canonical"), [
    ("HTTPS://Example.COM/a/?utm_source=x&b=&c=1#f", "https://example.com/a?b=&c=1"), ("example.com/x/", "https://example.com/x"), ("https://e.com/", "https://e.com/"), ("https://e.com/?FBCLID=1", "https://e.com/"), (None, ""), ("  ", ""), ("https://", "https://"), ("https://[bad", "https://[bad"),
])
def test_canonical_url(url, canonical):
    assert U.canonical_one(url) == canonical


ARTICLE = """<html><head><link rel='canonical' href='/news/2030-7'></head><body><main><h1>Court Fines Bitcoin Firm</h1><p>A subtitle of note</p>
<p>For Immediate Release</p><p>2030-7</p><p>Washington D.C., March 5, 2030 —</p><p>The court fined a bitcoin firm.</p><p>The court fined a bitcoin firm.</p><script>x</script><p>###</p><p>Last Reviewed or Updated: 2030-03-06</p></main></body></html>"""


def test_article_record():
    r = H.parse_article_one(ARTICLE, "https://x.org/a", ["bitcoin", "crypto"])
    assert (r["title"], r["release_number"], r["published_at"], r["last_reviewed_at"]) == ("Court Fines Bitcoin Firm", "2030-7", "2030-03-05", "2030-03-06")
    assert r["canonical_url"] == "https://x.org/news/2030-7" and r["full_text"] == "The court fined a bitcoin firm." and r["description"] == "A subtitle of note"
    assert r["matched_keywords"] == ["bitcoin"] and r["keyword_count"] == 2 and r["is_related"] and r["error"] is None


def test_article_errors_are_values():
    assert H.parse_article_one("<p>x</p>", "u", [])["error"] == "title not found"
    assert H.parse_article_one("<h1>x</h1>", "u", [])["error"] == "release number not found"
    assert H.parse_article_one(None, None, [])["error"] == "title not found"


def test_listing_keeps_articles_only():
    page = """<table><tr><td><time datetime="2030-01-02">Jan</time></td><td><a href="/newsroom/press-releases/2030-9-a">One</a></td></tr>
    <tr><td>Feb. 2, 2030</td><td><a href="/newsroom/press-releases/2030-10">Two</a></td></tr><tr><td><a href="/speech/2030-1">No</a></td></tr></table>"""
    r = H.listing_rows(page, "https://x.org/", 3)
    assert [(c["release_number"], c["date_text"], c["page"]) for c in r] == [("2030-9", "2030-01-02", 3), ("2030-10", "Feb. 2, 2030", 3)]


def test_nfkc_is_pythons(spark):
    t = "ﬁ ① ｶﾞ"
    assert X.clean_one(t) == unicodedata.normalize("NFKC", t)


def test_article_paths(spark):
    urls = ["https://x.org/newsroom/press-releases/2031-7", "https://x.org/News/Press-Release/1999-120-b", "https://x.org/speech/2031-7", "https://x.org/?u=/newsroom/press-releases/2031-7", "https://x.org/newsroom/press-releases/31-7", "", None]
    assert values(spark, urls, U.is_article(F.col("t"))) == [True, True, False, False, False, False, False]


def test_slugs():
    assert [X.slug(n) for n in ("Rate Cut", "  SEC / CFTC!", "Straße_2")] == ["rate_cut", "sec_cftc", "strasse_2"]
    with pytest.raises(ValueError):
        X.slug("--")
