"""The registered queries: each operator on the tables of a scale-factor folder, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.functions import html as H
from lexflume.functions import text as X
from lexflume.functions import urls as U
from lexflume.operators import audit as A
from lexflume.operators import embed as E
from lexflume.operators import features as R
from lexflume.operators import ingest as I
from lexflume.operators import preprocess as P
from lexflume.operators import reduce as D
from lexflume.operators import sampling as S
from lexflume.operators import tfidf as M
from lexflume.operators import validate as V
from lexflume.plans import config as C
from lexflume.plans import stages as G
from lexflume.sources import files as Y
from lexflume.streaming.dedup import stream_distinct

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Words that occur in the test documents, in the place of the default groups.
LEXICON = {"common": ["the", "of the", "is"], "other": ["and", "der", "le"]}
HOSTS = ["ththre.example.com", "thther.example.org"]
#: The SQL has its own patterns, written out, so that a wrong one in the package shows.
WS = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SQL_WORD = r"[0-9A-Za-z]+([-'’][0-9A-Za-z]+)*"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        name = f.__name__.removesuffix("_")
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return Y.read_table(spark, f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, some without a text and some with a blank one."""
    k = F.col("doc_id")
    return docs(spark, sf_dir).withColumn("text", F.when(k % 13 != 0, F.when(k % 17 == 0, F.lit(" \n\u00a0\u3000")).otherwise(F.col("text"))))


BLANKED = "(SELECT * REPLACE (CASE WHEN doc_id % 13 <> 0 THEN CASE WHEN doc_id % 17 = 0 THEN ' ' || chr(10) || chr(160) || chr(12288) ELSE text END END AS text) FROM documents)"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: the first two lines are title and description; every fifth has no URL, the others share one with a twin."""
    line = lambda k: F.coalesce(F.get(F.split("text", "\n"), F.lit(k)), F.lit(""))
    d = docs(spark, sf_dir).select(F.col("doc_id").alias("source_row_id"), line(0).alias("title"), line(1).alias("description"), F.col("text").alias("full_text"), "lang", "source")
    return d.withColumn("url_key", F.when(F.col("source_row_id") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("https://x/"), F.col("source_row_id").cast("string").substr(1, 2), F.lit("/"), F.col("source")))).withColumn("title_key", X.title_like_key("title")).withColumn("description_key", X.title_like_key("description"))


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def sql_filled(c: str) -> str:
    return sql_strip(f"coalesce({c}, '')")


def sql_title_key(c: str) -> str:
    inner = f"regexp_replace(coalesce({c}, ''), '{WS}+', ' ', 'g')"
    return f"lower({sql_strip(inner)})"


def sql_count(c: str, pattern: str) -> str:
    return "len(regexp_extract_all({}, '{}'))".format(c, pattern.replace("'", "''"))


def sql_words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS}+'), lambda x: x <> '')"


NUMBER = r"\b(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?\b"
PERCENT = r"\b(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?\s*%"
CURRENCY = r"[\$€£¥₹₽₩₿]"


def sql_keyword(k: str) -> str:
    return r"(?i)\b" + r"\s+".join(k.split()) + r"\b"


ARTICLES = f"""articles AS (
    SELECT *, {sql_title_key('title')} AS title_key, {sql_title_key('description')} AS description_key,
           CASE WHEN source_row_id % 5 = 0 THEN '' ELSE 'https://x/' || substr(source_row_id::VARCHAR, 1, 2) || '/' || source END AS url_key
    FROM (SELECT doc_id AS source_row_id, coalesce(string_split(text, chr(10))[1], '') AS title, coalesce(string_split(text, chr(10))[2], '') AS description, text AS full_text, lang, source FROM documents))"""


def pct(part: str, whole: str) -> str:
    return f"coalesce({part} * 100.0 / nullif({whole}, 0), 0.0)"


# ---------------------------------------------------------------- sources and sinks


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv_roundtrip(spark, sf):
    d, path = docs(spark, sf), Y.shared_path(spark, "csv")
    Y.write_csv(d, path)
    return Y.read_csv(spark, path, d.schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_parquet_roundtrip(spark, sf):
    path = Y.shared_path(spark, "parquet")
    docs(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


@query("SELECT doc_id, text, lang FROM documents")
def snapshot_import(spark, sf):
    d, path = docs(spark, sf).select("doc_id", "text", "lang"), Y.shared_path(spark, "jsonl")
    d.write.json(path)
    return Y.read_jsonl(spark, path, d.schema)


@query("SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS column_name, unnest([0, 1, 2, 3, 4]) AS position")
def schema_columns(spark, sf):
    return spark.createDataFrame(list(enumerate(docs(spark, sf).columns)), "position int, column_name string")


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 100")
def head_sample(spark, sf):
    return Y.head_sample(docs(spark, sf), "doc_id", 100, ["doc_id", "lang", "source"])


@query("SELECT doc_id, CASE WHEN n_chars < 1024 THEN printf('%.2f B', n_chars::DOUBLE) WHEN n_chars < 1048576 THEN printf('%.2f KB', floor(n_chars / 1024.0 * 100 + 0.5) / 100) ELSE printf('%.2f MB', floor(n_chars / 1048576.0 * 100 + 0.5) / 100) END AS size FROM documents")
def format_size(spark, sf):
    return docs(spark, sf).select("doc_id", Y.format_size(F.col("n_chars")).alias("size"))


@query(f"SELECT page_id, url FROM pages WHERE lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) IN {tuple(HOSTS)}")
def host_allowlist(spark, sf):
    return table(spark, sf, "pages").where(U.host_allowed(F.col("url"), HOSTS)).select("page_id", "url")


_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query("WITH f AS (SELECT " + ", ".join(_ORDERS) + " FROM orders ORDER BY o_orderkey LIMIT 500) " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(DISTINCT {c}) + max(({c} IS NULL)::INT) AS unique_count, count(*) AS sampled_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM f)) AS duplicate_rows FROM f" for c in _ORDERS))
def inspect_profile(spark, sf):
    return A.inspect_profile(table(spark, sf, "orders").select(_ORDERS), F.col("o_orderkey"))


@query("SELECT doc_id, json_object('doc_id', doc_id, 'lang', lang, 'missing', NULL, 'n_chars', n_chars, 'source', source)::VARCHAR AS record FROM documents")
def record_to_json(spark, sf):
    d = docs(spark, sf).drop("text").withColumn("missing", F.lit(None).cast("string"))
    return d.select("doc_id", Y.as_record(d).alias("record"))


@query("""WITH q AS (SELECT quantile_cont(len(text), 0.99) AS q FROM documents), k AS (SELECT len(text)::DOUBLE AS v FROM documents, q WHERE len(text) <= q),
          e AS (SELECT min(v) AS lo, max(v) AS hi FROM k) SELECT least(floor((v - lo) / greatest(hi - lo, 1.0) * 50), 49)::INT AS bin, count(*) AS count FROM k, e GROUP BY 1""")
def length_histogram(spark, sf):
    return A.length_histogram(docs(spark, sf), F.length("text"))


# ---------------------------------------------------------------- filters and predicates


@query("SELECT row_number() OVER (ORDER BY source, doc_id) - 1 AS source_row_id, doc_id, source FROM documents")
def assign_row_id(spark, sf):
    return P.assign_row_id(docs(spark, sf).select("doc_id", "source"), ["source", "doc_id"])


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE lower(trim(c_mktsegment)) IN ('building', 'machinery')")
def label_filter(spark, sf):
    return P.label_filter(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", [" BUILDING", "machinery"])


@query(r"SELECT p_partkey, p_type, coalesce(len(list_filter(regexp_split_to_array(p_type, '[,;|/]|\s'), lambda x: regexp_full_match(lower(trim(x)), 'small|promo|large'))) > 0, false) AS matches FROM part")
def multilabel_predicate(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_type", P.label_mentions(F.col("p_type"), "small|promo|large", r"[,;|/]|\s").alias("matches"))


@query(r"SELECT p_partkey FROM part WHERE regexp_matches(lower(p_type), 'econ|\blarge\b')")
def substring_predicate(spark, sf):
    return table(spark, sf, "part").where(F.lower("p_type").rlike(r"econ|\blarge\b")).select("p_partkey")


@query(f"SELECT doc_id, {sql_filled('text')} <> '' AS nonempty FROM {BLANKED}")
def nonempty_mask(spark, sf):
    return blanked(spark, sf).select("doc_id", X.nonempty("text").alias("nonempty"))


@query(f"WITH {ARTICLES} SELECT source_row_id FROM articles WHERE {sql_filled('title')} <> '' OR {sql_filled('description')} <> '' OR {sql_filled('full_text')} <> ''")
def usable_text(spark, sf):
    return P.usable_text(articles(spark, sf), ["title", "description", "full_text"]).select("source_row_id")


@query("SELECT doc_id FROM documents WHERE lang = 'en'")
def english_filter(spark, sf):
    return P.filter_language(docs(spark, sf), F.col("lang")).select("doc_id")


@query(r"SELECT doc_id, len(regexp_replace(substr(coalesce(text, ''), 1, 500), '\P{L}', '', 'g')) >= 20 AS enough FROM documents")
def language_guard(spark, sf):
    return docs(spark, sf).select("doc_id", P.language_guard(F.col("text")).alias("enough"))


_HITS = ["the", "of the", "heat", "der"]
_HIT_SQL = " + ".join(f"(CASE WHEN {sql_count('text', sql_keyword(k))} > 0 THEN 1 ELSE 0 END)" for k in _HITS)


@query(f"SELECT doc_id FROM documents WHERE {_HIT_SQL} >= 2")
def keyword_relevance_filter(spark, sf):
    return I.relevant(docs(spark, sf), F.col("text"), _HITS, 2).select("doc_id")


@query("SELECT page_id, page_id % 7 <> 0 AS is_article FROM pages")
def url_path_filter(spark, sf):
    return releases(spark, sf).select("page_id", U.is_article(F.col("url")).alias("is_article"))


@query("SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def incremental_new_urls(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return I.new_urls(p, p.where("page_id % 3 = 0")).select("page_id", "url")


@query("SELECT doc_id::VARCHAR AS source_row_id, NULL::VARCHAR AS title, text AS full_text, NULL::INT AS http_status FROM documents")
def normalize_output_schema(spark, sf):
    d = docs(spark, sf).select(F.col("doc_id").alias("source_row_id"), F.col("text").alias("full_text"), "lang")
    return I.output_schema(d, {"source_row_id": "string", "title": "string", "full_text": "string", "http_status": "int"})


#: Columns that tell what happened to the price and must not become text features.
LEAKAGE = ["sentiment_label", "sentiment_score", "Open", "High", "Low", "Close", "Volume", "Market_Move", "Movement_OpenClose_%", "Movement_HighLow_%"]
_EXPECTED = ["doc_id", "text", "title", "source", "lang", "url"]


@query(f"SELECT c AS column_name, c IN ('Volume', 'Close') AS present, c NOT IN ('Volume', 'Close') AS safe FROM (SELECT unnest({LEAKAGE}) AS c)")
def leakage_review(spark, sf):
    return A.leakage_review(docs(spark, sf).withColumnsRenamed({"n_chars": "Volume", "source": "Close"}), LEAKAGE)


_SCHEMA_SQL = f"""WITH e AS (SELECT unnest({_EXPECTED}) AS column_name, unnest(range({len(_EXPECTED)}))::INT AS expected_position),
    a AS (SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS column_name, unnest(range(5))::INT AS actual_position),
    s AS (SELECT coalesce(e.column_name, a.column_name) AS column_name, e.column_name IS NOT NULL AS expected, a.column_name IS NOT NULL AS present, expected_position, actual_position FROM e FULL JOIN a ON e.column_name = a.column_name)"""


@query(_SCHEMA_SQL + " SELECT column_name, expected, present, coalesce(expected_position, -1)::INT AS expected_position, coalesce(actual_position, -1)::INT AS actual_position FROM s")
def schema_audit(spark, sf):
    return A.schema_audit(docs(spark, sf), _EXPECTED).fillna(-1)


@query(_SCHEMA_SQL + " SELECT column_name, expected, present FROM s WHERE expected <> present")
def schema_missing_unexpected(spark, sf):
    s = A.schema_audit(docs(spark, sf), _EXPECTED).select("column_name", "expected", "present")
    return s.filter("expected and not present").unionByName(s.filter("not expected and present"))


# ---------------------------------------------------------------- joins and set operations


@query("SELECT p_partkey, p_type FROM part WHERE lower(trim(p_type)) IN (SELECT lower(trim(p_type)) FROM part WHERE regexp_matches(p_type, 'ECON'))")
def semi_join_labels(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return P.semi_join_labels(p, "p_type", A.accepted_labels(A.category_audit(p, "p_type", F.col("category").contains("ECON"))))


@query("SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def features_labels_join(spark, sf):
    return docs(spark, sf).select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")


@query("SELECT lang AS value, count(*) AS count, 'lang' AS report FROM documents GROUP BY 1 UNION ALL SELECT source, count(*), 'source' FROM documents GROUP BY 1")
def union_reports(spark, sf):
    d = docs(spark, sf)
    return A.value_counts(d, "lang").withColumn("report", F.lit("lang")).unionByName(A.value_counts(d, "source").withColumn("report", F.lit("source")))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(lower(string_split(coalesce(text, ''), chr(10))[1]), ' '))), '|') AS keywords FROM documents")
def keyword_join(spark, sf):
    words = F.split(F.lower(F.get(F.split(F.coalesce("text", F.lit("")), "\n"), F.lit(0))), " ")
    return docs(spark, sf).select("doc_id", I.joined_keywords(words).alias("keywords"))


# ---------------------------------------------------------------- aggregations


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf):
    return A.row_count(table(spark, sf, "lineitem"))


_MISS = ["doc_id", "lang", "quality", "toxic"]


@query("WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, {pct(f'(count(*) - count({c}))', 'count(*)')} AS missing_pct, count(*) AS total FROM j" for c in _MISS))
def missingness(spark, sf):
    return A.missingness(docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left").select(_MISS))


@query("SELECT coalesce(event_type, '<MISSING>') AS value, count(*) AS count FROM events GROUP BY 1")
def value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "events"), "event_type")


@query("SELECT p_type AS category, count(*) AS row_count, coalesce(regexp_matches(p_type, 'ECON'), false) AS matches FROM part GROUP BY 1")
def category_audit(spark, sf):
    return A.category_audit(table(spark, sf, "part"), "p_type", F.col("category").contains("ECON"))


@query(f"SELECT count(*) FILTER (p_type LIKE '%ECON%') AS matching_rows, count(*) AS total_rows, {pct('count(*) FILTER (p_type LIKE ' + chr(39) + '%ECON%' + chr(39) + ')', 'count(*)')} AS matching_pct FROM part")
def category_share(spark, sf):
    return A.category_share(table(spark, sf, "part"), F.col("p_type").contains("ECON"))


def _dup_sql(source: str, key: str) -> str:
    return f"WITH k AS (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY ALL) SELECT sum(n)::BIGINT AS total_rows, count(*) AS unique_keys, (sum(n) - count(*))::BIGINT AS duplicate_rows, {pct('(sum(n) - count(*))', 'sum(n)')} AS duplicate_pct FROM k"


@query(_dup_sql("documents", "coalesce(text, '<MISSING>')"))
def duplicate_key_audit(spark, sf):
    return A.duplicate_key_audit(docs(spark, sf), ["text"])


@query(_dup_sql("lineitem", "(l_orderkey, l_suppkey)"))
def duplicate_key_audit_multi(spark, sf):
    return A.duplicate_key_audit(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"])


@query(f"WITH {ARTICLES}, c AS (SELECT count(*) AS n, count(*) FILTER (url_key <> '') - count(DISTINCT url_key) FILTER (url_key <> '') AS u, count(*) FILTER (url_key <> '' AND title_key <> '') - count(DISTINCT (url_key, title_key)) FILTER (url_key <> '' AND title_key <> '') AS b FROM articles) SELECT n AS row_count, u AS duplicate_urls, {pct('u', 'n')} AS duplicate_url_pct, b AS duplicate_url_titles, {pct('b', 'n')} AS duplicate_url_title_pct FROM c")
def duplicate_summary(spark, sf):
    return P.duplicate_summary(articles(spark, sf), "url_key", "title_key")


@query(f"WITH {ARTICLES}, k AS (SELECT title_key, count(*) AS n FROM articles WHERE title IS NOT NULL GROUP BY 1) SELECT sum(n)::BIGINT AS non_null_titles, count(*) AS unique_titles, (sum(n) - count(*))::BIGINT AS duplicate_titles, {pct('(sum(n) - count(*))', 'sum(n)')} AS duplicate_pct FROM k")
def title_duplicates(spark, sf):
    return A.normalized_title_duplicates(articles(spark, sf), "title")


_STAMP = "yyyy-MM-dd HH:mm:ss"


def _stamps(spark, sf):
    """Event times as text, some missing and some that can't be read."""
    at = F.date_format("ts", _STAMP)
    return table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 50 == 0, None).when(F.col("event_id") % 33 == 0, "not a date").otherwise(at).alias("at"))


_STAMPS_SQL = "WITH s AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 33 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp FROM events), p AS (SELECT stamp, try_strptime(stamp, '%Y-%m-%d %H:%M:%S') AS t FROM s)"


@query(f"{_STAMPS_SQL} SELECT count(*) AS row_count, count(*) FILTER (stamp IS NULL) AS missing_count, count(*) FILTER (stamp IS NOT NULL AND t IS NULL) AS invalid_count, {pct('count(t)', 'count(*)')} AS parse_pct, min(t) AS min_ts, max(t) AS max_ts FROM p")
def datetime_audit(spark, sf):
    return A.datetime_audit(_stamps(spark, sf), "at", [_STAMP]).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("min_ts", "max_ts")})


@query("SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS records FROM orders GROUP BY 1")
def records_by_year(spark, sf):
    return A.records_by(table(spark, sf, "orders"), F.col("o_orderdate"), "yyyy", "year")


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS records FROM orders GROUP BY 1")
def records_by_month(spark, sf):
    return A.records_by(table(spark, sf, "orders"), F.col("o_orderdate"), "yyyy-MM", "month")


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS records FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 12")
def last_months(spark, sf):
    return A.records_by(table(spark, sf, "orders"), F.col("o_orderdate"), "yyyy-MM", "month").orderBy(F.desc("month")).limit(12).orderBy("month")


@query("SELECT coalesce(nullif(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)), '^www\\.', ''), ''), '<INVALID_OR_MISSING>') AS domain, count(*) AS count FROM pages WHERE url IS NOT NULL GROUP BY 1")
def domain_counts(spark, sf):
    return A.domain_counts(table(spark, sf, "pages"), "url")


def candles(spark, sf):
    """Daily prices from events, with faults put in by day."""
    e = table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.min_by("value", F.struct("ts", "event_id")).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", F.struct("ts", "event_id")).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"))
    k = F.substring("day", 9, 2).cast("int")
    return e.select(
        F.when(k % 11 == 0, 0.0).otherwise(F.col("open")).alias("open"),
        F.when(k % 5 == 0, F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        F.when(k % 7 == 0, F.col("close") + 1).otherwise(F.col("low")).alias("low"),
        "close",
        F.when(k % 6 == 0, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
        F.when(k % 4 == 0, F.lit(1.0)).otherwise(F.try_divide(F.col("close") - F.col("open"), F.col("open")) * 100).alias("movement"),
    )


@query(f"""WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, arg_min(value, (ts, event_id)) AS o, max(value) AS h, min(value) AS l, arg_max(value, (ts, event_id)) AS c, count(*)::DOUBLE AS v FROM events GROUP BY 1, 2),
    k AS (SELECT *, substr(day, 9, 2)::INT AS k FROM e),
    x AS (SELECT CASE WHEN k % 11 = 0 THEN 0.0 ELSE o END AS open, CASE WHEN k % 5 = 0 THEN l - 1 ELSE h END AS high, CASE WHEN k % 7 = 0 THEN c + 1 ELSE l END AS low, c AS close, CASE WHEN k % 6 = 0 THEN -v ELSE v END AS volume,
                 CASE WHEN k % 4 = 0 THEN 1.0 ELSE (c - o) / nullif(o, 0) * 100 END AS movement FROM k),
    y AS (SELECT *, open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL AS ok, (close - open) / nullif(open, 0) * 100 AS want FROM x),
    r AS (SELECT 'non_positive_price' AS check_name, count(*) FILTER (ok AND least(open, high, low, close) <= 0) AS violations, count(*) AS denominator FROM y
    UNION ALL SELECT 'negative_volume', count(*) FILTER (volume < 0), count(*) FROM y
    UNION ALL SELECT 'high_below_others', count(*) FILTER (ok AND high < greatest(open, low, close)), count(*) FILTER (ok AND volume IS NOT NULL) FROM y
    UNION ALL SELECT 'low_above_others', count(*) FILTER (ok AND low > least(open, high, close)), count(*) FILTER (ok AND volume IS NOT NULL) FROM y
    UNION ALL SELECT 'movement_mismatch', count(*) FILTER (movement IS NOT NULL AND want IS NOT NULL AND abs(movement - want) > 1e-3 + 1e-3 * abs(want)), count(*) FILTER (movement IS NOT NULL AND want IS NOT NULL) FROM y)
    SELECT *, {pct('violations', 'denominator')} AS violation_pct FROM r""")
def ohlcv_sanity(spark, sf):
    return A.ohlcv_sanity(candles(spark, sf))


def _quality_sql(name: str, source: str) -> str:
    t, raw = sql_filled(name), f"coalesce({name}, '')"
    flag = lambda p: pct(f"count(*) FILTER (regexp_matches({raw}, '{p}'))", "count(*)")
    return f"""SELECT '{name}' AS column_name, count(*) AS row_count, count(*) - count({name}) AS null_count, count(*) FILTER ({name} IS NOT NULL AND {t} = '') AS blank_count,
        median(CASE WHEN {t} <> '' THEN len({t}) END) AS median_chars, avg(CASE WHEN {t} <> '' THEN len({t}) END) AS mean_chars, median(CASE WHEN {t} <> '' THEN len({sql_words(t)}) END) AS median_words,
        {flag('<[^>]+>')} AS html_like_pct, {flag('(?i)(https?://|www[.])')} AS url_like_pct, {flag(WS + WS)} AS repeated_ws_pct FROM {source}"""


@query(f"SELECT * REPLACE (round(mean_chars, 6) AS mean_chars) FROM ({_quality_sql('html', 'pages')} UNION ALL {_quality_sql('url', 'pages')})")
def text_quality(spark, sf):
    return A.text_quality(table(spark, sf, "pages"), ["html", "url"]).withColumn("mean_chars", F.round("mean_chars", 6))


_NUMS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std, min({c}::DOUBLE) AS min, " + ", ".join(f"round(quantile_cont({c}::DOUBLE, {p}), 6) AS p{round(100 * p):02d}" for p in (0.01, 0.05, 0.5, 0.95, 0.99)) + f", max({c}::DOUBLE) AS max, count(*) - count({c}) AS missing, 0.0::DOUBLE AS missing_pct FROM lineitem" for c in _NUMS))
def numeric_summary(spark, sf):
    out = A.numeric_summary(table(spark, sf, "lineitem"), _NUMS)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std")} | {c: F.round(c, 6) for c in ("p01", "p05", "p50", "p95", "p99")})


def _comparison_sql(name: str) -> str:
    return f"""SELECT '{name}' AS representation, count(*) AS row_count, count(*) FILTER (n) AS null_count, {pct('count(*) FILTER (n)', 'count(*)')} AS null_pct, count(*) FILTER (e) AS empty_count, {pct('count(*) FILTER (e)', 'count(*)')} AS empty_pct,
        count(*) FILTER (NOT e) AS nonempty_count, {pct('count(*) FILTER (NOT e)', 'count(*)')} AS nonempty_pct, median(w) AS median_word_count, round(quantile_cont(w, 0.95), 6) AS p95_word_count, max(w) AS max_word_count,
        median(c) AS median_character_count, round(quantile_cont(c, 0.95), 6) AS p95_character_count, max(c) AS max_character_count, count(*) FILTER (NOT e AND w <= 3) AS very_short_word_count, {pct('count(*) FILTER (NOT e AND w <= 3)', 'count(*) FILTER (NOT e)')} AS very_short_word_pct_nonempty,
        count(*) FILTER (NOT e AND c <= 20) AS very_short_character_count, {pct('count(*) FILTER (NOT e AND c <= 20)', 'count(*) FILTER (NOT e)')} AS very_short_character_pct_nonempty
        FROM (SELECT {name} IS NULL AS n, {sql_filled(name)} = '' AS e, len({sql_filled(name)}) AS c, {sql_count(sql_filled(name), SQL_WORD)} AS w FROM articles)"""


@query(f"WITH {ARTICLES} {_comparison_sql('full_text')} UNION ALL {_comparison_sql('description')}")
def representation_comparison(spark, sf):
    return R.representation_comparison(articles(spark, sf), ["full_text", "description"]).withColumns({c: F.round(c, 6) for c in ("p95_word_count", "p95_character_count")})


def records(spark, sf):
    """Pages as records: the heading is the title, the host the release, the page id the text."""
    heading = F.regexp_extract("html", r"<h1>([^<]*)</h1>", 1)
    p = table(spark, sf, "pages").select(
        heading.alias("title"),
        F.lit("").alias("description"),
        F.concat(heading, F.lit(" "), F.col("page_id").cast("string")).alias("full_text"),
        F.concat(F.lit("2024-"), (F.col("page_id") % 200).cast("string")).alias("release_number"),
        F.when(F.col("page_id") % 9 == 0, "soon").otherwise(F.date_format(F.date_add(F.lit("2024-01-01"), (F.col("page_id") % 300).cast("int")), "yyyy-MM-dd")).alias("published_at"),
        F.lit(None).cast("string").alias("last_reviewed_at"),
        "url",
        F.lit(None).cast("string").alias("canonical_url"),
        F.array(F.lit("b"), F.lit("a"), F.lit("b")).alias("matched_keywords"),
        F.lit(3).alias("keyword_count"),
        (F.col("page_id") % 10 != 0).alias("is_related"),
    )
    return I.normalize_record(p, source="S", source_type="news", method="http", mode="live_http", scraped_at="2025-01-01T00:00:00")


_RECORDS = f"""p AS (SELECT regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h, * FROM pages),
    q AS (SELECT {sql_strip('h')} AS title, {sql_strip("(h || ' ' || page_id)")} AS full_text, '2024-' || page_id % 200 AS release_number, CASE WHEN page_id % 9 = 0 THEN 'soon' ELSE strftime(DATE '2024-01-01' + (page_id % 300)::INT, '%Y-%m-%d') END AS published_at, url, page_id % 10 <> 0 AS rel FROM p),
    records AS (SELECT 'sec_' || replace(release_number, '-', '_') AS source_row_id, 'sec_' || replace(release_number, '-', '_') AS document_id, 'S' AS source, 'news' AS source_type, release_number, title, '' AS description, full_text, published_at, NULL::VARCHAR AS last_reviewed_at, url, url AS canonical_url,
        'Bitcoin' AS coin_type, 'en' AS language, 'http' AS ingestion_method, 'live_http' AS collection_mode, 'complete_page_body' AS body_text_status, true AS full_text_is_complete, true AS source_verified, '2025-01-01T00:00:00' AS scraped_at, sha256(title || chr(10) || full_text) AS content_hash, 200 AS http_status, 3 AS bitcoin_keyword_count, 'a|b' AS matched_keywords,
        len({sql_words('full_text')})::INT AS word_count, len(full_text)::INT AS character_count, rel AS is_bitcoin_related FROM q)"""


@query(f"WITH {_RECORDS} SELECT * FROM records")
def normalize_record(spark, sf):
    return records(spark, sf)


def _metric(name: str, value: str) -> str:
    return f"SELECT '{name}' AS metric, ({value})::VARCHAR AS value FROM d"


@query(f"WITH {_RECORDS}, d AS (SELECT *, try_strptime(published_at, '%Y-%m-%d') AS stamp FROM records) " + " UNION ALL ".join(_metric(*x) for x in (
    ("row_count", "count(*)"), ("unique_release_numbers", "count(DISTINCT release_number)"), ("duplicate_source_row_ids", "count(*) - count(DISTINCT source_row_id)"), ("duplicate_canonical_urls", "count(*) - count(DISTINCT canonical_url)"), ("duplicate_content_hashes", "count(*) - count(DISTINCT content_hash)"),
    ("missing_titles", "count(*) FILTER (title = '')"), ("missing_full_text", "count(*) FILTER (full_text = '')"), ("invalid_published_dates", "count(*) FILTER (stamp IS NULL)"), ("median_word_count", "trunc(median(word_count))::BIGINT"), ("min_word_count", "min(word_count)"), ("max_word_count", "max(word_count)"),
    ("oldest_publication_date", "strftime(min(stamp), '%Y-%m-%d')"), ("newest_publication_date", "strftime(max(stamp), '%Y-%m-%d')"))))
def quality_report(spark, sf):
    return I.quality_report(records(spark, sf))


@query(f"WITH {_RECORDS}, d AS (SELECT *, try_strptime(published_at, '%Y-%m-%d') AS stamp FROM records) SELECT 'completed' AS status, 'live_http' AS collection_mode, count(*) AS records, 2 AS failures, strftime(min(stamp), '%Y-%m-%d') AS oldest_publication_date, strftime(max(stamp), '%Y-%m-%d') AS newest_publication_date, median(word_count) AS median_word_count, bool_and(is_bitcoin_related) AS all_bitcoin_related, count(*) = count(DISTINCT source_row_id) AS source_row_id_unique, count(*) = count(DISTINCT canonical_url) AS canonical_url_unique, count(*) = count(DISTINCT content_hash) AS content_hash_unique FROM d")
def scrape_summary(spark, sf):
    return I.scrape_summary(records(spark, sf), failures=2, mode="live_http")


@query(f"WITH {_RECORDS} " + " UNION ALL ".join(f"SELECT '{k}' AS check_name, {v} AS passed FROM records" for k, v in (
    ("has_rows", "count(*) > 0"), ("id_not_missing", "count(*) = count(source_row_id)"), ("id_unique", "count(*) = count(DISTINCT source_row_id)"), ("url_unique", "count(*) = count(DISTINCT canonical_url)"), ("content_unique", "count(*) = count(DISTINCT content_hash)"), ("all_related", "bool_and(is_bitcoin_related)"), ("title_not_empty", "count(*) FILTER (title = '') = 0"), ("text_not_empty", "count(*) FILTER (full_text = '') = 0"))))
def frame_assertions(spark, sf):
    return I.frame_assertions(records(spark, sf))


@query(f"WITH {ARTICLES} " + " UNION ALL ".join(f"SELECT '{k}' AS metric, ({v})::BIGINT AS value FROM articles" for k, v in (
    ("row_count", "count(*)"), ("empty_title", f"count(*) FILTER ({sql_filled('title')} = '')"), ("empty_description", f"count(*) FILTER ({sql_filled('description')} = '')"), ("empty_text", f"count(*) FILTER ({sql_filled('full_text')} = '')"), ("all_text_empty", f"count(*) FILTER ({sql_filled('title')} = '' AND {sql_filled('description')} = '' AND {sql_filled('full_text')} = '')"),
    ("missing_url", "count(*) FILTER (url_key = '')"), ("duplicate_urls", "count(*) FILTER (url_key <> '') - count(DISTINCT url_key) FILTER (url_key <> '')"), ("duplicate_row_ids", "count(source_row_id) - count(DISTINCT source_row_id)"), ("missing_row_ids", "count(*) - count(source_row_id)"))))
def validation_summary(spark, sf):
    return P.validation_summary(articles(spark, sf), url_key="url_key", title="title", description="description", text="full_text", row_id="source_row_id")


_TEXTS = ["title", "description", "full_text"]


def _dedup(df: DataFrame) -> DataFrame:
    return P.dedup_articles(df, url_key="url_key", title_key="title_key", description_key="description_key", texts=_TEXTS)


_RANKED = f"""{ARTICLES}, keyed AS (SELECT *, CASE WHEN url_key <> '' THEN 'u:' || url_key WHEN title_key <> '' AND description_key <> '' THEN 't:' || title_key || chr(1) || description_key ELSE 'i:' || source_row_id END AS k,
        {' + '.join(f"({sql_filled(c)} <> '')::INT" for c in _TEXTS)} AS fields, {' + '.join(f'len({sql_filled(c)})' for c in _TEXTS)} AS chars FROM articles),
    best AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY k ORDER BY fields DESC, chars DESC, source_row_id) = 1)"""


@query(f"WITH {_RANKED} SELECT source_row_id, url_key FROM best WHERE url_key <> ''")
def dedup_by_url(spark, sf):
    return _dedup(articles(spark, sf).where("url_key <> ''")).select("source_row_id", "url_key")


@query(f"WITH {_RANKED} SELECT source_row_id, title_key FROM best WHERE url_key = '' AND title_key <> '' AND description_key <> ''")
def dedup_fallback(spark, sf):
    return _dedup(articles(spark, sf).where("url_key = '' and title_key <> '' and description_key <> ''")).select("source_row_id", "title_key")


@query(f"WITH {_RANKED} SELECT source_row_id, url_key, title_key FROM best")
def dedup_full(spark, sf):
    return _dedup(articles(spark, sf)).select("source_row_id", "url_key", "title_key")


@query(f"WITH {_RANKED}, c AS (SELECT 0 AS position, 'scanned' AS stage, count(*) AS rows FROM articles UNION ALL SELECT 1, 'english', count(*) FROM articles WHERE lang = 'en' UNION ALL SELECT 2, 'usable', count(*) FROM articles WHERE lang = 'en' AND {sql_filled('full_text')} <> '') SELECT *, coalesce(lag(rows) OVER (ORDER BY position) - rows, 0) AS removed FROM c")
def pipeline_accounting(spark, sf):
    a = articles(spark, sf)
    en = P.filter_language(a, F.col("lang"))
    return P.accounting([("scanned", a), ("english", en), ("usable", P.usable_text(en, ["full_text"]))])


@query(f"SELECT coalesce(lang, 'unknown') AS language, count(*) AS rows, {pct('count(*)', '(SELECT count(*) FROM documents)')} AS pct FROM documents GROUP BY 1")
def language_distribution(spark, sf):
    return A.language_distribution(docs(spark, sf), "lang")


_MERGE = """both_ AS (SELECT doc_id AS ingest_seq, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE source || '-' || doc_id % 40 END AS release_number, lang || doc_id % 90 AS canonical_url, md5(text) AS content_hash FROM documents),
    a AS (SELECT * FROM both_ QUALIFY row_number() OVER (PARTITION BY release_number ORDER BY ingest_seq DESC) = 1),
    b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY ingest_seq DESC) = 1)"""


@query(f"WITH {_MERGE} SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY ingest_seq DESC) = 1")
def merge_incremental(spark, sf):
    d = docs(spark, sf).select(F.col("doc_id").alias("ingest_seq"), F.when(F.col("doc_id") % 7 != 0, F.concat("source", F.lit("-"), (F.col("doc_id") % 40).cast("string"))).alias("release_number"), F.concat("lang", (F.col("doc_id") % 90).cast("string")).alias("canonical_url"), F.md5("text").alias("content_hash"))
    return I.merge_incremental(d.where("ingest_seq % 2 = 0"), d.where("ingest_seq % 2 = 1"))


@query("SELECT page_id, release_number, url FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'r' || page_id % 60 END AS release_number, url, page_id % 5 AS page FROM pages) QUALIFY row_number() OVER (PARTITION BY coalesce(release_number, url) ORDER BY page, page_id) = 1")
def candidate_dedup(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 4 != 0, F.concat(F.lit("r"), (F.col("page_id") % 60).cast("string"))).alias("release_number"), "url", (F.col("page_id") % 5).alias("page"), F.col("page_id").alias("position"))
    return I.dedup_candidates(p).select("page_id", "release_number", "url")


@query("SELECT coalesce(sum(n), 0)::BIGINT AS rows_in_duplicate_groups, count(*) AS duplicate_groups FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)")
def duplicate_rows_all(spark, sf):
    return A.duplicate_rows_all(docs(spark, sf), ["text"])


@query("WITH s AS (SELECT o_custkey, lag(o_custkey) OVER (ORDER BY o_orderkey) AS p FROM orders) SELECT count(*) AS row_count, count(*) FILTER (o_custkey < p) AS decreases, count(*) FILTER (o_custkey < p) = 0 AS is_monotonic FROM s")
def id_monotonic(spark, sf):
    return A.id_monotonic(table(spark, sf, "orders"), "o_orderkey", "o_custkey")


@query("SELECT source AS value, count(*) AS count FROM documents GROUP BY 1 ORDER BY count DESC, value LIMIT 5")
def top_counts(spark, sf):
    return A.top_counts(docs(spark, sf), "source", 5)


@query(f"WITH m AS (SELECT doc_id, len({sql_filled('text')}) AS length FROM documents WHERE {sql_filled('text')} <> '') (SELECT *, 'shortest' AS kind FROM m ORDER BY length, doc_id LIMIT 5) UNION ALL (SELECT *, 'longest' FROM m ORDER BY length DESC, doc_id LIMIT 5)")
def shortest_longest(spark, sf):
    return S.shortest_longest(docs(spark, sf), "doc_id", "text")


@query()
def priority_sample(spark, sf):
    return S.priority_sample(docs(spark, sf).select("doc_id", "lang"), 100, "doc_id")


@query()
def smoke_sample(spark, sf):
    return S.smoke_sample(articles(spark, sf).select("source_row_id", "description", "full_text"), 100, "source_row_id", ["description", "full_text"])


@query()
def smoke_sample_capped(spark, sf):
    return S.smoke_sample_capped(articles(spark, sf).select("source_row_id", "description", "full_text"), 100, "source_row_id", ["description", "full_text"], 5)


def _reports(spark, sf) -> dict[str, DataFrame | None]:
    """Reports of three kinds: rows of documents by language, of embeddings, and none of a fourth."""
    rows = docs(spark, sf).groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_chars").cast("double").alias("memory_mb"))
    tfidf = rows.select(F.col("lang").alias("representation"), F.lit("word").alias("method"), "rows", F.lit(6000).alias("dimensions"), "memory_mb", F.lit(True).alias("finite_values"))
    dense = table(spark, sf, "embeddings").agg(F.lit("dense").alias("representation"), F.lit("pca").alias("method"), F.count(F.lit(1)).alias("rows"), F.max(F.size("embedding")).alias("dimensions"), F.bool_and(E.finite(F.col("embedding"))).alias("finite_values"))
    return {"row_features": rows.select(F.lit("both").alias("representation"), "rows"), "tfidf": tfidf, "encoder": None, "reduction": dense}


@query("""WITH r AS (SELECT lang, count(*) AS n, sum(n_chars)::DOUBLE AS c FROM documents GROUP BY 1),
    u AS (SELECT '04_01' AS stage, 'row_level_manual' AS method_family, 'both' AS representation, NULL AS method, n AS rows, NULL::BIGINT AS dimensions, 'dense_parquet' AS storage, NULL::DOUBLE AS memory_mb, NULL::BOOLEAN AS finite_values, 'row_local_full_dataset' AS fit_scope FROM r
    UNION ALL SELECT '04_02', 'tfidf', lang, 'word', n, 6000, 'csr_sparse_npz', c, true, 'smoke_sample_only' FROM r
    UNION ALL SELECT '04_03', 'dimensionality_reduction', 'dense', 'pca', count(*), max(len(embedding)), 'dense_float32_npy', NULL, bool_and(len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0), 'train_rows_only' FROM embeddings)
    SELECT *, NULL::DOUBLE AS elapsed_seconds, 'not_evaluated_in_phase4' AS semantic_quality_status FROM u""")
def method_benchmark(spark, sf):
    return G.method_benchmark(spark, _reports(spark, sf))


# ---------------------------------------------------------------- text and other scalars


@query()
def clean_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.clean_text("html").alias("cleaned"))


@query(f"""SELECT doc_id, {sql_strip("regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '</?[A-Za-z][^>]*>', ' ', 'g'), '[" + chr(92) + "x{200b}" + chr(92) + "x{200c}" + chr(92) + "x{200d}" + chr(92) + "x{feff}]', '', 'g'), '" + WS + "+', ' ', 'g')")} AS cleaned FROM documents""")
def clean_text_ascii(spark, sf):
    return docs(spark, sf).select("doc_id", X.clean_ascii("text").alias("cleaned"))


@query()
def title_key(spark, sf):
    return articles(spark, sf).select("source_row_id", X.title_key("title").alias("title_key"))


@query(f"WITH {ARTICLES} SELECT source_row_id, array_to_string(list_filter([{sql_filled('title')}, {sql_filled('description')}], lambda x: x <> ''), ' ') AS combined FROM articles")
def combine_fields(spark, sf):
    return articles(spark, sf).select("source_row_id", X.combined("title", "description").alias("combined"))


@query(f"""SELECT doc_id, {sql_strip("regexp_replace(text, '" + WS + "+', ' ', 'g')")} AS collapsed FROM documents""")
def collapse_ws(spark, sf):
    return docs(spark, sf).select("doc_id", X.collapse_ws("text").alias("collapsed"))


_T = sql_filled("text")


@query(f"SELECT doc_id, (text IS NULL)::TINYINT AS is_null, ({_T} = '')::TINYINT AS is_empty, len({_T})::INT AS character_count, {sql_count(_T, SQL_WORD)}::INT AS word_count FROM {BLANKED}")
def length_metrics(spark, sf):
    return blanked(spark, sf).select("doc_id", *[v.alias(k) for k, v in X.length_metrics("text").items()])


@query(f"SELECT doc_id, len({sql_words('text')})::INT AS words FROM documents")
def word_split_count(spark, sf):
    return docs(spark, sf).select("doc_id", F.size(X.split_words("text")).alias("words"))


def _count_query(name: str, spark_pattern: str, sql_pattern: str) -> None:
    def run(spark, sf):
        return docs(spark, sf).select("doc_id", X.count(X.filled("text"), spark_pattern).alias("n"))

    run.__name__ = name
    query(f"SELECT doc_id, {sql_count(_T, sql_pattern)}::INT AS n FROM documents")(run)


_count_query("number_count", X.NUMBER, NUMBER)
_count_query("percentage_count", X.PERCENT, PERCENT)
_count_query("currency_count", CURRENCY, CURRENCY)


@query(f"SELECT doc_id, round(coalesce({sql_count(_T, '[A-Z]')}::DOUBLE / nullif({sql_count(_T, '[A-Za-z]')}, 0), 0.0), 6) AS ratio FROM documents")
def uppercase_ratio(spark, sf):
    t = X.filled("text")
    return docs(spark, sf).select("doc_id", F.round(F.coalesce(F.try_divide(X.count(t, "[A-Z]").cast("double"), X.count(t, "[A-Za-z]")), F.lit(0.0)), 6).alias("ratio"))


@query(f"SELECT doc_id, {sql_count(_T, chr(92) + '?')}::INT AS questions, {sql_count(_T, '!')}::INT AS exclamations FROM documents")
def punct_counts(spark, sf):
    return docs(spark, sf).select("doc_id", X.count(X.filled("text"), r"\?").alias("questions"), X.count(X.filled("text"), "!").alias("exclamations"))


def _group_sql(words: list[str], c: str) -> str:
    return "(" + " + ".join(sql_count(c, sql_keyword(k)) for k in words) + ")"


@query("SELECT doc_id, " + ", ".join(f"{_group_sql(v, _T)}::INT AS {k}_count, ({_group_sql(v, _T)} > 0)::TINYINT AS {k}_present" for k, v in LEXICON.items()) + " FROM documents")
def keyword_groups(spark, sf):
    t = X.filled("text")
    return docs(spark, sf).select("doc_id", *[c for k, v in LEXICON.items() for c in (X.keyword_count(t, v).alias(f"{k}_count"), (X.keyword_count(t, v) > 0).cast("byte").alias(f"{k}_present"))])


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {sql_count('text', sql_keyword(k))} > 0 THEN '{k}' END" for k in _HITS) + "], lambda x: x IS NOT NULL), ',') AS matched, " + _group_sql(_HITS, "text") + "::INT AS hits FROM documents")
def keyword_hits(spark, sf):
    found, n = X.keyword_hits(F.col("text"), _HITS)
    return docs(spark, sf).select("doc_id", F.array_join(found, ",").alias("matched"), n.alias("hits"))


def _features_sql(name: str, prefix: str) -> list[str]:
    t = sql_filled(name)
    out = {
        "is_empty": f"({t} = '')::TINYINT", "character_count": f"len({t})::INT", "word_count": f"{sql_count(t, SQL_WORD)}::INT", "number_count": f"{sql_count(t, NUMBER)}::INT", "percentage_count": f"{sql_count(t, PERCENT)}::INT", "currency_symbol_count": f"{sql_count(t, CURRENCY)}::INT",
        "uppercase_character_count": f"{sql_count(t, '[A-Z]')}::INT", "alphabetic_character_count": f"{sql_count(t, '[A-Za-z]')}::INT", "uppercase_ratio": f"round(coalesce({sql_count(t, '[A-Z]')}::DOUBLE / nullif({sql_count(t, '[A-Za-z]')}, 0), 0.0)::FLOAT::DOUBLE, 5)",
        "question_mark_count": f"{sql_count(t, chr(92) + '?')}::INT", "exclamation_mark_count": f"{sql_count(t, '!')}::INT",
    }
    for k, v in LEXICON.items():
        out[f"keyword_{k}_count"], out[f"keyword_{k}_present"] = f"{_group_sql(v, t)}::INT", f"({_group_sql(v, t)} > 0)::TINYINT"
    out["financial_keyword_count"] = f"({' + '.join(_group_sql(v, t) for v in LEXICON.values())})::INT"
    return [f"{v} AS {prefix}__{k}" for k, v in out.items()]


@query(f"WITH {ARTICLES} SELECT source_row_id, {', '.join(_features_sql('full_text', 'body') + _features_sql('description', 'description'))} FROM articles")
def row_features(spark, sf):
    out = R.row_features(articles(spark, sf), id_column="source_row_id", prefixes={"full_text": "body", "description": "description"}, groups=LEXICON)
    return out.withColumns({c: F.round(F.col(c).cast("double"), 5) for c in out.columns if c.endswith("uppercase_ratio")})


@query("SELECT doc_id, 'sec_' || replace('2024-' || doc_id, '-', '_') AS document_id FROM documents")
def doc_id_build(spark, sf):
    return docs(spark, sf).select("doc_id", I.document_id(F.concat(F.lit("2024-"), F.col("doc_id").cast("string"))).alias("document_id"))


@query(f"WITH {ARTICLES} SELECT source_row_id, sha256({sql_filled('title')} || chr(10) || {sql_filled('full_text')}) AS content_hash FROM articles")
def content_hash(spark, sf):
    return articles(spark, sf).select("source_row_id", X.content_hash("title", "full_text").alias("content_hash"))


def _twins(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    bare = F.regexp_replace("url", r"[?#].*$", "")
    return p.unionByName(p.select((F.col("page_id") + 1000000).alias("page_id"), F.concat(bare, F.lit("?utm_source=x")).alias("url")))


@query(r"""WITH t AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id + 1000000, regexp_replace(url, '[?#].*$', '') || '?utm_source=x' FROM pages),
    p AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z]+)://', 1) AS s, regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) AS h, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS q FROM t),
    k AS (SELECT *, array_to_string(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_|(fbclid|gclid|mc_cid|mc_eid)=)')), '&') AS kept FROM p)
    SELECT page_id, lower(s) || '://' || lower(h) || CASE WHEN path = '/' THEN path ELSE rtrim(path, '/') END || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical FROM k""")
def canonical_url(spark, sf):
    return _twins(spark, sf).select("page_id", U.canonical_url("url").alias("canonical"))


@query()
def listing_links(spark, sf):
    spark.udtf.register("lexflume_listing", H.listing_function())
    table(spark, sf, "pages").createOrReplaceTempView("lexflume_pages")
    return spark.sql("SELECT page_id, l.* FROM lexflume_pages, LATERAL lexflume_listing(html, url, cast(page_id AS int), '^/[A-Za-z]+') l")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN NULL ELSE strftime(DATE '2020-01-01' + (doc_id % 2000)::INT, '%Y-%m-%d') END AS parsed FROM documents")
def parse_dates(spark, sf):
    day = F.date_add(F.lit("2020-01-01"), (F.col("doc_id") % 2000).cast("int"))
    text = F.when(F.col("doc_id") % 3 == 0, F.date_format(day, "yyyy-MM-dd")).when(F.col("doc_id") % 3 == 1, F.lit("no date here")).otherwise(F.concat(F.lit("On "), F.date_format(day, "MMMM d, yyyy")))
    return docs(spark, sf).select("doc_id", H.parse_date(text).alias("parsed"))


@query("SELECT event_id, try_cast(CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE value::VARCHAR END AS DOUBLE) AS number FROM events")
def numeric_coerce(spark, sf):
    return table(spark, sf, "events").select("event_id", F.expr("try_cast(CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE cast(value AS string) END AS double)").alias("number"))


@query("SELECT event_id, len(json_keys(props))::INT AS n_keys, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM events")
def json_props(spark, sf):
    keys = F.json_object_keys("props")
    return table(spark, sf, "events").select("event_id", F.size(keys).alias("n_keys"), F.array_join(F.array_sort(keys), ",").alias("keys"))


def _states(spark, sf):
    v = table(spark, sf, "embeddings")
    head = lambda a, b: F.transform(F.slice("embedding", a, b), lambda x: x.cast("double"))
    return v.select("vec_id", F.array(head(1, 4), head(5, 4), head(9, 4)).alias("states"), F.array(F.lit(1.0), F.lit(1.0), (F.col("vec_id") % 2).cast("double")).alias("mask"))


@query("SELECT vec_id, " + ", ".join(f"round((embedding[{k}]::DOUBLE + embedding[{k + 4}]::DOUBLE + (vec_id % 2) * embedding[{k + 8}]::DOUBLE) / (2 + vec_id % 2), 6) AS x{k}" for k in range(1, 5)) + " FROM embeddings")
def masked_mean_pool(spark, sf):
    pooled = _states(spark, sf).select("vec_id", E.masked_mean_pool(F.col("states"), F.col("mask")).alias("p"))
    return pooled.select("vec_id", *[F.round(F.element_at("p", k), 6).alias(f"x{k}") for k in range(1, 5)])


@query("SELECT vec_id, " + ", ".join(f"round(embedding[{k}]::DOUBLE, 6) AS x{k}" for k in range(1, 5)) + " FROM embeddings")
def cls_pool(spark, sf):
    pooled = _states(spark, sf).select("vec_id", E.cls_pool(F.col("states")).alias("p"))
    return pooled.select("vec_id", *[F.round(F.element_at("p", k), 6).alias(f"x{k}") for k in range(1, 5)])


_ID2LABEL = {0: "positive", 1: "negative", 2: "neutral"}


def _probabilities(spark, sf):
    logits = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double"))
    soft = table(spark, sf, "embeddings").select("vec_id", E.softmax(logits).alias("p"))
    return soft.select("vec_id", E.reordered(F.col("p"), _ID2LABEL).alias("s"))


_SOFT = "s AS (SELECT vec_id, exp(embedding[1]::DOUBLE) AS a, exp(embedding[2]::DOUBLE) AS b, exp(embedding[3]::DOUBLE) AS c FROM embeddings)"


@query(f"WITH {_SOFT} SELECT vec_id, round(a / (a + b + c), 6) AS positive, round(c / (a + b + c), 6) AS neutral, round(b / (a + b + c), 6) AS negative FROM s")
def softmax_reorder(spark, sf):
    return _probabilities(spark, sf).select("vec_id", *[F.round(f"s.{x}", 6).alias(x) for x in E.LABELS])


@query(f"WITH {_SOFT} SELECT round(avg(a / (a + b + c)), 6) AS mean_positive, round(avg(c / (a + b + c)), 6) AS mean_neutral, round(avg(b / (a + b + c)), 6) AS mean_negative, 0.0::DOUBLE AS max_sum_error FROM s")
def sentiment_summary(spark, sf):
    out = E.sentiment_summary(_probabilities(spark, sf), "s")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("WITH n AS (SELECT sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS l, len(embedding) AS d FROM embeddings) SELECT count(*) AS rows, max(d)::INT AS dimensions, round(avg(l), 6) AS norm_mean, round(stddev_pop(l), 6) AS norm_std, count(*) FILTER (l = 0) AS zero_rows, 0::BIGINT AS non_finite_rows FROM n")
def embedding_report(spark, sf):
    return E.embedding_report(table(spark, sf, "embeddings"), "embedding").withColumns({c: F.round(c, 6) for c in ("norm_mean", "norm_std")})


# ---------------------------------------------------------------- pages


def releases(spark, sf) -> DataFrame:
    """Pages of press releases in several layouts, and every seventh page as it came."""
    k = F.col("page_id")
    number, day = F.format_string("20%02d-%d", k % 30 + 10, k % 900 + 1), F.date_add(F.lit("2021-01-01"), (k % 700).cast("int"))
    date = F.when(k % 3 == 0, F.concat(F.lit("Washington D.C., "), F.date_format(day, "MMMM d, yyyy"), F.lit(" —"))).when((k % 3 == 1) | (k % 5 == 0), F.date_format(day, "MMM d, yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    body = F.concat(F.lit("<p>The court heard case "), k.cast("string"), F.lit(".</p>"))
    page = F.concat(F.lit("<html><head><link rel='canonical' href='/news/"), number, F.lit("'></head><body><main><h1>Release "), k.cast("string"), F.lit(" &amp; note</h1><p>A note on case "), k.cast("string"), F.lit("</p><p>For Immediate Release</p><p>"), F.when(k % 5 == 0, "no number").otherwise(number), F.lit("</p><p>"), date, F.lit("</p>"), body, body, F.lit("<script>var x</script><p>Resources</p><p>De rien.</p><p>###</p><p>The end</p></main></body></html>"))
    return table(spark, sf, "pages").select("page_id", F.when(k % 7 == 0, F.col("html")).otherwise(page).alias("html"), F.when(k % 7 == 0, F.col("url")).otherwise(F.concat(F.lit("https://x.org/news/press-release/"), number)).alias("url"), number.alias("release_number"), (k % 4).alias("page"), k.alias("position"))


RELEASES = """releases AS (SELECT page_id, '20' || printf('%02d', page_id % 30 + 10) || '-' || (page_id % 900 + 1) AS n, strftime(DATE '2021-01-01' + (page_id % 700)::INT, '%Y-%m-%d') AS day, 'Release ' || page_id || ' & note' AS title,
        'The court heard case ' || page_id || '. De rien.' AS body, 'A note on case ' || page_id AS note FROM pages WHERE page_id % 7 <> 0)"""


@query(f"""WITH {RELEASES} SELECT page_id, title, CASE WHEN page_id % 5 = 0 THEN '' ELSE note END AS description, body AS full_text, n AS release_number, day AS published_at, NULL::VARCHAR AS last_reviewed_at, 'https://x.org/news/press-release/' || n AS url, 'https://x.org/news/' || n AS canonical_url, 'the,de' AS matched_keywords, 2 AS keyword_count, true AS is_related, NULL::VARCHAR AS error FROM releases""")
def parse_article(spark, sf):
    parse = H.article_parser(["the", "de"])
    parsed = releases(spark, sf).where("page_id % 7 <> 0").select("page_id", parse("html", "url").alias("a")).select("page_id", "a.*")
    return parsed.withColumn("matched_keywords", F.array_join("matched_keywords", ","))


@query("SELECT url, 'parse' AS stage, 'release number not found' AS error FROM pages WHERE regexp_matches(html, '<h1>[^<]') AND NOT regexp_matches(html, '(19|20)[0-9]{2}-[0-9]') AND NOT regexp_matches(url, '(19|20)[0-9]{2}-[0-9]') AND page_id % 7 = 0")
def failed_rows(spark, sf):
    parse = H.article_parser(["the", "de"])
    parsed = releases(spark, sf).select(parse("html", "url").alias("a")).select("a.*")
    return I.failed_rows(parsed, "parse")[1]


@query(f"""WITH {RELEASES}, best AS (SELECT * FROM releases QUALIFY row_number() OVER (PARTITION BY n ORDER BY page_id % 4, page_id) = 1), made AS (SELECT * FROM best WHERE page_id % 6 <> 0)
    SELECT 'sec_' || replace(n, '-', '_') AS document_id, n AS release_number, title, body AS full_text, day AS published_at, sha256(title || chr(10) || body) AS content_hash, page_id % 6 = 0 AS known FROM best""")
def collection_run(spark, sf):
    """Two runs over the same listing, the second of which finds a sixth of its pages known."""
    pages = releases(spark, sf).where("page_id % 7 <> 0")
    first = I.dedup_candidates(pages).where("page_id % 6 = 0")
    old, _ = G.collected(first, keywords=["court"], scraped_at="2025-01-01T00:00:00")
    old = old.withColumn("url", F.concat(F.lit("https://x.org/news/press-release/"), "release_number"))
    both, _ = G.collected(I.dedup_candidates(pages), keywords=["court"], existing=old.withColumn("canonical_url", F.col("url")), scraped_at="2025-02-01T00:00:00")
    return both.select("document_id", "release_number", "title", "full_text", "published_at", "content_hash", (F.col("scraped_at") == "2025-01-01T00:00:00").alias("known"))


def raw_articles(spark, sf) -> DataFrame:
    """Documents as the raw article table: labels, URLs with trackers, and texts with tags."""
    k, line = F.col("doc_id"), lambda n: F.get(F.split("text", "\n"), F.lit(n))
    label = F.when(k % 3 == 0, "Bitcoin, Ethereum").when(k % 3 == 1, "['BTC']").otherwise("Bitcoin Cash")
    url = F.when(k % 4 != 0, F.concat(F.lit("HTTPS://X.org/"), (k % 50).cast("string"), F.lit("/?utm_source="), k.cast("string")))
    return docs(spark, sf).select(k.alias("source_row_id"), url.alias("URL"), F.concat(F.lit("<b>T "), (k % 40).cast("string"), F.lit("</b>")).alias("Title"), F.when(k % 8 != 0, F.concat(F.lit("D &amp; "), (k % 40).cast("string"))).alias("Description"), F.repeat(F.lit("x"), (k % 5).cast("int")).alias("Full Text"), label.alias("Coin Type"), "lang")


@query("""WITH r AS (SELECT doc_id AS source_row_id, CASE WHEN doc_id % 4 <> 0 THEN 'https://x.org/' || doc_id % 50 END AS u, 'T ' || doc_id % 40 AS t, CASE WHEN doc_id % 8 <> 0 THEN 'D & ' || doc_id % 40 ELSE '' END AS d, repeat('x', (doc_id % 5)::INT) AS f, lang FROM documents WHERE doc_id % 3 <> 2 AND lang = 'en'),
    k AS (SELECT *, CASE WHEN u IS NOT NULL THEN u WHEN d <> '' THEN lower(t) || '|' || lower(d) ELSE 'i' || source_row_id END AS k FROM r)
    SELECT source_row_id, t || CASE WHEN d <> '' THEN ' ' || d ELSE '' END AS text_title_description, f AS full_text_clean FROM k QUALIFY row_number() OVER (PARTITION BY k ORDER BY 1 + (d <> '')::INT + (f <> '')::INT DESC, len(t) + len(d) + len(f) DESC, source_row_id) = 1""")
def preprocess_articles(spark, sf):
    out, _ = G.preprocessed(raw_articles(spark, sf), labels=["bitcoin", "btc"], language=F.col("lang"))
    return out.select("source_row_id", "text_title_description", "full_text_clean")


def _stage_config() -> dict:
    own = {"input": {"representations": ["full_text", "nowhere"]}, "features": {"representation_prefixes": {"full_text": "body", "nowhere": "x"}}}
    config = C.merged(C.DEFAULTS, own)
    config["features"]["keyword_groups"] = LEXICON
    return config


@query(f"WITH {ARTICLES} SELECT {', '.join(['source_row_id', *_features_sql('full_text', 'body')])} FROM articles")
def stage1_pipeline(spark, sf):
    out = G.row_feature_stage(spark, articles(spark, sf), Y.shared_path(spark, "stage"), _stage_config()).output
    return out.withColumn("body__uppercase_ratio", F.round(F.col("body__uppercase_ratio").cast("double"), 5))


# ---------------------------------------------------------------- vectors


def _words_sql(n: int = 3000) -> str:
    return f"""s AS (SELECT doc_id, lower(strip_accents(coalesce(text, ''))) AS t FROM documents),
    w AS (SELECT doc_id, list_filter(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]+'), lambda x: len(x) >= 2) AS w FROM s),
    g AS (SELECT doc_id, unnest(w) AS term FROM w UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1)"""


def _chars_sql() -> str:
    grams = " UNION ALL ".join(f"SELECT doc_id, unnest(CASE WHEN len(p) <= {n} THEN {'[p]' if n == 3 else f'CASE WHEN len(p) < {n} THEN [] ELSE [p] END'} ELSE list_transform(range(1, len(p) - {n} + 2), lambda i: substr(p, i, {n})) END) AS term FROM w" for n in (3, 4, 5))
    return f"""s AS (SELECT doc_id, lower(strip_accents(coalesce(text, ''))) AS t FROM documents),
    w AS (SELECT doc_id, ' ' || unnest({sql_words('t')}) || ' ' AS p FROM s),
    g AS ({grams})"""


_FITTED = """f AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
    n AS (SELECT count(*) AS n FROM documents),
    m AS (SELECT term, ln((1.0 + n) / (1.0 + count(*))) + 1.0 AS idf FROM f, n GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.98 * n ORDER BY sum(tf) DESC, term LIMIT {limit}),
    r AS (SELECT doc_id, f.term, (1.0 + ln(tf)) * idf AS raw FROM f JOIN m ON f.term = m.term),
    x AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM r)"""


def _model(spark, sf, recipe):
    d = docs(spark, sf)
    return d, M.fit(d, "doc_id", "text", recipe)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query(f"WITH {_words_sql()}, {_FITTED.format(limit=6000)} SELECT doc_id, term, round(weight, 6) AS weight FROM x")
def tfidf_word_long(spark, sf):
    d, model = _model(spark, sf, M.WORD_RECIPE)
    return _rounded(M.transform(d, model, "doc_id", "text", M.WORD_RECIPE))


@query(f"WITH {_chars_sql()}, {_FITTED.format(limit=6000)} SELECT doc_id, term, round(weight, 6) AS weight FROM x")
def tfidf_char_long(spark, sf):
    d, model = _model(spark, sf, M.CHAR_RECIPE)
    return _rounded(M.transform(d, model, "doc_id", "text", M.CHAR_RECIPE))


_SMALL_WORD, _SMALL_CHAR = M.Recipe(max_features=300), M.Recipe("char_wb", 3, 5, max_features=300)


@query(f"SELECT doc_id, 'word__' || term AS term, round(weight, 6) AS weight FROM (WITH {_words_sql()}, {_FITTED.format(limit=300)} SELECT * FROM x) UNION ALL SELECT doc_id, 'char__' || term, round(weight, 6) FROM (WITH {_chars_sql()}, {_FITTED.format(limit=300)} SELECT * FROM x)")
def tfidf_combined(spark, sf):
    d, w = _model(spark, sf, _SMALL_WORD)
    c = M.fit(d, "doc_id", "text", _SMALL_CHAR)
    return _rounded(M.combined(d, "doc_id", "text", {"word": (_SMALL_WORD, w), "char": (_SMALL_CHAR, c)}))


@query(f"WITH {_words_sql()}, {_FITTED.format(limit=300)}, z AS (SELECT d.doc_id, count(x.term) AS nnz FROM documents d LEFT JOIN x ON d.doc_id = x.doc_id GROUP BY 1) SELECT count(*) AS rows, 300::BIGINT AS features, sum(nnz)::BIGINT AS nnz, round(100.0 * (1 - sum(nnz) / (count(*) * 300.0)), 6) AS sparsity_pct, count(*) FILTER (nnz = 0) AS zero_vectors, (sum(nnz) * 8 + (count(*) + 1) * 4)::BIGINT AS csr_bytes FROM z")
def tfidf_report(spark, sf):
    d, model = _model(spark, sf, _SMALL_WORD)
    return M.report(d, M.transform(d, model, "doc_id", "text", _SMALL_WORD), "doc_id", 300).withColumn("sparsity_pct", F.round("sparsity_pct", 6))


@query(f"SELECT doc_id, 'word__' || term AS term, round(weight, 6) AS weight FROM (WITH {_words_sql()}, {_FITTED.format(limit=6000)} SELECT * FROM x) UNION ALL SELECT doc_id, 'char__' || term, round(weight, 6) FROM (WITH {_chars_sql()}, {_FITTED.format(limit=6000)} SELECT * FROM x)")
def tfidf_combined_6000(spark, sf):
    d, w = _model(spark, sf, M.WORD_RECIPE)
    c = M.fit(d, "doc_id", "text", M.CHAR_RECIPE)
    return _rounded(M.combined(d, "doc_id", "text", {"word": (M.WORD_RECIPE, w), "char": (M.CHAR_RECIPE, c)}))


@query(f"WITH {_words_sql()}, {_FITTED.format(limit=6000)}, z AS (SELECT d.doc_id, count(x.term) AS nnz FROM documents d LEFT JOIN x ON d.doc_id = x.doc_id GROUP BY 1) SELECT count(*) AS rows, 6000::BIGINT AS features, sum(nnz)::BIGINT AS nnz, round(100.0 * (1 - sum(nnz) / (count(*) * 6000.0)), 6) AS sparsity_pct, count(*) FILTER (nnz = 0) AS zero_vectors, (sum(nnz) * 8 + (count(*) + 1) * 4)::BIGINT AS csr_bytes FROM z")
def tfidf_report_6000(spark, sf):
    d, model = _model(spark, sf, M.WORD_RECIPE)
    return M.report(d, M.transform(d, model, "doc_id", "text", M.WORD_RECIPE), "doc_id", M.WORD_RECIPE.max_features).withColumn("sparsity_pct", F.round("sparsity_pct", 6))


def _vectors(spark, sf) -> DataFrame:
    d, model = _model(spark, sf, M.WORD_RECIPE)
    return M.vectors(d, M.transform(d, model, "doc_id", "text", M.WORD_RECIPE), "doc_id", M.WORD_RECIPE.max_features)


@query()
def tfidf_roundtrip(spark, sf):
    path = Y.shared_path(spark, "tfidf")
    _vectors(spark, sf).write.parquet(path)
    return spark.read.parquet(path).select("doc_id", F.col("features").cast("string").alias("features"))


@query()
def pca_explained(spark, sf):
    model, _, _ = D.pca(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return spark.createDataFrame([(k, float(v)) for k, v in enumerate(model.explainedVariance.toArray())], "component int, explained_variance double")


@query()
def svd_explained(spark, sf):
    return D.svd(_vectors(spark, sf), "doc_id", "features")


@query()
def encode_text(spark, sf):
    return E.encode(docs(spark, sf), "doc_id", "text")


@query()
def resume_embedding(spark, sf):
    d, path = docs(spark, sf), Y.shared_path(spark, "embeddings")
    E.resume_encoding(d, "doc_id", "text", path, at_most=50)
    return E.resume_encoding(d, "doc_id", "text", path).select("doc_id", "embedding", "token_count")


# ---------------------------------------------------------------- validation and streaming


_CONTRACT = [("dataset_has_rows", "critical", "(SELECT count(*) FROM documents)", "'> 0'", "(SELECT count(*) FROM documents) > 0"), ("row_count_observed", "info", "(SELECT count(*) FROM documents)", "(SELECT count(*) FROM documents)", "true"), ("id_column_present", "critical", "'True'", "'True'", "true"), ("representation_present::text", "warning", "'True'", "'True'", "true"), ("representation_present::missing", "warning", "'False'", "'True'", "false"),
             ("at_least_one_representation", "critical", "1", "'>= 1'", "true"), ("id_missing", "warning", "(SELECT count(*) FROM documents WHERE doc_id IS NULL)", "0", "true"), ("id_duplicate_rows", "warning", "0", "0", "true"), ("id_integer_dtype", "warning", "'bigint'", "'integer'", "true"), ("id_monotonic_order", "info", "0", "0", "true"), ("duplicate_contract_rows", "warning", "0", "0", "true")]


@query(" UNION ALL ".join(f"SELECT '{n}' AS check_name, CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS status, CASE WHEN {ok} THEN 'info' ELSE '{s}' END AS severity, NOT ({ok}) AND '{s}' = 'critical' AS blocks_pipeline, ({o})::VARCHAR AS observed, ({e})::VARCHAR AS expected" for n, s, o, e, ok in _CONTRACT))
def contract_validation(spark, sf):
    return V.report(spark, V.input_contract(docs(spark, sf), id_column="doc_id", representations=["text", "missing"]))


@query(f"SELECT unnest(['id_column_present', 'row_count_match', 'id_keys_match', 'duplicate_ids', 'has_features', 'all_numeric', 'nan_count', 'all_finite']) AS check_name, 'pass' AS status, 'info' AS severity, false AS blocks_pipeline, unnest(['True', (SELECT count(*)::VARCHAR FROM documents), '0', '0', '16', '0', '0', '0']) AS observed, unnest(['True', (SELECT count(*)::VARCHAR FROM documents), '0', '0', '>= 1', '0', '0', '0']) AS expected")
def feature_validation(spark, sf):
    a = articles(spark, sf)
    made = R.row_features(a, id_column="source_row_id", prefixes={"full_text": "body"}, groups=LEXICON)
    return V.report(spark, V.feature_output(made, a, id_column="source_row_id"))


_LOST = "(SELECT count(*) FROM documents WHERE doc_id % 10 = 3)"
_NAN = "(SELECT count(*) FROM documents WHERE doc_id % 10 <> 3 AND doc_id % 4 = 0)"
_FAILING = [("id_column_present", "'True'", "'True'", "info"), ("row_count_match", f"(SELECT count(*) FROM documents) - {_LOST}", "(SELECT count(*) FROM documents)", "critical"), ("id_keys_match", _LOST, "0", "critical"), ("duplicate_ids", "0", "0", "info"),
            ("has_features", "3", "'>= 1'", "info"), ("all_numeric", "1", "0", "critical"), ("nan_count", _NAN, "0", "critical"), ("all_finite", "(SELECT count(*) FROM documents WHERE doc_id % 10 <> 3 AND doc_id % 6 = 1)", "0", "critical")]


@query(" UNION ALL ".join(f"SELECT '{n}' AS check_name, '{'pass' if s == 'info' else 'fail'}' AS status, '{s}' AS severity, {s == 'critical'} AS blocks_pipeline, ({o})::VARCHAR AS observed, ({e})::VARCHAR AS expected" for n, o, e, s in _FAILING))
def feature_validation_failing(spark, sf):
    d, k = docs(spark, sf), F.col("doc_id")
    nan, wild = F.lit(float("nan")), F.lit(float("-inf"))
    made = d.where("doc_id % 10 <> 3").select("doc_id", F.when(k % 4 == 0, nan).otherwise(1.0).alias("x"), F.when(k % 6 == 1, wild).otherwise(2.0).alias("y"), "lang")
    return V.report(spark, V.feature_output(made, d, id_column="doc_id"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_incremental_dedup(spark, sf):
    return stream_distinct(spark, f"{sf}/events.parquet", ["user_id", "event_type"])
