"""From parsed pages to a collection: records, incremental merge, candidate dedup, reports and assertions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.functions import text as X
from lexflume.operators.audit import long_form

#: The columns of a record, in order, with their types.
RECORD = {
    "source_row_id": "string", "document_id": "string", "source": "string", "source_type": "string", "release_number": "string",
    "title": "string", "description": "string", "full_text": "string", "published_at": "string", "last_reviewed_at": "string",
    "url": "string", "canonical_url": "string", "coin_type": "string", "language": "string", "ingestion_method": "string",
    "collection_mode": "string", "body_text_status": "string", "full_text_is_complete": "boolean", "source_verified": "boolean",
    "scraped_at": "string", "content_hash": "string", "http_status": "int", "bitcoin_keyword_count": "int", "matched_keywords": "string",
    "word_count": "int", "character_count": "int", "is_bitcoin_related": "boolean",
}


def document_id(release: Column) -> Column:
    return F.concat(F.lit("sec_"), F.replace(release, F.lit("-"), F.lit("_")))


def joined_keywords(keywords: Column) -> Column:
    return F.concat_ws("|", F.array_sort(F.array_distinct(keywords)))


def normalize_record(articles: DataFrame, *, source: str, source_type: str, method: str, mode: str, scraped_at: str, status: int = 200) -> DataFrame:
    """Parsed articles as RECORD rows; how the text was collected decides its status."""
    live = mode == "live_http"
    title, text, release = X.filled("title"), X.filled("full_text"), X.filled("release_number")
    made = {
        "source_row_id": document_id(release),
        "document_id": document_id(release),
        "source": F.lit(source),
        "source_type": F.lit(source_type),
        "release_number": release,
        "title": title,
        "description": X.filled("description"),
        "full_text": text,
        "published_at": F.col("published_at"),
        "last_reviewed_at": F.col("last_reviewed_at"),
        "url": F.col("url"),
        "canonical_url": F.coalesce(F.nullif(F.col("canonical_url"), F.lit("")), F.col("url")),
        "coin_type": F.lit("Bitcoin"),
        "language": F.lit("en"),
        "ingestion_method": F.lit(method),
        "collection_mode": F.lit(mode),
        "body_text_status": F.lit("complete_page_body" if live else "verified_excerpt"),
        "full_text_is_complete": F.lit(live),
        "source_verified": F.lit(True),
        "scraped_at": F.lit(scraped_at),
        "content_hash": X.content_hash("title", "full_text"),
        "http_status": F.lit(status),
        "bitcoin_keyword_count": F.coalesce("keyword_count", F.lit(0)),
        "matched_keywords": joined_keywords(F.coalesce("matched_keywords", F.array().cast("array<string>"))),
        "word_count": F.size(X.split_words(text)),
        "character_count": F.length(text),
        "is_bitcoin_related": F.coalesce("is_related", F.lit(True)),
    }
    return articles.select(*[made[k].cast(t).alias(k) for k, t in RECORD.items()])


def output_schema(df: DataFrame, columns: dict[str, str] = RECORD) -> DataFrame:
    """Missing columns as nulls, others dropped, in the fixed order."""
    return df.select(*[(F.col(k) if k in df.columns else F.lit(None)).cast(t).alias(k) for k, t in columns.items()])


def keep_last(df: DataFrame, column: str, order: str) -> DataFrame:
    """The last row by order of each value; nulls are one value. Tasks keep their own last rows before the shuffle, so a hot value is spread."""
    last = df.groupBy(F.col(column).alias("of")).agg(F.max_by(F.struct(*df.columns), order).alias("row"))
    return last.select("row.*")


def merge_incremental(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("release_number", "canonical_url", "content_hash"), order: str = "ingest_seq") -> DataFrame:
    """Old and new rows, then the last row by each key, one key after the other: the order of the keys matters."""
    both = old.unionByName(new, allowMissingColumns=True)
    for k in keys:
        both = keep_last(both, k, order)
    return both


def dedup_candidates(df: DataFrame) -> DataFrame:
    """The first candidate, by page and position, of each release number or, without one, URL."""
    first = df.groupBy(F.coalesce("release_number", "url").alias("of")).agg(F.min_by(F.struct(*df.columns), F.struct("page", "position")).alias("row"))
    return first.select("row.*")


def new_urls(candidates: DataFrame, known: DataFrame, column: str = "url") -> DataFrame:
    return candidates.join(known.select(column).distinct(), column, "left_anti")


def relevant(df: DataFrame, text: Column, keywords: list[str], required: int = 1) -> DataFrame:
    found, n = X.keyword_hits(text, keywords)
    return df.withColumns({"matched_keywords": found, "keyword_count": n}).where(F.size("matched_keywords") >= required)


def failed_rows(parsed: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, dead letters (url, stage, error))."""
    return parsed.where("error is null").drop("error"), parsed.where("error is not null").select("url", F.lit(stage).alias("stage"), "error")


def _dates(df: DataFrame) -> DataFrame:
    return df.withColumn("_at", F.expr("try_to_date(published_at, 'yyyy-MM-dd')"))


def quality_report(df: DataFrame) -> DataFrame:
    """13 metrics, long form. A null title or text counts as null and as empty, so twice."""
    n = F.count(F.lit(1))
    beyond = lambda c: n - F.count_distinct(F.coalesce(F.col(c), F.lit("\u0000")))
    gone = lambda c: F.count_if(F.col(c).isNull()) + F.count_if(~X.nonempty(c))
    row = _dates(df).agg(
        n.alias("row_count"),
        F.count_distinct("release_number").alias("unique_release_numbers"),
        beyond("source_row_id").alias("duplicate_source_row_ids"),
        beyond("canonical_url").alias("duplicate_canonical_urls"),
        beyond("content_hash").alias("duplicate_content_hashes"),
        gone("title").alias("missing_titles"),
        gone("full_text").alias("missing_full_text"),
        F.count_if(F.col("_at").isNull()).alias("invalid_published_dates"),
        F.median("word_count").cast("long").alias("median_word_count"),
        F.min("word_count").alias("min_word_count"),
        F.max("word_count").alias("max_word_count"),
        F.date_format(F.min("_at"), "yyyy-MM-dd").alias("oldest_publication_date"),
        F.date_format(F.max("_at"), "yyyy-MM-dd").alias("newest_publication_date"),
    )
    return long_form(row)


def scrape_summary(df: DataFrame, *, failures: int, mode: str) -> DataFrame:
    n = F.count(F.lit(1))
    return _dates(df).agg(
        F.lit("completed").alias("status"),
        F.lit(mode).alias("collection_mode"),
        n.alias("records"),
        F.lit(failures).alias("failures"),
        F.date_format(F.min("_at"), "yyyy-MM-dd").alias("oldest_publication_date"),
        F.date_format(F.max("_at"), "yyyy-MM-dd").alias("newest_publication_date"),
        F.median("word_count").alias("median_word_count"),
        F.coalesce(F.bool_and("is_bitcoin_related"), F.lit(True)).alias("all_bitcoin_related"),
        (n == F.count_distinct("source_row_id")).alias("source_row_id_unique"),
        (n == F.count_distinct("canonical_url")).alias("canonical_url_unique"),
        (n == F.count_distinct("content_hash")).alias("content_hash_unique"),
    )


def frame_assertions(df: DataFrame) -> DataFrame:
    """(check, passed) of the eight conditions on a collection."""
    n = F.count(F.lit(1))
    unique = lambda c: n == F.count_distinct(F.coalesce(F.col(c), F.lit("\u0000")))
    row = df.agg(
        (n > 0).alias("has_rows"),
        (F.count_if(F.col("source_row_id").isNull()) == 0).alias("id_not_missing"),
        unique("source_row_id").alias("id_unique"),
        unique("canonical_url").alias("url_unique"),
        unique("content_hash").alias("content_unique"),
        (F.count_if(~F.coalesce("is_bitcoin_related", F.lit(False))) == 0).alias("all_related"),
        (F.count_if(~X.nonempty("title")) == 0).alias("title_not_empty"),
        (F.count_if(~X.nonempty("full_text")) == 0).alias("text_not_empty"),
    )
    return long_form(row, "check_name", "passed", "boolean")


def assert_frame(df: DataFrame) -> None:
    missing = [c for c in RECORD if c not in df.columns]
    if missing:
        raise ValueError(f"missing output columns: {missing}")
    failed = [r["check_name"] for r in frame_assertions(df).where("not passed").collect()]  # eight rows at most
    if failed:
        raise ValueError(f"failed checks: {failed}")
