"""From raw articles to one row per article: filters, best-row dedup, checks and accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexflume.functions import text as X
from lexflume.operators.audit import long_form, percent

#: Names that stand for each column of the article table; the first that is there is used.
ALIASES = {
    "url": ("URL", "url", "Url", "link", "Link"),
    "title": ("Title", "title", "headline"),
    "description": ("Description", "description", "summary"),
    "full_text": ("Full Text", "full_text", "Full_Text", "text", "body"),
    "coin_type": ("Coin Type", "coin_type", "Coin_Type"),
    "date_time": ("Date Time", "date_time", "Date_Time", "published_at"),
    "filtered_text": ("Filtered_Text", "filtered_text"),
}


def resolve_schema(columns: Sequence[str], aliases=ALIASES) -> dict[str, str]:
    return {k: found for k, names in aliases.items() if (found := next((n for n in names if n in columns), None))}


def require_schema(columns: Sequence[str], required: Sequence[str], aliases=ALIASES) -> dict[str, str]:
    found = resolve_schema(columns, aliases)
    gone = {k: aliases[k] for k in required if k not in found}
    if gone:
        raise ValueError(f"missing columns; accepted names: {gone}")
    return found


def assign_row_id(df: DataFrame, order: Sequence[str] | None = None, name: str = "source_row_id") -> DataFrame:
    """A contiguous id from 0 in the given order, or in the order of the source.

    Ranges of the order are numbered on their own and then moved by the rows before
    them, so no task sees the whole table.
    """
    if order is None:
        rows = df.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
        return df.sparkSession.createDataFrame(rows, df.schema.add(name, "long"))
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    local = ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    start = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))  # one row a partition
    return local.join(F.broadcast(start), "_part").withColumn(name, F.col("_start") + F.col("_at") - 1).drop("_part", "_at", "_start")


def label_filter(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    wanted = sorted({x.strip().casefold() for x in labels})
    return df.where(F.coalesce(F.lower(X.strip(column)).isin(wanted), F.lit(False)))


def semi_join_labels(df: DataFrame, column: str, labels: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """Rows whose label is in labels (label); these are broadcast if they are few, which is counted first."""
    side = labels.select(F.col("label").alias("_label")).distinct()
    if side.limit(broadcast_rows + 1).count() <= broadcast_rows:
        side = F.broadcast(side)
    return df.join(side, F.lower(X.strip(column)) == F.col("_label"), "left_semi")


def label_mentions(c: Column, accepted: str, separators: str = r"[,;|/]|\s&\s") -> Column:
    """Whether a whole piece of a multi-label matches; pieces lose brackets and quotes, case and extra space."""
    pieces = F.split(c, separators)
    piece = lambda x: X.collapse_ws(F.lower(F.regexp_replace(X.strip(x), r"""^[\[\]{}"']+|[\[\]{}"']+$""", "")))
    return F.coalesce(F.exists(pieces, lambda x: piece(x).rlike(f"^(?:{accepted})$")), F.lit(False))


def usable_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    keep = F.lit(False)
    for c in columns:
        keep = keep | X.nonempty(c)
    return df.where(keep)


def language_guard(c: Column, least: int = 20, first: int = 500) -> Column:
    """Whether the first characters have enough letters for a detector."""
    return F.length(F.regexp_replace(F.substring(F.coalesce(c, F.lit("")), 1, first), r"\P{L}", "")) >= least


def detector_input(primary: str, fallback: str) -> Column:
    return F.when(X.nonempty(primary), F.col(primary)).otherwise(F.col(fallback))


def filter_language(df: DataFrame, language: Column, keep: str = "en") -> DataFrame:
    return df.where(language == keep)


def text_score(columns: Sequence[str]) -> tuple[Column, Column]:
    """(non-empty fields, characters) of a row: what the better of two copies has more of."""
    fields, chars = F.lit(0), F.lit(0)
    for c in columns:
        t = X.filled(c)
        fields, chars = fields + (t != "").cast("int"), chars + F.length(t)
    return fields, chars


def dedup_articles(df: DataFrame, *, url_key: str, title_key: str, description_key: str, texts: Sequence[str], row_id: str = "source_row_id") -> DataFrame:
    """The best row of each URL key, and of each (title, description) key where there is no URL; other rows stay.

    One window over a computed key instead of three branches: rows without any key
    are their own group. Best: most non-empty fields, then most characters, then the
    smallest id.
    """
    fields, chars = text_score(texts)
    key = (
        F.when(F.col(url_key) != "", F.concat(F.lit("u:"), F.col(url_key)))
        .when((F.col(title_key) != "") & (F.col(description_key) != ""), F.concat(F.lit("t:"), F.col(title_key), F.lit("\u0001"), F.col(description_key)))
        .otherwise(F.concat(F.lit("i:"), F.col(row_id).cast("string")))
    )
    ranked = df.withColumns({"_key": key, "_fields": fields, "_chars": chars})
    w = Window.partitionBy("_key").orderBy(F.desc("_fields"), F.desc("_chars"), F.asc(row_id))
    return ranked.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_key", "_fields", "_chars", "_rank")


def duplicate_summary(df: DataFrame, url_key: str, title_key: str) -> DataFrame:
    """Rows beyond the first of each URL key and of each (URL, title) key, empty ones aside; percent of all rows."""
    has_url, has_both = F.col(url_key) != "", (F.col(url_key) != "") & (F.col(title_key) != "")
    n = F.count(F.lit(1))
    urls = F.count_if(has_url) - F.count_distinct(F.when(has_url, F.col(url_key)))
    both = F.count_if(has_both) - F.count_distinct(F.when(has_both, F.struct(url_key, title_key)))
    return df.agg(n.alias("row_count"), urls.alias("duplicate_urls"), percent(urls, n).alias("duplicate_url_pct"), both.alias("duplicate_url_titles"), percent(both, n).alias("duplicate_url_title_pct"))


def validation_summary(df: DataFrame, *, url_key: str, title: str, description: str, text: str, row_id: str) -> DataFrame:
    """Nine counts over the processed table, long form."""
    t, d, b = X.nonempty(title), X.nonempty(description), X.nonempty(text)
    has_url = F.col(url_key) != ""
    row = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~t).alias("empty_title"),
        F.count_if(~d).alias("empty_description"),
        F.count_if(~b).alias("empty_text"),
        F.count_if(~t & ~d & ~b).alias("all_text_empty"),
        F.count_if(~has_url).alias("missing_url"),
        (F.count_if(has_url) - F.count_distinct(F.when(has_url, F.col(url_key)))).alias("duplicate_urls"),
        (F.count(row_id) - F.count_distinct(row_id)).alias("duplicate_row_ids"),
        F.count_if(F.col(row_id).isNull()).alias("missing_row_ids"),
    )
    return long_form(row, kind="long")


def accounting(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, position, rows, removed) of a chain of reductions, one count each."""
    from functools import reduce

    counts = [df.agg(F.lit(k).alias("position"), F.lit(n).alias("stage"), F.count(F.lit(1)).alias("rows")) for k, (n, df) in enumerate(stages)]
    every = reduce(DataFrame.unionByName, counts)
    return every.withColumn("removed", F.coalesce(F.lag("rows").over(Window.orderBy("position")) - F.col("rows"), F.lit(0)))  # one row a stage


def same_types(before: DataFrame, after: DataFrame) -> None:
    """Raises if a column of before has another type in after."""
    kinds = dict(after.dtypes)
    wrong = {c: (k, kinds.get(c)) for c, k in before.dtypes if kinds.get(c) != k}
    if wrong:
        raise ValueError(f"types changed: {wrong}")
