"""Audits of tables: missing values, duplicates, dates, domains, prices, numbers and text. One aggregation each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexflume.functions import text as X
from lexflume.functions import urls as U

MISSING = "<MISSING>"


def long_form(row: DataFrame, name: str = "metric", value: str = "value", kind: str = "string") -> DataFrame:
    """A one-row frame as (name, value) rows."""
    return row.select([F.col(c).cast(kind).alias(c) for c in row.columns]).unpivot([], row.columns, name, value)


def percent(part: Column, whole: Column) -> Column:
    """Part of whole in percent, 0 where whole is 0."""
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def missingness(df: DataFrame) -> DataFrame:
    """Per column: missing, missing_pct, total; the most incomplete first."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    out = counts.unpivot(["_n"], df.columns, "column_name", "missing")
    return out.select("column_name", "missing", percent(F.col("missing"), F.col("_n")).alias("missing_pct"), F.col("_n").alias("total")).orderBy(F.desc("missing_pct"), "column_name")


def value_counts(df: DataFrame, column: str, *, dropna: bool = False) -> DataFrame:
    """Values and their counts, most frequent first, ties by value; nulls count as <MISSING> unless dropped."""
    v = F.col(column).cast("string")
    df = df.where(v.isNotNull()) if dropna else df
    return df.groupBy(F.coalesce(v, F.lit(MISSING)).alias("value")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value")


def top_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    return value_counts(df, column).limit(n)


def category_audit(df: DataFrame, column: str, matches: Column) -> DataFrame:
    """Every value with its count and whether the predicate holds; null is a value, never a match."""
    return df.groupBy(F.col(column).alias("category")).agg(F.count(F.lit(1)).alias("row_count")).withColumn("matches", F.coalesce(matches, F.lit(False)))


def accepted_labels(counts: DataFrame) -> DataFrame:
    """Labels that a category audit accepts, as match keys."""
    return counts.where("matches and category is not null").select(F.lower(X.strip("category")).alias("label")).distinct()


def category_share(df: DataFrame, matches: Column) -> DataFrame:
    total = F.count(F.lit(1))
    hit = F.count_if(F.coalesce(matches, F.lit(False)))
    return df.agg(hit.alias("matching_rows"), total.alias("total_rows"), percent(hit, total).alias("matching_pct"))


def duplicate_key_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, rows beyond the first of their key; a null part of a key counts as <MISSING>."""
    keys = df.groupBy([F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    total, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return keys.agg(total.alias("total_rows"), unique.alias("unique_keys"), (total - unique).alias("duplicate_rows"), percent(total - unique, total).alias("duplicate_pct"))


def normalized_title_duplicates(df: DataFrame, column: str) -> DataFrame:
    titles = df.where(F.col(column).isNotNull()).groupBy(X.title_like_key(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return titles.agg(total.alias("non_null_titles"), unique.alias("unique_titles"), (total - unique).alias("duplicate_titles"), percent(total - unique, total).alias("duplicate_pct"))


def datetime_audit(df: DataFrame, column: str, formats: Sequence[str]) -> DataFrame:
    """Missing, invalid and parsed counts and the range of a string column; the first format that reads a value counts."""
    at = parsed_timestamp(F.col(column), formats)
    n, missing = F.count(F.lit(1)), F.count_if(F.col(column).isNull())
    bad = F.count_if(F.col(column).isNotNull() & at.isNull())
    return df.agg(n.alias("row_count"), missing.alias("missing_count"), bad.alias("invalid_count"), percent(F.count(at), n).alias("parse_pct"), F.min(at).alias("min_ts"), F.max(at).alias("max_ts"))


def parsed_timestamp(c: Column, formats: Sequence[str]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def records_by(df: DataFrame, at: Column, pattern: str, name: str) -> DataFrame:
    return df.where(at.isNotNull()).groupBy(F.date_format(at, pattern).alias(name)).agg(F.count(F.lit(1)).alias("records")).orderBy(name)


def domain_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(U.domain(F.col(column)).alias("domain")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "domain")


def ohlcv_sanity(candles: DataFrame) -> DataFrame:
    """Violations of five price checks; percentages use the denominators of the audit, so they may exceed 100."""
    c = candles.select([F.expr(f"try_cast({n} as double)").alias(n) for n in ("open", "high", "low", "close", "volume", "movement")])
    prices = F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull()
    body = [F.col(n) for n in ("open", "low", "close")]
    lows = [F.col(n) for n in ("open", "high", "close")]
    expected = F.try_divide(F.col("close") - F.col("open"), F.col("open")) * 100
    comparable = F.col("movement").isNotNull() & expected.isNotNull()
    off = F.abs(F.col("movement") - expected) > 1e-3 + 1e-3 * F.abs(expected)
    n, full = F.count(F.lit(1)), F.count_if(prices & F.col("volume").isNotNull())
    checks = {
        "non_positive_price": (F.count_if(prices & (F.least("open", "high", "low", "close") <= 0)), n),
        "negative_volume": (F.count_if(F.col("volume") < 0), n),
        "high_below_others": (F.count_if(prices & (F.col("high") < F.greatest(*body))), full),
        "low_above_others": (F.count_if(prices & (F.col("low") > F.least(*lows))), full),
        "movement_mismatch": (F.count_if(comparable & off), F.count_if(comparable)),
    }
    row = c.agg(*[x.alias(f"{k}_{i}") for k, v in checks.items() for i, x in enumerate(v)])
    stack = ", ".join(f"'{k}', {k}_0, {k}_1" for k in checks)
    out = row.selectExpr(f"stack({len(checks)}, {stack}) as (check_name, violations, denominator)")
    return out.withColumn("violation_pct", percent(F.col("violations"), F.col("denominator")))


def text_quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: nulls, blanks, lengths of non-blank texts, and shares of HTML, URLs and wide white space; one aggregation for all columns."""
    parts = []
    for k, name in enumerate(columns):
        t, raw = X.filled(name), F.coalesce(F.col(name), F.lit(""))
        full = t != ""
        parts += [F.col(name).isNull().alias(f"null{k}"), full.alias(f"full{k}"), F.when(full, F.length(t)).alias(f"chars{k}"), F.when(full, F.size(X.split_words(t))).alias(f"words{k}")]
        parts += [raw.rlike(p).alias(f"{flag}{k}") for flag, p in (("html", X.HTML_LIKE), ("url", X.URL_LIKE), ("wide", X.WIDE_SPACE))]

    def one(k: int, name: str) -> Column:
        n, null = F.count(F.lit(1)), F.col(f"null{k}")
        return F.struct(
            F.lit(name).alias("column_name"),
            n.alias("row_count"),
            F.count_if(null).alias("null_count"),
            F.count_if(~null & ~F.col(f"full{k}")).alias("blank_count"),
            F.median(f"chars{k}").alias("median_chars"),
            F.avg(f"chars{k}").alias("mean_chars"),
            F.median(f"words{k}").alias("median_words"),
            *[percent(F.count_if(F.col(f"{flag}{k}")), n).alias(c) for flag, c in (("html", "html_like_pct"), ("url", "url_like_pct"), ("wide", "repeated_ws_pct"))],
        )

    return df.select(*parts).agg(F.array(*[one(k, c) for k, c in enumerate(columns)]).alias("rows")).select(F.inline("rows"))


def numeric_summary(df: DataFrame, columns: Sequence[str], *, accuracy: int | None = None) -> DataFrame:
    """count, mean, std, min, percentiles, max and missing values of each column, in one aggregation.

    Percentiles are interpolated and exact, which holds every distinct value of a
    column in one task; with accuracy they are approximate, of rank error 1 / accuracy.
    """
    probs = (0.01, 0.05, 0.5, 0.95, 0.99)
    cast = df.select(*[F.expr(f"try_cast(`{c}` as double)").alias(f"v{k}") for k, c in enumerate(columns)])

    def one(k: int, name: str) -> Column:
        v, missing = F.col(f"v{k}"), F.count_if(F.col(f"v{k}").isNull())
        p = F.percentile(v, F.array(*[F.lit(x) for x in probs])) if accuracy is None else F.percentile_approx(v, list(probs), accuracy)
        points = [F.get(p, F.lit(i)).alias(f"p{round(100 * x):02d}") for i, x in enumerate(probs)]
        return F.struct(F.lit(name).alias("column_name"), F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), *points, F.max(v).alias("max"), missing.alias("missing"), percent(missing, F.count(F.lit(1))).alias("missing_pct"))

    return cast.agg(F.array(*[one(k, c) for k, c in enumerate(columns)]).alias("rows")).select(F.inline("rows"))


def inspect_profile(df: DataFrame, key: Column, n: int = 500) -> DataFrame:
    """Of the first n rows by key: nulls and distinct values (null is one) per column, and copies of whole rows."""
    first = df.orderBy(key).limit(n)
    counts = first.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__n") for c in df.columns], *[(F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))).alias(f"{c}__u") for c in df.columns], F.count(F.lit(1)).alias("_rows"))
    same = first.groupBy(df.columns).count().agg((F.sum("count") - F.count(F.lit(1))).alias("duplicate_rows"))
    stack = ", ".join(f"'{c}', {c}__n, {c}__u" for c in df.columns)
    return counts.join(F.broadcast(same)).selectExpr(f"stack({len(df.columns)}, {stack}) as (column_name, null_count, unique_count)", "_rows as sampled_rows", "duplicate_rows")  # two frames of one row each


def schema_audit(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected against present columns with both positions."""
    spark = df.sparkSession
    want = spark.createDataFrame(list(enumerate(expected)), "expected_position int, column_name string")
    have = spark.createDataFrame(list(enumerate(df.columns)), "actual_position int, column_name string")
    both = want.join(have, "column_name", "full_outer")
    return both.select("column_name", F.col("expected_position").isNotNull().alias("expected"), F.col("actual_position").isNotNull().alias("present"), "expected_position", "actual_position")


def leakage_review(df: DataFrame, flagged: Sequence[str]) -> DataFrame:
    """For each column that tells the outcome: whether the table has it; it must not become a text feature."""
    return df.sparkSession.createDataFrame([(c, c in df.columns, c not in df.columns) for c in flagged], "column_name string, present boolean, safe boolean")


def duplicate_rows_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in groups of more than one, and the number of such groups."""
    groups = df.groupBy(list(columns)).count().where("count > 1")
    return groups.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows_in_duplicate_groups"), F.count(F.lit(1)).alias("duplicate_groups"))


def id_monotonic(df: DataFrame, position: str, value: str, parts: int = 64, tie: str | None = None) -> DataFrame:
    """How often value falls from one row to the next by position; rows of one position stand in the order of tie, or else of value.

    Rows are cut into ranges of position, each is checked on its own, and the ranges'
    first and last values are compared in a frame of one row per range, so that no
    task orders the whole table.
    """
    ranged = df.select(F.struct(F.col(position).alias("p"), F.col(tie or value).alias("t")).alias("at"), F.col(value).alias("v")).repartitionByRange(parts, "at.p").withColumn("r", F.spark_partition_id())
    step = F.lag("v").over(Window.partitionBy("r").orderBy("at"))
    inner = ranged.withColumn("prev", step).groupBy("r").agg(F.count_if(F.col("v") < F.col("prev")).alias("drops"), F.min_by("v", "at").alias("first"), F.max_by("v", "at").alias("last"), F.count(F.lit(1)).alias("n"))
    edges = inner.withColumn("before", F.lag("last").over(Window.orderBy("r")))  # `parts` rows at most
    drops = F.coalesce(F.sum("drops"), F.lit(0)) + F.count_if(F.col("first") < F.col("before"))
    return edges.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), drops.alias("decreases"), (drops == 0).alias("is_monotonic"))


def length_histogram(df: DataFrame, length: Column, *, bins: int = 50, upto: float = 0.99) -> DataFrame:
    """Counts in equal bins of the lengths up to a quantile: the limits are one row, computed first."""
    v = df.select(length.cast("double").alias("v"))
    top = v.agg(F.percentile("v", F.lit(upto)).alias("q"))
    kept = v.join(F.broadcast(top)).where("v <= q")  # one row
    ends = kept.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    placed = kept.join(F.broadcast(ends)).withColumn("bin", F.least(F.floor((F.col("v") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1.0)) * bins), F.lit(bins - 1)))  # one row
    return placed.groupBy(F.col("bin").cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def language_distribution(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias("language")).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("total"))
    return counts.join(F.broadcast(total)).select("language", "rows", percent(F.col("rows"), F.col("total")).alias("pct"))  # one row
