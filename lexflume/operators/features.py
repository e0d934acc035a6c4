"""Row features and the comparison of text representations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.functions import text as X
from lexflume.operators.audit import percent


def row_features(df: DataFrame, *, id_column: str, prefixes: Mapping[str, str], currency: Sequence[str] = X.CURRENCY, groups: Mapping[str, Sequence[str]] = X.KEYWORD_GROUPS) -> DataFrame:
    """The id and the features of each representation: repeated ids are fine, nothing is joined, texts are stripped once."""
    stripped = df.select(F.col(id_column).alias("id"), *[X.filled(name).alias(f"t{k}") for k, name in enumerate(prefixes)])
    return stripped.select(F.col("id").alias(id_column), *[c for k, prefix in enumerate(prefixes.values()) for c in X.representation_features(f"t{k}", prefix, currency=currency, groups=groups)])


def representation_comparison(df: DataFrame, representations: Sequence[str], *, short_words: int = 3, short_chars: int = 20, quantile: float = 0.95) -> DataFrame:
    """18 columns for each representation; medians count empty texts as 0, very short shares are of non-empty ones."""

    def one(k: int, name: str) -> Column:
        null, empty, words, chars = (F.col(f"{m}{k}") for m in ("is_null", "is_empty", "word_count", "character_count"))
        n, nulls, empties = F.count(F.lit(1)), F.coalesce(F.sum(null), F.lit(0)), F.coalesce(F.sum(empty), F.lit(0))
        full = n - empties
        few = F.count_if((empty == 0) & (words <= short_words))
        short = F.count_if((empty == 0) & (chars <= short_chars))
        zero = lambda c: F.coalesce(c, F.lit(0.0))
        return F.struct(
            F.lit(name).alias("representation"),
            n.alias("row_count"),
            nulls.alias("null_count"),
            percent(nulls, n).alias("null_pct"),
            empties.alias("empty_count"),
            percent(empties, n).alias("empty_pct"),
            full.alias("nonempty_count"),
            percent(full, n).alias("nonempty_pct"),
            zero(F.median(words)).alias("median_word_count"),
            zero(F.percentile(words, F.lit(quantile))).alias("p95_word_count"),
            F.coalesce(F.max(words), F.lit(0)).alias("max_word_count"),
            zero(F.median(chars)).alias("median_character_count"),
            zero(F.percentile(chars, F.lit(quantile))).alias("p95_character_count"),
            F.coalesce(F.max(chars), F.lit(0)).alias("max_character_count"),
            few.alias("very_short_word_count"),
            percent(few, full).alias("very_short_word_pct_nonempty"),
            short.alias("very_short_character_count"),
            percent(short, full).alias("very_short_character_pct_nonempty"),
        )

    measured = df.select(*[v.alias(f"{m}{k}") for k, name in enumerate(representations) for m, v in X.length_metrics(name).items()])
    return measured.agg(F.array(*[one(k, name) for k, name in enumerate(representations)]).alias("rows")).select(F.inline("rows"))
