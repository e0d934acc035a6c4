"""Deterministic samples: rows by a hashed priority, edge cases first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.functions import text as X


def priority(key: str, seed: int) -> Column:
    """The same for a row on any partitioning."""
    return F.xxhash64(F.col(key), F.lit(seed))


def priority_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement: those of the smallest hashed priority."""
    return df.orderBy(priority(key, seed), key).limit(n)


def smoke_sample(df: DataFrame, n: int, key: str, representations: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows with an empty representation first, in key order, then a random fill up to n; sorted by key."""
    empty = F.lit(False)
    for r in representations:
        empty = empty | ~X.nonempty(r)
    tagged = df.withColumn("_edge", empty)
    return tagged.orderBy(F.desc("_edge"), F.when(F.col("_edge"), F.col(key)), priority(key, seed), key).limit(n).drop("_edge").orderBy(key)


def smoke_sample_capped(df: DataFrame, n: int, key: str, representations: Sequence[str], per_representation: int, seed: int = 42) -> DataFrame:
    """Up to so many empty rows of each representation, together, then a random fill up to n; sorted by key."""
    edges = None
    for r in representations:
        some = df.where(~X.nonempty(r)).orderBy(priority(key, seed), key).limit(per_representation).select(key)
        edges = some if edges is None else edges.unionByName(some)
    edges = edges.distinct().withColumn("_edge", F.lit(0))
    tagged = df.join(F.broadcast(edges), key, "left")  # len(representations) * per_representation rows
    return tagged.orderBy(F.coalesce("_edge", F.lit(1)), priority(key, seed), key).limit(n).drop("_edge").orderBy(key)


def shortest_longest(df: DataFrame, key: str, text: str, n: int = 5) -> DataFrame:
    """The n shortest non-empty and the n longest texts."""
    m = df.select(key, F.length(X.filled(text)).alias("length")).where("length > 0")
    low = m.orderBy("length", key).limit(n).withColumn("kind", F.lit("shortest"))
    return low.unionByName(m.orderBy(F.desc("length"), key).limit(n).withColumn("kind", F.lit("longest")))
