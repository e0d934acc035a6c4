"""Mixing sources to target weights by Poisson replication. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.llm._common import frozen, nested

#: Production parameters: weight of a source = its rows to this power; seed of both hashes.
TEMPERATURE, SEED = 0.7, 17
#: Numbers in the sources' distributions up to which they are broadcast (8 bytes each); beyond, the join shuffles.
BROADCAST_TERMS = 1_000_000
#: Stands for a null source; a prefix keeps it apart from every real name.
NO_SOURCE, A_SOURCE = "0", "1"


def uniform(*parts) -> F.Column:
    """A 52-bit uniform number in [0, 1) from the MD5 of the parts; the same on every engine and partitioning."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def _tagged(source: Column) -> Column:
    return F.when(source.isNull(), NO_SOURCE).otherwise(F.concat(F.lit(A_SOURCE), source.cast("string")))


def mixture(docs: DataFrame, *, source: str = "source", weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, total: int | None = None) -> DataFrame:
    """(_source, rows, rate, cdf): the mean repetitions of each source's documents and their Poisson distribution.

    rate = total * (weight / all weights) / rows. weights: by source, 0 for one that
    is absent from a given dict; without a dict a source weighs rows ** temperature.
    total: documents aimed at, as many as came by default. cdf reaches so far that the
    rest is below 2^-53, so it cuts nothing that a 52-bit number can tell.
    """
    counts = docs.groupBy(_tagged(F.col(f"`{source}`")).alias("_source")).agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        weight = F.pow(F.col("rows").cast("double"), F.lit(float(temperature)))
        counts = counts.withColumn("weight", weight)
    else:
        given = docs.sparkSession.createDataFrame([(A_SOURCE + k, float(v)) for k, v in weights.items()], "_source string, weight double")
        counts = counts.join(given, "_source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    counts = frozen(counts)
    sums = counts.agg(F.sum("weight").alias("w"), F.sum("rows").alias("n")).first()  # one row
    aim, all_weights = float(total if total is not None else sums["n"] or 0), float(sums["w"] or 0)
    rates = counts.withColumn("rate", F.lit(aim) * F.col("weight") / F.lit(all_weights or 1.0) / F.col("rows"))
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    terms = rates.where("rate > 0").select("_source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    up_to = "over (partition by _source order by k rows between unbounded preceding and current row)"
    terms = terms.withColumn("log_p", F.expr(f"k * ln(rate) - rate - sum(ln(greatest(k, 1))) {up_to}"))
    terms = terms.withColumn("c", F.expr(f"sum(exp(log_p)) {up_to}"))
    cdf = terms.groupBy("_source").agg(F.array_sort(F.collect_list("c")).alias("cdf"))
    found = frozen(rates.join(cdf, "_source", "left").select("_source", "rows", "rate", F.coalesce("cdf", F.array(F.lit(2.0))).alias("cdf")))
    size = found.agg(F.sum(F.size("cdf") + 8)).first()[0] or 0
    return F.broadcast(found) if size <= BROADCAST_TERMS else found


def mix(docs: DataFrame, *, source: str = "source", key: str = "doc_id", weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, total: int | None = None, seed: int = SEED) -> DataFrame:
    """docs, each row as often as its draw says, in a globally random order; with copy (from 0) and shuffle_key added.

    A row's count is the inverse of its source's Poisson distribution at a number
    hashed from seed and key, so it depends on nothing else: equal keys (null too),
    and so repeated rows, draw alike. Null sources are one source. Rows go to
    partitions by the hash of shuffle_key, which differs for every copy of a key, and
    are sorted by it there, so a hot source spreads evenly; nothing about texts is
    computed, null, empty and very long ones go along as they are. The distributions
    are broadcast if they are small, which is measured. Columns named copy or
    shuffle_key are replaced, all others pass whatever their names; an empty table
    gives no rows.
    """
    docs = docs.drop("copy", "shuffle_key")
    rates = mixture(docs, source=source, weights=weights, temperature=temperature, total=total).select("_source", "cdf")
    ident = F.coalesce(F.col(f"row.`{key}`").cast("string"), F.lit("-"))
    rows = nested(docs).select("row", _tagged(F.col(f"row.`{source}`")).alias("_source"), uniform(F.lit(str(seed)), ident).alias("u"))
    drawn = rows.join(rates, "_source").select("row", F.expr("size(filter(cdf, c -> c <= u))").alias("n")).where("n > 0")
    copies = drawn.select("row", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    keyed = copies.select("row.*", "copy", F.md5(F.concat_ws(":", F.lit(str(seed)), ident, F.col("copy"))).alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
