"""Pooling, probabilities and reports of embeddings, and a resumable encoding job with a pluggable encoder."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lexflume.operators.audit import percent
from lexflume.sources.files import write_record

#: Order of the sentiment labels.
LABELS = ("positive", "neutral", "negative")


def masked_mean_pool(states: Column, mask: Column) -> Column:
    """Mean of the vectors whose mask is 1; the divisor is 1 at least."""
    weighted = F.zip_with(states, mask, lambda h, m: F.transform(h, lambda x: x * m))
    zero = F.transform(F.element_at(states, 1), lambda x: F.lit(0.0))
    total = F.aggregate(weighted, zero, lambda a, h: F.zip_with(a, h, lambda x, y: x + y))
    n = F.greatest(F.aggregate(mask, F.lit(0.0), lambda a, m: a + m), F.lit(1.0))
    return F.transform(total, lambda x: x / n)


def cls_pool(states: Column) -> Column:
    return F.element_at(states, 1)


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))


def reordered(probabilities: Column, id2label: dict[int, str]) -> Column:
    """A struct in the order of LABELS."""
    at = {v: k for k, v in id2label.items()}
    return F.struct(*[F.element_at(probabilities, at[name] + 1).alias(name) for name in LABELS])


def l2_norm(array: Column) -> Column:
    return F.sqrt(F.aggregate(array, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def finite(array: Column) -> Column:
    return ~F.exists(array, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))


def embedding_report(df: DataFrame, array: str) -> DataFrame:
    norm, n = l2_norm(F.col(array)), F.count(F.lit(1))
    return df.agg(n.alias("rows"), F.max(F.size(array)).alias("dimensions"), F.avg(norm).alias("norm_mean"), F.stddev_pop(norm).alias("norm_std"), F.count_if(norm == 0).alias("zero_rows"), F.count_if(~finite(F.col(array))).alias("non_finite_rows"))


def sentiment_summary(df: DataFrame, struct: str) -> DataFrame:
    p = [F.col(f"{struct}.{x}") for x in LABELS]
    return df.agg(*[F.avg(c).alias(f"mean_{x}") for c, x in zip(p, LABELS, strict=True)], F.max(F.abs(p[0] + p[1] + p[2] - 1)).alias("max_sum_error"))


@dataclass(frozen=True)
class EncoderSpec:
    name: str = "hash"
    pooling: str = "masked_mean"
    max_length: int = 256
    dimensions: int = 8
    revision: str | None = None

    def __post_init__(self) -> None:
        if self.pooling not in ("masked_mean", "cls") or not 2 <= self.max_length <= 512 or self.dimensions < 1:
            raise ValueError(f"invalid encoder {self}")


class HashEncoder:
    """Stands in for a frozen model where none is there: each word draws a vector from its hash, pooled like hidden states."""

    def __init__(self, spec: EncoderSpec):
        self.spec = spec

    def states(self, words: list[str]) -> np.ndarray:
        seeds = np.array([crc32(w.encode()) for w in words], np.uint64)
        steps = np.arange(1, self.spec.dimensions + 1, dtype=np.uint64)
        return ((seeds[:, None] * (2 * steps + 1) >> np.uint64(7)) % np.uint64(2001)).astype(np.float32) / 1000 - 1

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vectors, words of the whole texts, whether a text was longer than max_length words)."""
        out, lengths = np.zeros((len(texts), self.spec.dimensions), np.float32), np.zeros(len(texts), np.int32)
        for k, words in enumerate(t.split() for t in texts):
            lengths[k] = len(words)
            if words:
                states = self.states(words[: self.spec.max_length])
                out[k] = states.mean(0) if self.spec.pooling == "masked_mean" else states[0]
        return out, lengths, lengths > self.spec.max_length


def encode(df: DataFrame, key: str, text: str, spec: EncoderSpec = EncoderSpec(), load: Callable[[EncoderSpec], object] = HashEncoder) -> DataFrame:
    """(key, embedding, token_count, truncated); the encoder is loaded once in each task and fed Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(spec)
        for b in batches:
            vectors, lengths, cut = model.encode(b["t"].fillna("").str.strip().tolist())
            if vectors.shape != (len(b), spec.dimensions) or not np.isfinite(vectors).all():
                raise ValueError("the encoder broke its contract")
            yield pd.DataFrame({key: b[key], "embedding": list(vectors), "token_count": lengths, "truncated": cut})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(text).alias("t")).mapInPandas(run, f"{key} {kind}, embedding array<float>, token_count int, truncated boolean")


def bundle_record(spec: EncoderSpec, pinned: bool = True) -> dict:
    """What a run must note of its frozen model; a real one must be pinned to a revision, so that it can be loaded again."""
    if pinned and spec.revision is None:
        raise ValueError(f"{spec.name}: no revision to pin")
    return asdict(spec) | {"device": "cpu", "frozen": True}


def encoder_benchmark(df: DataFrame, key: str, representations: Sequence[str], specs: Sequence[EncoderSpec], load: Callable[[EncoderSpec], object] = HashEncoder) -> DataFrame:
    """One row for each encoder and text column: rows, dimensions, seconds, megabytes, truncated rows, whether all is finite."""
    rows = []
    for spec in specs:
        for name in representations:
            began = time.monotonic()
            r = encode(df, key, name, spec, load).agg(F.count(F.lit(1)).alias("n"), F.count_if("truncated").alias("cut"), F.median("token_count").alias("tokens"), F.coalesce(F.bool_and(finite(F.col("embedding"))), F.lit(True)).alias("finite")).first()
            rows.append((name, spec.name, r["n"], spec.dimensions, time.monotonic() - began, r["n"] * spec.dimensions * 4 / 2**20, r["cut"], r["tokens"], r["finite"]))
    return df.sparkSession.createDataFrame(rows, "representation string, method string, rows long, dimensions long, elapsed_seconds double, memory_mb double, truncated long, median_tokens double, finite_values boolean")


def save_embeddings(encoded: DataFrame, spec: EncoderSpec, path: str, *, pinned: bool = True) -> dict:
    """Writes vectors and, beside them, the record of their model and of what was written, which it returns."""
    record = bundle_record(spec, pinned)  # an unpinned model is refused before any work
    encoded.write.mode("overwrite").parquet(f"{path}/vectors")
    found = encoded.sparkSession.read.parquet(f"{path}/vectors")
    record |= embedding_report(found, "embedding").first().asDict() | token_report(found).first().asDict()
    write_record(encoded.sparkSession, record, f"{path}/record")
    return record


def token_report(encoded: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return encoded.agg(n.alias("rows"), F.count_if("truncated").alias("truncated"), percent(F.count_if("truncated"), n).alias("truncated_pct"), F.median("token_count").alias("median_tokens"), F.max("token_count").alias("max_tokens"))


def fingerprint(df: DataFrame, key: str, text: str, spec: EncoderSpec) -> str:
    """Of a job: its rows, each with its key and text, whatever their order, and its encoder."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(key, text).cast("decimal(38,0)")).alias("ids")).first()
    return hashlib.sha256(json.dumps({"rows": r["n"], "ids": str(r["ids"]), "text": text, "spec": asdict(spec)}, sort_keys=True).encode()).hexdigest()


def written(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def resume_encoding(df: DataFrame, key: str, text: str, path: str, spec: EncoderSpec = EncoderSpec(), at_most: int | None = None) -> DataFrame:
    """Encodes the rows whose keys aren't in path yet, appends them and returns all; refuses a path of another job.

    Each part carries the job's fingerprint. at_most: rows by key after which to
    pause; what is left is done by the next call.
    """
    spark, mark = df.sparkSession, fingerprint(df, key, text, spec)
    done = written(spark, path)
    if done is not None and not done.where(F.col("job") != mark).isEmpty():
        raise ValueError("the folder holds another job's vectors")
    left = df if done is None else df.join(done.select(key), key, "left_anti")
    left = left if at_most is None else left.orderBy(key).limit(at_most)
    encode(left, key, text, spec).withColumn("job", F.lit(mark)).write.mode("append").parquet(path)
    return spark.read.parquet(path)
