"""TF-IDF in long form (key, term, weight): fit on training rows, transform any rows."""

from __future__ import annotations

import json
import re
import time
import unicodedata
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Recipe:
    """Terms are words (low..high of them) or characters within padded words; min_df rows, max_df share of rows."""

    analyzer: str = "word"
    low: int = 1
    high: int = 2
    min_df: int = 2
    max_df: float = 0.98
    max_features: int = 6000

    def __post_init__(self) -> None:
        if self.analyzer not in ("word", "char_wb") or not 1 <= self.low <= self.high or self.min_df < 1 or not 0 < self.max_df <= 1 or self.max_features < 1:
            raise ValueError(f"invalid recipe {self}")


WORD_RECIPE, CHAR_RECIPE = Recipe(), Recipe("char_wb", 3, 5)


_WORD = re.compile(r"\w+")


def folded(text: str | None) -> str:
    """Lower case, without accents."""
    if not text or text.isascii():
        return (text or "").lower()
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch)).lower()


def grams(text: str | None, recipe: Recipe) -> list[str]:
    """The terms of a text, as often as they come."""
    t = folded(text)
    if recipe.analyzer == "word":
        words = [w for w in _WORD.findall(t) if len(w) > 1]
        out = list(words) if recipe.low == 1 else []
        for n in range(max(recipe.low, 2), recipe.high + 1):
            out += map(" ".join, zip(*(words[k:] for k in range(n)), strict=False))
        return out
    out = []
    for word, times in Counter(t.split()).items():
        p, own = f" {word} ", []
        for n in range(recipe.low, recipe.high + 1):
            own += [p[k : k + n] for k in range(max(len(p) - n, 0) + 1)]
            if len(p) <= n:
                break  # a padded word not longer than n gives itself once and ends the sizes
        out += own * times
    return out


def _mapped(df: DataFrame, key: str, text: str, run, schema: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def terms(df: DataFrame, key: str, text: str, recipe: Recipe) -> DataFrame:
    """(key, term, tf): how often each term is in a row. Rows are counted by themselves; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term, tf = [], [], []
            for k, t in enumerate(batch.column("text").to_pylist()):
                found = Counter(grams(t, recipe))
                row += [k] * len(found)
                term += found.keys()
                tf += found.values()
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(row, pa.int64())), pa.array(term, pa.string()), pa.array(tf, pa.int64())], names=[key, "term", "tf"])

    return _mapped(df, key, text, run, f"`{key}` {df.schema[key].dataType.simpleString()}, term string, tf long")


#: Terms of rows that a task gathers before it passes on what it has, and words whose terms it remembers.
FLUSH_TERMS, MEMO_WORDS = 2_000_000, 300_000


class Coded:
    """The terms of texts as numbers, so that they are counted by arrays.

    With known terms (term: number) others are left out; without, a term's number is
    made up, and named() gives the terms of numbers. Terms of three words and more are
    made one by one.
    """

    def __init__(self, recipe: Recipe, known: dict[str, int] | None = None):
        self.recipe, self.known, self.memo, self.numbers = recipe, known, {}, {}
        self.long: dict[str, int] = {}
        if known is not None and recipe.analyzer == "word":
            pairs = [(t.split(" "), n) for t, n in known.items() if t.count(" ") == 1]
            for (a, b), _ in pairs:
                self.numbers.setdefault(a, len(self.numbers))
                self.numbers.setdefault(b, len(self.numbers))
            codes = np.array([(self.numbers[a] + 1 << 32) | self.numbers[b] for (a, b), _ in pairs], np.int64)
            by = np.argsort(codes)
            self.pairs, self.columns = codes[by], np.array([n for _, n in pairs], np.int64)[by]

    def _of_word(self, word: str) -> np.ndarray:
        own = grams(word, self.recipe)
        ids = [self.numbers.setdefault(g, len(self.numbers)) for g in own] if self.known is None else [self.known[g] for g in own if g in self.known]
        return np.array(ids, np.int64)

    def _pairs(self, words: list[str]) -> np.ndarray:
        numbers = self.numbers
        if self.known is None:
            ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
            return (ids[:-1] + 1 << 32) | ids[1:]
        ids = np.array([numbers.get(w, -1) for w in words], np.int64)
        codes = ((ids[:-1] + 1 << 32) | ids[1:])[(ids[:-1] >= 0) & (ids[1:] >= 0)]
        at = np.minimum(np.searchsorted(self.pairs, codes), max(len(self.pairs) - 1, 0))
        return self.columns[at[self.pairs[at] == codes]] if len(self.pairs) else codes[:0]

    def codes(self, text: str | None) -> np.ndarray:
        """The numbers of a text's terms, as often as they come."""
        if self.recipe.analyzer == "char_wb":
            parts, memo = [], self.memo
            for w in folded(text).split():
                if (ids := memo.get(w)) is None:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    ids = memo[w] = self._of_word(w)
                parts.append(ids)
            return np.concatenate(parts) if parts else np.zeros(0, np.int64)
        words = [w for w in _WORD.findall(folded(text)) if len(w) > 1]
        parts = []
        for n in range(self.recipe.low, self.recipe.high + 1):
            if n == 1 and self.known is not None:
                parts.append(np.array([self.known[w] for w in words if w in self.known], np.int64))
            elif n == 1:
                parts.append(np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words], np.int64))
            elif n == 2:
                parts.append(self._pairs(words))
            else:
                own = map(" ".join, zip(*(words[k:] for k in range(n)), strict=False))
                parts.append(np.array([-1 - self.long.setdefault(g, len(self.long)) for g in own] if self.known is None else [self.known[g] for g in own if g in self.known], np.int64))
        return np.concatenate(parts)

    def named(self, codes: np.ndarray) -> list[str]:
        names, long = list(self.numbers), list(self.long)
        return [long[-1 - c] if c < 0 else names[c] if c < 1 << 32 else f"{names[(c >> 32) - 1]} {names[c & 0xFFFFFFFF]}" for c in codes.tolist()]


def document_frequencies(df: DataFrame, key: str, text: str, recipe: Recipe) -> DataFrame:
    """(term, df, total): rows and places of each term, added up in each task before the shuffle."""

    def flushed(coded: Coded, held: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
        codes, place = np.unique(np.concatenate(held or [np.zeros(0, np.int64)]), return_inverse=True)
        places = np.bincount(place, np.concatenate(times or [np.zeros(0)]), len(codes)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(coded.named(codes), pa.string()), pa.array(np.bincount(place, minlength=len(codes)).astype(np.int64)), pa.array(places)], names=["term", "df", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, held, times, size = Coded(recipe), [], [], 0
        for batch in batches:
            for t in batch.column("text").to_pylist():
                codes, many = np.unique(coded.codes(t), return_counts=True)
                held.append(codes)
                times.append(many)
                size += len(codes)
                if size > FLUSH_TERMS:
                    yield flushed(coded, held, times)
                    coded, held, times, size = Coded(recipe), [], [], 0
        yield flushed(coded, held, times)

    parts = _mapped(df, key, text, run, "term string, df long, total long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def fit(train: DataFrame, key: str, text: str, recipe: Recipe) -> DataFrame:
    """(term, column, idf): the most frequent terms within the document frequencies, ties and columns by term."""
    n = train.count()
    stats = document_frequencies(train, key, text, recipe).where((F.col("df") >= recipe.min_df) & (F.col("df") <= recipe.max_df * n))
    top = stats.orderBy(F.desc("total"), "term").limit(recipe.max_features)
    idf = F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0
    return top.select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("column"), idf.alias("idf"))  # max_features rows


def transform(df: DataFrame, model: DataFrame, key: str, text: str, recipe: Recipe) -> DataFrame:
    """(key, term, column, weight): (1 + ln tf) * idf, each row of length 1; rows without terms have none.

    The model (max_features rows) goes to every worker; each row is weighed where it is.
    """
    listed = model.orderBy("column").collect()  # max_features rows
    shared = df.sparkSession.sparkContext.broadcast([(r["term"], r["column"], r["idf"]) for r in listed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, columns, idf = (list(x) for x in zip(*shared.value, strict=True)) if shared.value else ([], [], [])
        coded, names, columns, idf = Coded(recipe, {t: n for n, t in enumerate(names)}), pa.array(names, pa.string()), np.array(columns, np.int32), np.array(idf, np.float64)
        for batch in batches:
            row, found, weight = [], [np.zeros(0, np.int64)], [np.zeros(0)]
            for t in batch.column("text").to_pylist():
                codes, many = np.unique(coded.codes(t), return_counts=True)
                raw = (1.0 + np.log(many)) * idf[codes]
                row.append(len(codes))
                found.append(codes)
                weight.append(raw / np.sqrt((raw * raw).sum()) if len(raw) else raw)
            at = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(np.repeat(np.arange(len(row)), row))), names.take(pa.array(at)), pa.array(columns[at]), pa.array(np.concatenate(weight))], names=[key, "term", "column", "weight"])

    return _mapped(df, key, text, run, f"`{key}` {df.schema[key].dataType.simpleString()}, term string, column int, weight double")


def combined(df: DataFrame, key: str, text: str, parts: dict[str, tuple[Recipe, DataFrame]]) -> DataFrame:
    """The long forms of several recipes in one, terms prefixed with the recipe's name."""
    out = None
    for name, (recipe, model) in parts.items():
        one = transform(df, model, key, text, recipe).select(key, F.concat(F.lit(f"{name}__"), "term").alias("term"), "weight")
        out = one if out is None else out.unionByName(one)
    return out


def report(docs: DataFrame, weights: DataFrame, key: str, features: int) -> DataFrame:
    """Rows, features, non-zeros, sparsity, rows without weights, and bytes as compressed rows; no row is lost."""
    nnz = docs.select(key).join(weights.groupBy(key).agg(F.count(F.lit(1)).alias("nnz")), key, "left").select(F.coalesce("nnz", F.lit(0)).alias("nnz"))
    n, s = F.count(F.lit(1)), F.sum("nnz")
    return nnz.agg(n.alias("rows"), F.lit(features).cast("long").alias("features"), s.alias("nnz"), (100.0 * (1 - s / (n * features))).alias("sparsity_pct"), F.count_if(F.col("nnz") == 0).alias("zero_vectors"), (s * 8 + (n + 1) * 4).alias("csr_bytes"))


def benchmark(df: DataFrame, key: str, representations: Sequence[str], recipes: Mapping[str, Recipe], folder: str | None = None) -> DataFrame:
    """One row for each recipe and text column, fitted and applied on df's rows; with a folder the models and weights are kept there."""
    rows = []
    for name in representations:
        for label, recipe in recipes.items():
            began = time.monotonic()
            model = fit(df, key, name, recipe)
            if folder:
                save(model, recipe, f"{folder}/{name}__{label}")
                model, recipe = load(df.sparkSession, f"{folder}/{name}__{label}")
            weights = transform(df, model, key, name, recipe)
            features = model.count()
            r = report(df, weights, key, max(features, 1)).first()
            rows.append((name, label, r["rows"], features, r["nnz"], float(r["sparsity_pct"] or 0.0), r["zero_vectors"], r["csr_bytes"] / 2**20, time.monotonic() - began, True))
    return df.sparkSession.createDataFrame(rows, "representation string, method string, rows long, dimensions long, nnz long, sparsity_pct double, zero_vectors long, memory_mb double, elapsed_seconds double, finite_values boolean")


def save(model: DataFrame, recipe: Recipe, path: str) -> None:
    """A fitted model (max_features rows) and its recipe."""
    model.withColumn("recipe", F.lit(json.dumps(asdict(recipe), sort_keys=True))).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> tuple[DataFrame, Recipe]:
    """A saved model and its recipe."""
    kept = spark.read.parquet(path)
    first = kept.select("recipe").first()
    if first is None:
        raise ValueError(f"no terms in {path}")
    return kept.drop("recipe"), Recipe(**json.loads(first["recipe"]))


def recipe_of(settings: Mapping) -> Recipe:
    """A recipe from settings; unknown names and invalid values raise ValueError."""
    known = {f.name for f in fields(Recipe)}
    if set(settings) - known:
        raise ValueError(f"unknown settings {sorted(set(settings) - known)}; known are {sorted(known)}")
    return Recipe(**settings)


def vectors(docs: DataFrame, weights: DataFrame, key: str, size: int) -> DataFrame:
    """(key, features): sparse vectors, one for each row of docs, empty ones too."""
    rows = weights.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("column", "weight"))).alias("cells"))

    @F.udf(VectorUDT())
    def vector(cells):
        return SparseVector(size, [(c["column"], c["weight"]) for c in cells or []])

    return docs.select(key).join(rows, key, "left").select(key, vector("cells").alias("features"))


def hstacked(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=name).transform(df)
