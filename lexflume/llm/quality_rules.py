"""Quality rules: base counts, and Jensen-Shannon distance to language references. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.llm._common import WS, frozen, text_or_empty

#: Frequent words of each language whose share a document's histogram has.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "that", "is", "for"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se"],
}
#: Characters of n_symbols.
SYMBOLS = "[#*$%&|<>]"
#: Character classes of the histogram; what is in none of them is the last bin.
CLASSES = {"upper": r"\p{Lu}", "lower": r"\p{Ll}", "digit": r"\p{Nd}", "space": WS, "symbol": SYMBOLS}
#: Distances above which a document is not like its language, and the lengths from which each histogram is judged.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.23
MIN_CHARS, MIN_WORDS = 400, 80


def features(docs: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """key, lang, base counts and the two histograms of every row, in one narrow pass.

    Words are the runs outside ASCII white space; a null text has none. Windows of
    three words are compared by a 64-bit hash within the text. Where some hash comes
    twice, sorting (hash, position) puts equal ones side by side, so the cost is
    n log n in the words at most.
    """
    listed = "case " + " ".join(f"when lang = '{k}' then array({', '.join(f"'{w}'" for w in v)})" for k, v in COMMON_WORDS.items()) + " end"
    every = ", ".join(sorted({f"'{w}'" for v in COMMON_WORDS.values() for w in v}))
    d = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{lang}`").alias("lang"), text_or_empty(text).alias("t"))
    d = d.withColumn("words", F.array_remove(F.split("t", f"{WS}+"), ""))
    d = d.withColumn("lines", F.expr(r"filter(split(t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    d = d.withColumn("n", F.size("words")).withColumn("h", F.expr("if(n < 3, array(), transform(sequence(0, n - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))"))
    runs = "transform(filter(win, (x, k) -> (k > 0 and win[k - 1].h = x.h) or (k < size(win) - 1 and win[k + 1].h = x.h)), x -> x.i)"
    d = d.withColumn("again", F.expr(f"if(size(array_distinct(h)) = size(h), array(), flatten(transform(array(sort_array(transform(h, (x, i) -> struct(x as h, i as i)))), win -> {runs})))"))
    d = d.withColumn("common", F.expr(f"filter(words, w -> w in ({every}))")).withColumn("listed", F.expr(listed))
    gone = {k: F.length("t") - F.length(F.regexp_replace("t", f"{c}+", "")) for k, c in CLASSES.items()}
    d = d.select(
        "doc_id",
        "lang",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("size(array_distinct(flatten(transform(again, p -> array(p, p + 1, p + 2)))))").cast("long").alias("n_repeat_words"),
        F.length("t").cast("long").alias("n_chars"),
        *[g.cast("long").alias(f"c_{k}") for k, g in gone.items()],
        F.expr("transform(listed, r -> size(filter(common, x -> x = r)))").alias("w"),
    )
    d = d.withColumn("c_other", F.expr("n_chars - c_upper - c_lower - c_digit - c_space - c_symbol"))
    return d.select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        F.col("c_symbol").alias("n_symbols"),
        "n_dup_lines",
        "n_repeat_words",
        "n_chars",
        F.array(*[f"c_{k}" for k in (*CLASSES, "other")]).alias("classes"),
        F.expr("concat(transform(w, x -> cast(x as bigint)), array(n_words - aggregate(w, 0L, (a, x) -> a + x)))").alias("common"),
    )


def references(measured: DataFrame) -> DataFrame:
    """Per language, the summed histograms of all its documents: a few rows, however large the corpus."""
    n_class = len(CLASSES) + 1
    n_word = len(next(iter(COMMON_WORDS.values()))) + 1
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(n_class)] + [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(n_word)]
    return measured.where("common is not null").groupBy("lang").agg(*sums).select("lang", F.array(*[f"c{i}" for i in range(n_class)]).alias("ref_classes"), F.array(*[f"w{i}" for i in range(n_word)]).alias("ref_common"))


def distance(counts: str, reference: str):
    """Jensen-Shannon distance, base 2, of two count arrays; null if either is empty or sums to nothing."""
    total = "aggregate({0}, 0D, (a, x) -> a + x)"
    shares = f"zip_with({counts}, {reference}, (x, y) -> struct(x / nullif({total.format(counts)}, 0) as p, y / nullif({total.format(reference)}, 0) as q))"
    term = "if({0} > 0, {0} * log2(2 * {0} / (s.p + s.q)), 0D)"
    return F.expr(f"sqrt(abs(aggregate({shares}, 0D, (a, s) -> a + ({term.format('s.p')} + {term.format('s.q')}) / 2)))")


def quality_rules(docs: DataFrame, *, text: str = "text", lang: str = "lang", key: str = "doc_id", max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """key, the base counts, class_distance, word_distance, base_failed and kept of every row.

    base_failed: under 50 words, or over half of them in three-word windows found
    twice or more. Otherwise a row is kept unless a distance to its language's
    reference is above its limit. Texts shorter than min_chars or min_words, and
    languages without a word list (null too), are not judged on that histogram.
    References are sums over all rows. Null and empty texts fail the base rules; rows
    with a null or repeated key are judged each by itself, repeated rows alike. A very
    long text is one row's arrays of words and lines. Columns other than the key are not
    carried, whatever their names; an empty table gives no rows.
    """
    measured = frozen(features(docs, text=text, lang=lang, key=key))
    judged = measured.join(references(measured), "lang", "left")
    judged = judged.select(
        F.col("doc_id").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        F.when(F.col("n_chars") >= min_chars, distance("classes", "ref_classes")).alias("class_distance"),
        F.when(F.col("n_words") >= min_words, distance("common", "ref_common")).alias("word_distance"),
    )
    fine = F.coalesce(F.col("class_distance") <= max_class_distance, F.lit(True)) & F.coalesce(F.col("word_distance") <= max_word_distance, F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & fine)


def quality_digest(docs: DataFrame) -> DataFrame:
    q = quality_rules(docs.select("doc_id", "lang", "text"))
    return q.withColumns({"class_distance": F.round("class_distance", 6), "word_distance": F.round("word_distance", 6)})
