"""The registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lexflume.llm._common import documents

#: Name of the public tokenizer file that the token contracts fix.
VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    """Content of a public tokenizer file, read once on the driver."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.token_counts import token_count_digest

    return token_count_digest(documents(spark, sf_dir), vocabulary())


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.license_scan import license_scan

    return license_scan(documents(spark, sf_dir))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.jaccard_join import similar_documents

    return similar_documents(documents(spark, sf_dir))


def op4_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.span_dedup import span_dedup

    return span_dedup(documents(spark, sf_dir).select("doc_id", "text"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.quality_classifier import quality_classifier

    return quality_classifier(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.packing import packing_digest

    return packing_digest(documents(spark, sf_dir), vocabulary())


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.mixing import mix

    return mix(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.quality_rules import quality_digest

    return quality_digest(documents(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.suffix_dedup import suffix_digest

    return suffix_digest(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexflume.llm.exact_dedup import exact_digest

    return exact_digest(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scan": op2_license_scan,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_span_dedup": op4_span_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_exact_dedup": op10_exact_dedup,
}

def _license_sql() -> str:
    from lexflume.llm.license_scan import COPYRIGHT_LINE, EQUIVALENT, KNOWN

    def canonical(text: str) -> str:
        t = f"trim(regexp_replace(regexp_replace(chr(10) || lower({text}), '{COPYRIGHT_LINE}', '', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        for spelling, one in EQUIVALENT:
            t = f"replace({t}, '{spelling}', '{one}')"
        return f"sha256({t})"

    known = ", ".join("('{}', '{}')".format(i, x.replace("'", "''")) for i, x in KNOWN)
    return f"""
        WITH known AS (SELECT {canonical('t')} AS digest, min(i) AS license_id FROM (VALUES {known}) k(i, t) GROUP BY 1),
        whole AS (SELECT doc_id, {canonical("coalesce(text, '')")} AS digest FROM documents),
        lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
        notices AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids, count(*) AS n_notice_lines
                    FROM (SELECT doc_id, {canonical('line')} AS digest FROM lines) JOIN known USING (digest) GROUP BY doc_id)
        SELECT w.doc_id, w.digest, k.license_id, n.notice_ids, coalesce(n.n_notice_lines, 0) AS n_notice_lines
        FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN notices n ON w.doc_id = n.doc_id
    """


def _mixing_sql() -> str:
    from lexflume.llm.mixing import SEED, TEMPERATURE

    return f"""
        WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        rates AS (SELECT source, (SELECT sum(n) FROM counts) * pow(n, {TEMPERATURE}) / (SELECT sum(pow(n, {TEMPERATURE})) FROM counts) / n AS rate FROM counts),
        terms AS (SELECT source, rate, unnest(range(0, cast(ceil(rate + 12 * sqrt(rate) + 30) AS bigint) + 1)) AS k FROM rates),
        logs AS (SELECT source, k, k * ln(rate) - rate - sum(ln(greatest(k, 1))) OVER (PARTITION BY source ORDER BY k) AS log_p FROM terms),
        cdf AS (SELECT source, list(c ORDER BY c) AS cdf FROM (SELECT source, sum(exp(log_p)) OVER (PARTITION BY source ORDER BY k) AS c FROM logs) GROUP BY source),
        drawn AS (SELECT d.*, len(list_filter(cdf, lambda c: c <= cast('0x' || substr(md5('{SEED}:' || doc_id), 1, 13) AS bigint) / pow(2, 52))) AS m
                  FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source),
        copies AS (SELECT doc_id, text, lang, source, n_chars, cast(unnest(range(0, m)) AS integer) AS copy FROM drawn)
        SELECT *, md5('{SEED}:' || doc_id || ':' || copy) AS shuffle_key FROM copies
    """


def _quality_sql() -> str:
    from lexflume.llm.quality_rules import CLASSES, COMMON_WORDS, MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_WORDS

    classes = [f"length(t) - length(regexp_replace(t, '{c}', '', 'g'))" for c in CLASSES.values()]
    listed = " ".join(f"WHEN '{k}' THEN {v}" for k, v in COMMON_WORDS.items())
    n_class, n_word = len(CLASSES) + 1, 1 + len(next(iter(COMMON_WORDS.values())))

    def distance(counts: str, ref: str, n: int) -> str:
        p, q = [f"({counts}[{i}] / list_sum({counts}))" for i in range(1, n + 1)], [f"({ref}[{i}] / list_sum({ref}))" for i in range(1, n + 1)]
        term = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({1} + {2})) ELSE 0 END"
        return "sqrt(greatest(0, " + " + ".join(f"({term.format(a, a, b)} + {term.format(b, a, b)}) / 2" for a, b in zip(p, q, strict=True)) + "))"

    return f"""
        WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
                          list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
        win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
        keyed AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM win),
        rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM keyed WHERE n > 1) GROUP BY doc_id),
        f AS (SELECT d.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) AS n_chars,
                     len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, w,
                     [{', '.join(classes)}] AS c5, CASE lang {listed} END AS listed
              FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
        g AS (SELECT *, list_append(c5, n_chars - list_sum(c5)) AS c, list_transform(listed, lambda r: len(list_filter(w, lambda x: x = r))) AS w8 FROM f),
        h AS (SELECT *, list_append(w8, n_words - list_sum(w8)) AS wc FROM g),
        ref AS (SELECT lang, [{', '.join(f'sum(c[{i}])' for i in range(1, n_class + 1))}] AS rc, [{', '.join(f'sum(wc[{i}])' for i in range(1, n_word + 1))}] AS rw FROM h WHERE listed IS NOT NULL GROUP BY lang),
        j AS (SELECT h.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                     CASE WHEN n_chars >= {MIN_CHARS} THEN {distance('c', 'rc', n_class)} END AS class_distance,
                     CASE WHEN n_words >= {MIN_WORDS} THEN {distance('wc', 'rw', n_word)} END AS word_distance
              FROM h LEFT JOIN ref ON h.lang = ref.lang)
        SELECT doc_id, n_words, word_chars, cast(c[5] AS bigint) AS n_symbols, n_dup_lines, n_repeat_words, base_failed, round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance,
               NOT base_failed AND coalesce(class_distance <= {MAX_CLASS_DISTANCE}, true) AND coalesce(word_distance <= {MAX_WORD_DISTANCE}, true) AS kept
        FROM j
    """


ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": _license_sql(),
    "op7_mixing": _mixing_sql(),
    "op8_quality_rules": _quality_sql(),
    "op10_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents),
        r AS (SELECT doc_id, t,
                     first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY t) AS group_size
              FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM r
    """,
}
