"""The end-to-end stages: preprocessing, row features, collection, and the inventory of methods.

Each is one lazy plan plus the reports about it. Reports are small tables and one JSON
record, written beside the result; where a check blocks, the record says why and no
result is written.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lexflume.functions import html as H
from lexflume.functions import text as X
from lexflume.functions import urls as U
from lexflume.operators import features as R
from lexflume.operators import ingest as I
from lexflume.operators import preprocess as P
from lexflume.operators import validate as V
from lexflume.plans import config as C
from lexflume.sources.files import exists, write_csv, write_record

KEPT_KEYS = ("url_key", "title_key", "description_key")


def preprocessed(df: DataFrame, *, labels: Sequence[str], language: Column | None = None, keep: str = "en", aliases: Mapping[str, Sequence[str]] = P.ALIASES, row_id: str = "source_row_id") -> tuple[DataFrame, DataFrame]:
    """(articles, accounting) of a raw article table.

    Selects the rows that mention an accepted label, cleans and combines their texts,
    drops those without any text and those in other languages, and keeps the best row
    of each article. Original columns keep their types. language: a column of language
    codes over the cleaned rows (`primary`, `fallback` are there for a detector);
    without one all rows pass.
    """
    if not labels:
        raise ValueError("no accepted labels")
    names = P.require_schema(df.columns, ("url", "title", "description", "full_text", "coin_type"), aliases)
    numbered = df if row_id in df.columns else P.assign_row_id(df, [names["url"], names["title"], names["full_text"]], row_id)
    pattern = "|".join(sorted(X.literal_pattern(x) for x in labels))
    chosen = numbered.where(P.label_mentions(F.col(names["coin_type"]), pattern))
    filtered = F.col(names["filtered_text"]) if "filtered_text" in names else F.lit(None).cast("string")
    clean = chosen.withColumns({f"{k}_clean": X.clean_text(names[k]) for k in ("title", "description", "full_text")} | {"filtered_kept": filtered})
    clean = clean.withColumns({"text_title_description": X.combined("title_clean", "description_clean"), "url_key": U.canonical_url(names["url"]), "title_key": X.title_key(names["title"]), "description_key": X.title_key(names["description"])})
    usable = P.usable_text(clean, ["text_title_description", "full_text_clean", "filtered_kept"])
    spoken = usable.withColumns({"primary": F.col("text_title_description"), "fallback": F.col("full_text_clean")})
    spoken = (spoken if language is None else P.filter_language(spoken, language, keep)).drop("primary", "fallback")
    best = P.dedup_articles(spoken, url_key="url_key", title_key="title_key", description_key="description_key", texts=["title_clean", "description_clean", "full_text_clean", "filtered_kept"], row_id=row_id)
    out = best.drop(*KEPT_KEYS, "filtered_kept")
    P.same_types(df, out)
    return out, P.accounting([("scanned", numbered), ("labelled", chosen), ("usable", usable), ("language", spoken), ("deduplicated", best)])


def preprocess(spark: SparkSession, source: DataFrame, path: str, **options) -> DataFrame:
    """preprocessed, written as Parquet with its accounting beside it; an empty selection raises and leaves nothing."""
    out, counts = preprocessed(source, **options)
    if out.isEmpty():
        raise ValueError("no row is left")
    out.write.mode("overwrite").parquet(path)
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}_accounting")
    return spark.read.parquet(path)


class Blocked(RuntimeError):
    """A check of a blocking severity failed; the stage's record says which."""


@dataclass
class Stage:
    contract: DataFrame
    features: DataFrame
    comparison: DataFrame
    output: DataFrame
    record: dict


def _summary(checks: list[V.Check], blocking: Sequence[str]) -> dict:
    failed = [c for c in checks if not c.passed]
    return {"checks": len(checks), "issues": len(failed), **{s: sum(c.severity == s for c in failed) for s in ("warning", "critical")}, "has_blockers": any(c.severity in blocking for c in failed)}


def row_feature_stage(spark: SparkSession, source: DataFrame | str, folder: str, config: Mapping = C.DEFAULTS) -> Stage:
    """Contract, comparison, row features and their validation, in folder; raises Blocked after writing why."""
    C.validate(config)
    began, blocking = time.monotonic(), config["validation"]["fail_on_severity"]
    record: dict = {"stage": "row_features", "requested": list(config["input"]["representations"])}

    def stop(reason: str) -> Blocked:
        write_record(spark, record | {"status": "blocked", "reason": reason, "seconds": round(time.monotonic() - began, 3)}, f"{folder}/record")
        return Blocked(reason)

    if isinstance(source, str):
        try:
            df = spark.read.parquet(source)
        except AnalysisException as e:
            raise stop(f"the input can't be read: {source}") from e
    else:
        df = source
    own = config["input"]
    checks = V.input_contract(df, id_column=own["id_column"], representations=own["representations"], reference_rows=own["reference_row_count"], drift=config["validation"]["row_count_warning_ratio"])
    contract = V.report(spark, checks, blocking)
    write_csv(contract.coalesce(1), f"{folder}/contract")
    record |= {"input_columns": len(df.columns), "contract": _summary(checks, blocking)}
    if record["contract"]["has_blockers"]:
        raise stop("the input breaks its contract")
    used = V.available_representations(df, own["representations"])
    record |= {"used": used, "skipped": [r for r in own["representations"] if r not in used]}
    if record["skipped"] and not config["validation"]["continue_with_available_representations"]:
        raise stop(f"representations are missing: {record['skipped']}")
    audit, made = config["audit"], config["features"]
    comparison = R.representation_comparison(df, used, short_words=audit["very_short_max_words"], short_chars=audit["very_short_max_characters"], quantile=audit["percentile"])
    rows = R.row_features(df, id_column=own["id_column"], prefixes={r: made["representation_prefixes"][r] for r in used}, currency=made["currency_symbols"], groups=made["keyword_groups"])
    rows.write.mode("overwrite").parquet(f"{folder}/candidate")
    output = spark.read.parquet(f"{folder}/candidate")
    checks = V.feature_output(output, df, id_column=own["id_column"])
    features = V.report(spark, checks, blocking)
    write_csv(features.coalesce(1), f"{folder}/features_report")
    record["features"] = _summary(checks, blocking)
    if record["features"]["has_blockers"]:
        raise stop("the features break their contract")
    write_csv(comparison.coalesce(1), f"{folder}/comparison")
    issues = record["contract"]["issues"] + record["features"]["issues"]
    record |= {"status": "completed_with_warnings" if issues else "completed", "feature_rows": output.count(), "feature_columns": len(output.columns), "seconds": round(time.monotonic() - began, 3), "output": f"{folder}/candidate"}
    write_record(spark, record, f"{folder}/record")
    return Stage(contract, features, comparison, output, record)


def collected(pages: DataFrame, *, keywords: Sequence[str], required: int = 1, existing: DataFrame | None = None, source: str = "S", mode: str = "live_http", scraped_at: str) -> tuple[DataFrame, DataFrame]:
    """(records, dead letters) of pages (html, url, and release_number, page, position of their listing).

    One candidate of each release; URLs that existing has are skipped; what can't be
    parsed is a dead letter; related articles become records and are merged with
    existing, the newest of each release, URL and content last.
    """
    fresh = I.dedup_candidates(pages)
    if existing is not None:
        fresh = I.new_urls(fresh, existing.select(F.col("canonical_url").alias("url")))
    parse = H.article_parser(list(keywords), required)
    parsed, dead = I.failed_rows(fresh.select(parse("html", "url").alias("a")).select("a.*"), "article")
    made = I.normalize_record(parsed.where("is_related"), source=source, source_type="news", method="web_scraping", mode=mode, scraped_at=scraped_at)
    new = made.withColumn("ingest_seq", F.struct(F.lit(1).alias("round"), F.col("source_row_id").alias("id")))
    old = new.limit(0) if existing is None else I.output_schema(existing).withColumn("ingest_seq", F.struct(F.lit(0).alias("round"), F.col("source_row_id").alias("id")))
    return I.merge_incremental(old, new).drop("ingest_seq"), dead


def collect(spark: SparkSession, pages: DataFrame, folder: str, **options) -> DataFrame:
    """collected with what an earlier run left in folder, written there with its dead letters, report and summary.

    A run writes a new version of the records and then names it, so a run that breaks
    leaves the one before.
    """
    latest = f"{folder}/latest"
    old = spark.read.parquet(json.loads(spark.read.text(latest).first()[0])["records"]) if exists(spark, latest) else None
    records, dead = collected(pages, existing=old, **options)
    version = f"{folder}/records-{time.time_ns()}"
    records.write.parquet(version)
    dead.write.mode("overwrite").parquet(f"{folder}/failed")
    records = spark.read.parquet(version)
    I.assert_frame(records)
    I.quality_report(records).coalesce(1).write.mode("overwrite").parquet(f"{folder}/quality")
    I.scrape_summary(records, failures=spark.read.parquet(f"{folder}/failed").count(), mode=options.get("mode", "live_http")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/summary")
    write_record(spark, {"records": version}, latest)
    return records


#: Columns of the inventory of methods.
INVENTORY = "stage string, method_family string, representation string, method string, rows long, dimensions long, storage string, elapsed_seconds double, memory_mb double, finite_values boolean, fit_scope string, semantic_quality_status string"
#: Of each kind of source its stage, family, storage and what it was fitted on.
KINDS = {
    "row_features": ("04_01", "row_level_manual", "dense_parquet", "row_local_full_dataset"),
    "tfidf": ("04_02", "tfidf", "csr_sparse_npz", "smoke_sample_only"),
    "encoder": ("04_03", "frozen_transformer", "dense_float32_npy", "frozen_external_model"),
    "reduction": ("04_03", "dimensionality_reduction", "dense_float32_npy", "train_rows_only"),
}


def method_benchmark(spark: SparkSession, sources: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row of 12 columns for each measured method: the four kinds of reports brought to one schema.

    Each report has representation, method, rows, dimensions, elapsed_seconds, memory_mb
    and finite_values (what it lacks is null); a report that isn't there gives no rows.
    """
    out = spark.createDataFrame([], INVENTORY)
    kinds = dict(x.split() for x in INVENTORY.split(", "))
    for kind, report in sources.items():
        stage, family, storage, scope = KINDS[kind]
        if report is None:
            continue
        fixed = {"stage": stage, "method_family": family, "storage": storage, "fit_scope": scope, "semantic_quality_status": "not_evaluated_in_phase4"}
        cell = lambda c: F.lit(fixed[c]) if c in fixed else F.col(c) if c in report.columns else F.lit(None)  # noqa: B023, E731
        out = out.unionByName(report.select(*[cell(c).cast(t).alias(c) for c, t in kinds.items()]))
    return out
