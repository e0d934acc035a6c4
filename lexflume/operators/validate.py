"""Report-first validation of inputs and of feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexflume.operators.audit import id_monotonic

REPORT = "check_name string, status string, severity string, blocks_pipeline boolean, observed string, expected string"


@dataclass(frozen=True)
class Check:
    name: str
    passed: bool
    severity: str
    observed: object
    expected: object

    def row(self, blocking: Sequence[str]) -> tuple:
        """A passed check is info; a failed one blocks if its severity is among the blocking ones."""
        return (self.name, "pass" if self.passed else "fail", "info" if self.passed else self.severity, not self.passed and self.severity in blocking, str(self.observed), str(self.expected))


def report(spark: SparkSession, checks: Sequence[Check], blocking: Sequence[str] = ("critical",)) -> DataFrame:
    return spark.createDataFrame([c.row(blocking) for c in checks], REPORT)


def blocks(checks: DataFrame) -> bool:
    return not checks.where("blocks_pipeline").isEmpty()


def available_representations(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Those of the wanted columns that are there, in the wanted order."""
    return [r for r in wanted if r in df.columns]


def _whole(kind: T.DataType) -> bool:
    return isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType)


def input_contract(df: DataFrame, *, id_column: str, representations: Sequence[str], reference_rows: int | None = None, drift: float = 0.25, order: str | None = None) -> list[Check]:
    """The checks of a table that features are made of: one aggregation for counts and nulls, one for each kind of repeats, one for the order, the rest from the schema."""
    has_id, there = id_column in df.columns, available_representations(df, representations)
    contract = ([id_column] if has_id else []) + there
    null = F.count_if(F.col(id_column).isNull()) if has_id else F.lit(0)
    n, missing = df.agg(F.count(F.lit(1)), null).first()
    checks = [Check("dataset_has_rows", n > 0, "critical", n, "> 0"), Check("row_count_observed", True, "info", n, n)]
    if reference_rows:
        share = abs(n - reference_rows) / reference_rows
        checks.append(Check("row_count_vs_optional_reference", share <= drift, "warning", n, reference_rows))
    checks.append(Check("id_column_present", has_id, "critical", has_id, True))
    checks += [Check(f"representation_present::{r}", r in there, "warning", r in there, True) for r in representations]
    checks.append(Check("at_least_one_representation", bool(there), "critical", len(there), ">= 1"))
    if has_id:
        repeated = _in_groups(df, [id_column])
        checks += [Check("id_missing", missing == 0, "warning", missing, 0), Check("id_duplicate_rows", repeated == 0, "warning", repeated, 0), Check("id_integer_dtype", _whole(df.schema[id_column].dataType), "warning", df.schema[id_column].dataType.simpleString(), "integer")]
        falls = id_monotonic(df, order or id_column, id_column).first()["decreases"]
        checks.append(Check("id_monotonic_order", falls == 0, "info", falls, 0))
    if contract:
        repeated = _in_groups(df, contract)
        checks.append(Check("duplicate_contract_rows", repeated == 0, "warning", repeated, 0))
    return checks


def _in_groups(df: DataFrame, columns: Sequence[str]) -> int:
    return df.groupBy(list(columns)).count().where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]


def feature_output(features: DataFrame, source: DataFrame, *, id_column: str) -> list[Check]:
    """The checks of a feature table against the rows it was made of; keys are compared as multisets, not in order."""
    names = [c for c in features.columns if c != id_column]
    kinds = {f.name: f.dataType for f in features.schema}
    numeric = [c for c in names if isinstance(kinds[c], T.NumericType)]
    floats = [c for c in numeric if isinstance(kinds[c], T.FloatType | T.DoubleType)]
    void = F.lit(0)
    for c in numeric:
        void = void + (F.col(c).isNull() | (F.isnan(c) if c in floats else F.lit(False))).cast("int")
    wild = F.lit(0)
    for c in floats:
        wild = wild + F.coalesce(F.abs(F.col(c)) == float("inf"), F.lit(False)).cast("int")
    got = features.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(void), F.lit(0)).alias("void"), F.coalesce(F.sum(wild), F.lit(0)).alias("wild")).first()
    want = source.count()
    a, b = features.select(id_column), source.select(id_column)
    moved = a.exceptAll(b).count() + b.exceptAll(a).count()
    repeated = _in_groups(features, [id_column])
    return [
        Check("id_column_present", id_column in features.columns, "critical", id_column in features.columns, True),
        Check("row_count_match", got["n"] == want, "critical", got["n"], want),
        Check("id_keys_match", moved == 0, "critical", moved, 0),
        Check("duplicate_ids", repeated == 0, "warning", repeated, 0),
        Check("has_features", len(names) > 0, "critical", len(names), ">= 1"),
        Check("all_numeric", len(numeric) == len(names), "critical", len(names) - len(numeric), 0),
        Check("nan_count", got["void"] == 0, "critical", got["void"], 0),
        Check("all_finite", got["wild"] == 0, "critical", got["wild"], 0),
    ]
