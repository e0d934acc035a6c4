"""File sources and sinks with explicit schemas."""

from __future__ import annotations

import csv
import json
import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header, quoted line ends and doubled quotes; a file is one task because of the line ends."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "").options(**_WHOLE).csv(path)


_WHOLE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_WRITTEN = {"escape": '"', "quoteAll": "true", "nullValue": "\u0000", "emptyValue": "", **_WHOLE}


def write_csv(df: DataFrame, path: str, *, bom: bool = False) -> None:
    """CSV with a header, all quoted; a folder that appears whole, by the commit of its write. bom: each file begins with a byte order mark."""
    if not bom:
        df.write.mode("overwrite").option("header", True).options(**_WRITTEN).csv(path)
        return
    head = "\ufeff" + ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)

    def topped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([head])], names=["value"])
        yield from batches

    lines = df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), _WRITTEN).alias("value"))
    lines.mapInArrow(topped, "value string").write.mode("overwrite").text(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table. One in a single file is dealt out to all cores: its few row groups would be the work of as few tasks, whatever comes after."""
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if cores > 1 and len(df._jdf.inputFiles()) == 1 else df


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One record a line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names only: the first line is read; names may be quoted and hold commas."""
    line = spark.read.text(path).first()[0]
    return next(csv.reader([line.removeprefix("\ufeff")]))


def write_jsonl(df: DataFrame, path: str) -> None:
    """One record a line with its keys in order."""
    df.select(as_record(df).alias("value")).write.mode("overwrite").text(path)


def as_record(df: DataFrame) -> Column:
    """A row as JSON with its keys in order, nulls too."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def write_record(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON record, as the only line of a text table."""
    spark.createDataFrame([(json.dumps(record, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_existing(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A CSV table that may not be there yet."""
    return read_csv(spark, path, schema) if exists(spark, path) else None


def first_that_exists(spark: SparkSession, candidates: list[str]) -> str:
    found = next((p for p in candidates if exists(spark, p)), None)
    if found is None:
        raise FileNotFoundError(f"none of {candidates} is there")
    return found


def inside(root: str, relative: str) -> str:
    """The path under root; ValueError for one that leads out of it."""
    path = posixpath.normpath(posixpath.join(root, relative))
    if path != posixpath.normpath(root) and not path.startswith(posixpath.normpath(root) + "/"):
        raise ValueError(f"{relative!r} leads out of {root}")
    return path


def head_sample(df: DataFrame, order: str, n: int, columns: list[str] | None = None) -> DataFrame:
    return df.select(columns or df.columns).orderBy(order).limit(n)


def format_size(size: Column) -> Column:
    """Bytes as text in B, KB, MB or GB with two decimals."""
    v = size.cast("double")
    scaled = [F.concat(F.format_string("%.2f", F.floor(v / (1024.0**k) * 100 + 0.5) / 100), F.lit(f" {u}")) for k, u in enumerate(("B", "KB", "MB", "GB"))]
    return F.when(v < 1024, scaled[0]).when(v < 1024.0**2, scaled[1]).when(v < 1024.0**3, scaled[2]).otherwise(scaled[3])


def file_metadata(spark: SparkSession, path: str) -> DataFrame:
    f = spark.read.format("binaryFile").load(path)
    return f.select("path", "length", (F.col("length") / 1024**2).alias("mb"), (F.col("length") / 1024**3).alias("gb"), format_size(F.col("length")).alias("size"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, for tables that go through files."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return posixpath.join(root, f"lexflume-{name}-{uuid.uuid4().hex}")
