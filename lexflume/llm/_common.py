"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexflume.sources.files import read_table

#: ASCII white space, the only separators that the word contracts know.
WS = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def columns_of(df: DataFrame) -> list[Column]:
    """df's columns, whatever signs their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def nested(df: DataFrame, name: str = "row") -> DataFrame:
    """df's rows as one struct, so that no name of theirs can meet one of an operator's."""
    return df.select(F.struct(*columns_of(df)).alias(name))


def shielded(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """df with its columns of these names renamed, and the columns that give df back."""
    taken, out, back = {c.lower() for c in df.columns} | {n.lower() for n in names}, [], []
    for c, name in zip(columns_of(df), df.columns, strict=True):
        aside = name
        if name.lower() in {n.lower() for n in names}:
            while aside.lower() in taken:
                aside += "_aside"
            taken.add(aside.lower())
        out.append(c.alias(aside))
        back.append(F.col("`" + aside.replace("`", "``") + "`").alias(name))
    return df.select(*out), back


def shared_folder(spark: SparkSession, make: str) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir. On one machine a new folder stands in for it; on a cluster it must be set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=f"lexflume-{make}-")


def frozen(df: DataFrame) -> DataFrame:
    """df computed once and kept in the cluster's shared checkpoint folder.

    The folder is the session's spark.checkpoint.dir. Only where that is unset
    (tests on one machine) a folder of our own is set.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoint"))
    return df.checkpoint(eager=True)


def compact(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """frozen, in about one partition for so many rows, so that what follows doesn't write a file for each empty one."""
    kept = frozen(df)
    return kept.coalesce(max(1, -(-kept.count() // rows)))


def tidy(spark: SparkSession) -> None:
    """Collects garbage, on which Spark deletes the shuffle files and checkpoints of frames that are gone.

    A driver with much free memory hardly ever does so by itself, and a chain of
    stages then keeps the files of all of them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as a Parquet table in the shared checkpoint folder; smaller there than a checkpoint."""
    spark = df.sparkSession
    path = f"{shared_folder(spark, 'tables')}/lexflume-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Edges that one task joins in memory (two numbers each) before they are passed on as stars.
LOCAL_EDGES = 500_000


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            a, c = root(u), root(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    stars = [(x, root(x)) for x in list(parent)]
    stars = [(x, r) for x, r in stars if x != r]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in stars], pa.int64()), pa.array([r for _, r in stars], pa.int64())], names=["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; component is its smallest reachable node.

    Every task first joins what it holds, at most about LOCAL_EDGES edges, into stars.
    That is all for a graph of one task. Beyond, alternating stars follow: each
    node's larger neighbours, then its smaller ones, are hung under its smallest
    neighbour until nothing moves; these are aggregations with map-side minima and
    joins that AQE may split on hot nodes, checkpointed between rounds.
    """
    e = frozen(edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v"))
    parts = max(1, -(-e.count() // LOCAL_EDGES))
    e = frozen(e.coalesce(parts).mapInArrow(_local_stars, "u long, v long"))
    while parts > 1 and not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("lo")).select("u", F.least("u", "lo").alias("lo"))
        large = frozen(both.join(low, "u").where("v > u and v <> lo").select(F.col("v").alias("u"), F.col("lo").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("lo"))
        small = large.join(low, "u")
        e = frozen(small.select("u", F.col("lo").alias("v")).unionByName(small.where("v <> lo").select(F.col("v").alias("u"), F.col("lo").alias("v"))).distinct())
        # Stars at last: no node is at once a child and a parent, and each child has one parent.
        if e.select("u").intersect(e.select("v")).isEmpty() and e.groupBy("u").count().where("count > 1").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
