"""Exact dedup by distributed most-significant-first radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexflume.llm._common import WS, compact, frozen, nested, text_or_empty, tidy

#: Bytes that the first pass splits on, and by how much each later pass takes more.
FIRST_BYTES, WIDER = 128, 16


def exact_groups(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns key, _row, n_codepoints, sha256 and gid: rows share a gid if and only if their normalised texts are equal.

    The normalised text (without ASCII white space; null is empty) is split byte
    run by byte run: rows that agree on all bytes so far are a group, a group of one
    is done, and so is a group whose text has ended. Comparing bytes decides; the
    digest is an output only. Each pass takes WIDER times more bytes, so texts of up
    to 2 GB need at most seven. A pass is a map-side count of (group, bytes), kept for
    groups of two and more, and a join back whose hot keys AQE may split; only the rest of texts that still agree
    goes on, through the shared checkpoint folder. Group labels of each pass and of
    single rows can't meet, whichever way a scan numbers its rows.
    """
    norm = F.regexp_replace(text_or_empty(text), f"{WS}+", "")
    rows = docs.select(
        F.col(key),
        F.monotonically_increasing_id().alias("_row"),
        F.char_length(text_or_empty(text)).cast("long").alias("n_codepoints"),
        norm.alias("_norm"),
    ).select(key, "_row", "n_codepoints", F.sha2(F.col("_norm").cast("binary"), 256).alias("sha256"), F.lit(0).cast("long").alias("gid"), F.col("_norm").cast("binary").alias("_rest"))
    plain, done, width, passes = [key, "_row", "n_codepoints", "sha256"], [], FIRST_BYTES, 0
    while True:
        cut = rows.select(*plain, "gid", F.substring("_rest", 1, width).alias("_head"), "_rest")
        heads = compact(cut.groupBy("gid", "_head").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
        met = cut.join(heads, ["gid", "_head"], "left")
        more = (F.col("_n") > 1) & (F.octet_length("_head") == width)
        met = frozen(met.select(*plain, F.coalesce(16 * F.col("_first") + passes, -1 - F.col("_row")).alias("gid"), F.coalesce(more, F.lit(False)).alias("_more"), F.when(more, F.expr(f"substring(_rest, {width + 1})")).alias("_rest")))
        done.append(met.where("not _more").select(*plain, "gid"))
        rows = met.where("_more").select(*plain, "gid", "_rest")
        ended = rows.isEmpty()
        tidy(docs.sparkSession)
        if ended:
            return reduce(DataFrame.unionByName, done)
        width *= WIDER
        passes += 1


def exact_dedup(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256 (of the normalised text), _row.

    Of equal texts the row with the most code points stays, then the smallest key; a
    null key comes last, and of rows equal in both the first one read. Empty and null
    texts equal each other; very long texts are split like others, a run of bytes at a
    time. Columns other than the key are not carried, whatever their names. An empty
    table gives no rows.
    """
    rows = exact_groups(docs, text=text, key=key)
    order = F.struct((-F.col("n_codepoints")).alias("c"), F.col(key).isNull().alias("z"), F.col(key).alias("k"), F.col("_row").alias("r"))
    best = rows.groupBy("gid").agg(F.min(order).alias("_best"), F.count(F.lit(1)).alias("group_size")).select("gid", "_best", "group_size")
    joined = rows.join(compact(best), "gid")
    return joined.select(key, F.col("_best.k").alias("keep_id"), "group_size", (F.col("_row") == F.col("_best.r")).alias("kept"), F.col("sha256").alias("text_sha256"), "_row")


def drop_exact_copies(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each group of equal texts, the one that exact_dedup keeps, with all columns whatever their names.

    Rows are told apart by key and text; of rows equal in both, any one stays. Only
    rows of groups of two and more are looked up again, by key and a hash of the text.
    Null and empty texts are one group; an empty table gives no rows.
    """
    def ident(k: str, t: str) -> Column:
        return F.struct(F.col(k).isNull().alias("none"), F.col(k).alias("key"), F.xxhash64(F.coalesce(F.col(t), F.lit(""))).alias("tag")).alias("id")

    told = exact_dedup(docs.select(ident(f"`{key}`", f"`{text}`"), F.col(f"`{text}`").alias("text")), text="text", key="id").where("group_size > 1")
    told = frozen(told.groupBy("id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("not kept or n > 1").select(F.col("id").alias("of"), "kept"))
    rows = nested(docs).select("row", ident(f"row.`{key}`", f"row.`{text}`"))
    same = F.expr("id.key <=> of.key and id.tag = of.tag")
    alone = rows.join(told, same, "left_anti").select("row.*")
    repeated = told.where("kept")
    if repeated.isEmpty():
        return alone
    return alone.unionByName(rows.join(repeated, same, "left_semi").groupBy("id").agg(F.first("row").alias("row")).select("row.*"))


def exact_digest(docs: DataFrame) -> DataFrame:
    return exact_dedup(docs.select("doc_id", "text")).drop("_row")
