"""Sharding by extendible hashing, with DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import text_of, write_table

KEY_BITS = 60
#: Cells up to which a join may send them to every task.
FEW_CELLS = 1 << 16
OUT = ["bytes", "depth", "prefix", "overflow", "shard_bytes", "shard_docs"]


def hash_key(id_col: Column) -> Column:
    """The first 60 bits of the md5 of the id as text, as a long; null ids hash like the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def extendible_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit_bytes: int = 64 << 20, slack_bits: int = 6) -> DataFrame:
    """A row per input row: the id and OUT. (depth, prefix, overflow) names the shard.

    The directory is indexed by the leading bits of ``hash_key``. A bucket splits on the next bit while its
    texts exceed ``limit_bytes`` of UTF-8; other buckets stay as they are. Sums are taken once, at
    ``slack_bits`` more bits than the mean shard needs, and added up to every shorter prefix, so all splits of a
    round cost one aggregation; only rows under cells that are still too large go to another round.

    A bucket of one hash value can't split. It stays one shard if it is one row (a text above the limit has a
    shard of its own); else its rows are chained into overflow pages, each within the limit unless a single
    text exceeds it. Null texts have 0 bytes. Rows with equal ids share a bucket. An empty table gives no rows.
    """
    sizes = write_table(docs.select(F.col(id_col).alias("_id"), hash_key(F.col(id_col)).alias("_k"), F.octet_length(text_of(text_col)).cast("long").alias("_b")), "sizes")
    total = sizes.agg(F.sum("_b")).first()[0] or 0
    step = max(1, math.ceil(math.log2(max(1.0, total / limit_bytes)))) + slack_bits

    rows, base, found = sizes, 0, None
    while True:
        depth = min(KEY_BITS, base + step)
        cell = F.expr(f"shiftright(_k, {KEY_BITS - depth})")
        cells = write_table(
            rows.groupBy(cell.alias("_cell")).agg(F.sum("_b").alias("_b"), F.count(F.lit(1)).alias("_n"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi")),
            "cells"
        )
        # Spark judges a table by its files, which are much smaller than what it would hold of it.
        joined = (lambda t: t) if cells.count() <= FEW_CELLS else (lambda t: t.hint("merge"))
        up = cells.withColumn("_d", F.explode(F.sequence(F.lit(base), F.lit(depth)))).withColumn("_p", F.expr(f"shiftright(_cell, {depth} - _d)"))
        nodes = up.groupBy("_d", "_p").agg(F.sum("_b").alias("_b"), F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        fits = (F.col("_b") <= limit_bytes) | (F.col("_lo") == F.col("_hi"))
        split = nodes.where(~fits).select((F.col("_d") + 1).alias("_d"), F.explode(F.array(F.col("_p") * 2, F.col("_p") * 2 + 1)).alias("_p"))
        # A leaf fits and its parent doesn't; in later rounds the bucket of the round's start is known not to fit.
        leaves = nodes.where(fits).join(joined(split), ["_d", "_p"], "left_semi")
        if base == 0:
            leaves = leaves.unionByName(nodes.where(fits & (F.col("_d") == 0)))
        directory = write_table(up.select("_cell", "_d", "_p").join(joined(leaves.withColumnsRenamed({"_b": "_sb", "_n": "_sn"})), ["_d", "_p"]), "directory")
        placed = rows.withColumn("_cell", cell).join(joined(directory), "_cell").select("_id", "_b", "_d", "_p", "_sb", "_sn")
        found = placed if found is None else found.unionByName(placed)
        large = cells.where(~fits).select("_cell")
        if depth == KEY_BITS or large.isEmpty():
            break
        rows, base = write_table(rows.withColumn("_cell", cell).join(joined(large), "_cell", "left_semi").drop("_cell"), "split"), depth

    whole = (F.col("_sb") <= limit_bytes) | (F.col("_sn") == 1)
    plain = found.where(whole).withColumn("_page", F.lit(0).cast("long"))
    chained = found.where(~whole)
    if not chained.isEmpty():
        plain = plain.unionByName(_pages(write_table(chained, "chained"), limit_bytes))
    return plain.select(
        F.col("_id").alias(id_col), F.col("_b").alias("bytes"), F.col("_d").alias("depth"), F.col("_p").alias("prefix"),
        F.col("_page").alias("overflow"), F.col("_sb").alias("shard_bytes"), F.col("_sn").alias("shard_docs")
    )


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Overflow pages of buckets that can't split; running sums by lane, so no task holds a whole bucket."""
    bucket = ["_d", "_p"]
    rows = rows.withColumn("_lane", F.spark_partition_id())
    lanes = rows.groupBy(*bucket, "_lane").agg(F.sum("_b").alias("_lb"), F.max("_b").alias("_most"))
    before = Window.partitionBy(*bucket).orderBy("_lane")
    starts = lanes.select(*bucket, "_lane", (F.sum("_lb").over(before) - F.col("_lb")).alias("_start"), F.max("_most").over(Window.partitionBy(*bucket)).alias("_max"))
    inside = Window.partitionBy(*bucket, "_lane").orderBy("_id", "_b").rowsBetween(Window.unboundedPreceding, 0)
    at = rows.withColumn("_cum", F.sum("_b").over(inside) - F.col("_b")).join(starts.hint("merge"), [*bucket, "_lane"])
    chunk = F.greatest(F.lit(limit) - F.col("_max") + 1, F.lit(1))
    page = F.floor((F.col("_start") + F.col("_cum")) / chunk)
    out = at.withColumn("_page", page.cast("long")).drop("_start", "_max", "_cum", "_lane")
    sums = out.groupBy(*bucket, "_page").agg(F.sum("_b").alias("_pb"), F.count(F.lit(1)).alias("_pn"))
    return out.join(sums.hint("merge"), [*bucket, "_page"]).select("_id", "_b", *bucket, F.col("_pb").alias("_sb"), F.col("_pn").alias("_sn"), "_page")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit_bytes: int = 64 << 20) -> DataFrame:
    """Write the rows as Parquet folders ``depth=/prefix=/overflow=`` under ``path``; returns the shard of each row."""
    shards = write_table(extendible_shards(docs, id_col, text_col, limit_bytes), "shards")
    keys = ["depth", "prefix", "overflow"]
    named = docs.join(
        shards.select(F.col(id_col).alias("_sid"), *[F.col(k).alias(f"shard_{k}") for k in keys]).distinct(),
        docs[id_col].eqNullSafe(F.col("_sid"))
    ).drop("_sid")
    named.repartition(*[f"shard_{k}" for k in keys]).write.partitionBy(*[f"shard_{k}" for k in keys]).parquet(path)
    return shards
