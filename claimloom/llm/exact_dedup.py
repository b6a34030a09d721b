"""Exact deduplication by content sort, with DataFrame operations only.

Normalised texts are range-partitioned by sampled splitters, sorted inside each range (Spark's external
sort spills), and equal neighbours become one run: the window below compares the full normalised text of
each row with the one before it. The splitters see only the first characters and a 64-bit hash, so that
what is sampled to the driver is small however long the texts are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import SPACE, others, text_of

OUT = ["keep_id", "group_size", "kept", "text_sha256"]
SPLIT_CHARS = 24


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = True) -> DataFrame:
    """One row per input row: its own columns (``carry``) or only the id, and OUT.

    Texts are equal when identical without ``[\\x20\\x09-\\x0D]``. Of equal texts the row with the most code
    points before normalising stays, then the smallest id (null ids last).

    Null texts count as empty; empty texts form one group like any other text. Repeated rows with the same
    id are members of their group like others, and exactly one of a group is ``kept``. An empty table gives
    an empty result. Input columns named as an output are replaced; other columns pass through unread.

    A text with more rows than a quarter of the mean range is hot. There are at most four hot texts per
    range, so their list is bounded by the number of ranges and not by the data. Rows of hot texts are
    salted over the ranges, and their group is summed apart, with partial sums before its shuffle.
    """
    names = others(docs, OUT) if carry else [id_col]
    found = _grouped(docs, id_col, text_col, list(docs.columns) if carry else [id_col])
    return found.select(*[F.col("_row")[c].alias(c) for c in names], *OUT)


def _grouped(docs: DataFrame, id_col: str, text_col: str, mine: list[str]) -> DataFrame:
    """``_row``, a struct of the columns ``mine``, and OUT. A text among them is shuffled once, inside the struct."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    norm = F.regexp_replace(text_of(text_col), SPACE, "")
    best = F.struct((-F.char_length(text_of(text_col))).alias("p"), F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"))

    hashes = docs.select(F.xxhash64(norm).alias("_h"))
    limit = max(64, docs.count() // (4 * parts))
    hot = hashes.groupBy("_h").count().where(F.col("count") > limit).select("_h", F.ceil(F.col("count") / limit).alias("_pieces"))

    inside = text_col in mine
    rows = docs.select(F.struct(*[docs[c] for c in mine]).alias("_row"), docs[id_col].alias("_id"), *([] if inside else [docs[text_col].alias("_text")]))
    text = text_of(F.col("_row")[text_col] if inside else "_text")
    norm_of = F.regexp_replace(text, SPACE, "")
    keyed = rows.withColumns({"_h": F.xxhash64(norm_of), "_first": F.substring(norm_of, 1, SPLIT_CHARS)}).join(F.broadcast(hot), "_h", "left")
    keyed = keyed.withColumn("_salt", F.when(F.col("_pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64("_id"), "_pieces")))
    ranged = keyed.repartitionByRange("_first", "_h", "_salt").withColumn("_norm", norm_of)

    run = Window.partitionBy("_first", "_h", "_salt", "_norm")
    order = run.orderBy(-F.char_length(text), F.col("_id").isNull(), "_id")
    runs = ranged.select(
        "_row", "_pieces", "_id", F.sha2("_norm", 256).alias("text_sha256"),
        F.row_number().over(order).alias("_rn"), F.first("_id").over(order).alias("_keep"), F.count(F.lit(1)).over(run).alias("_size"),
        F.char_length(text).alias("_points"),
    )

    # Hot texts: partial sums before the shuffle, full comparison of the normalised text.
    sums = (
        docs.select(F.xxhash64(norm).alias("_h"), norm.alias("_norm"), best.alias("_best"))
        .join(F.broadcast(hot), "_h", "left_semi").groupBy("_norm").agg(F.min("_best").alias("_best"), F.count(F.lit(1)).alias("_all"))
        .select(F.sha2("_norm", 256).alias("text_sha256"), F.lit(True).alias("_hot"), F.col("_best.p").alias("_p"), F.col("_best.i").alias("_first_id"), "_all")
    )
    joined = runs.join(F.broadcast(sums), "text_sha256", "left")
    is_hot = F.col("_pieces").isNotNull()
    # The kept row of a hot text leads its own salted run, so rows repeated with the same id keep one.
    kept = F.when(is_hot, (F.col("_rn") == 1) & F.col("_id").eqNullSafe(F.col("_first_id")) & (F.col("_points") == -F.col("_p"))).otherwise(F.col("_rn") == 1)
    return joined.select(
        "_row", F.when(is_hot, F.col("_first_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.when(is_hot, F.col("_all")).otherwise(F.col("_size")).alias("group_size"), kept.alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows with the input's columns (see ``exact_dedup``); clashing input names survive here."""
    return _grouped(docs, id_col, text_col, list(docs.columns)).where("kept").select("_row.*")
