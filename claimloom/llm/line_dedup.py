"""Line deduplication over overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import others, text_of

OUT = ["n_lines", "n_removed", "clean_text"]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3) -> DataFrame:
    """The input's columns and OUT: lines of the text, lines removed, and the text without them.

    Lines end at ``\\n``. Every run of ``window`` consecutive lines is hashed to 128 bits. Of the places where a
    hash occurs in the table, the first by (id, hash of the text, line) stays; every later one covers its lines,
    and the union of covered lines of a document is removed. Inside one document, lines that belong to the first
    occurrence of the same window stay, so a repeated line block is left once.

    Texts with fewer lines than the window, null and empty texts lose nothing (null counts as empty, with one
    line, and comes back empty). Rows equal in id and text are one document: each gets the same result. Null ids
    come after others. An empty table gives no rows; input columns named as an output are replaced.
    """
    keyed = docs.select(
        F.struct(*[docs[c] for c in others(docs, OUT)]).alias("_row"), F.col(id_col).isNull().alias("_none"), F.col(id_col).alias("_id"),
        text_of(text_col).alias("_text")
    )
    keyed = keyed.withColumns({"_hash": F.xxhash64("_text"), "_key": F.coalesce(F.col("_id").cast("string"), F.lit(""))})
    # A generator of one row fixes the lines: lambdas that refer to an expression would evaluate it for every line.
    lines = F.explode(F.array(F.split("_text", "\n", -1))).alias("_lines")
    each = keyed.where(F.octet_length("_text") > 0).select("_none", "_id", "_key", "_hash", lines).where(F.size("_lines") >= window)
    hashed = F.transform(
        F.sequence(F.lit(1), F.size("_lines") - window + 1),
        lambda i: F.struct(F.xxhash64(F.slice("_lines", i, window)).alias("a"), F.xxhash64(F.lit(1), F.slice("_lines", i, window)).alias("b"))
    )
    windows = each.select("_none", "_id", "_key", "_hash", F.posexplode(hashed).alias("_at", "_w")).select(
        "_none", "_id", "_key", "_hash", "_at", F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b")
    )
    here = F.struct("_none", "_id", "_hash", "_at")
    firsts = windows.groupBy("_a", "_b").agg(F.min(here).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    later = windows.join(firsts, ["_a", "_b"]).where(here > F.col("_first"))
    same = F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_hash") == F.col("_first._hash"))
    start = F.when(same, F.greatest(F.col("_at"), F.col("_first._at") + window)).otherwise(F.col("_at"))
    end = F.col("_at") + window - 1
    spans = later.select("_none", "_key", "_hash", start.alias("s"), end.alias("e")).where("s <= e").distinct()
    covered = spans.groupBy("_none", "_key", "_hash").agg(F.collect_list(F.struct("s", "e")).alias("_spans"))
    covered = covered.withColumn("_gone", F.array_distinct(F.flatten(F.transform("_spans", lambda x: F.sequence(x["s"], x["e"]))))).drop("_spans")
    joined = keyed.join(covered, ["_none", "_key", "_hash"], "left").select("_row", "_text", F.explode(F.array("_gone")).alias("_gone"), lines)
    stay = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone"), lambda i: F.get("_lines", i))
    clean = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(stay, "\n"))
    return joined.select(
        "_row.*", F.size("_lines").cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        clean.alias("clean_text")
    )
