"""JSON lines and JSON files, read leniently or with their errors."""

from __future__ import annotations

import sys
from typing import TextIO

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.saving import saved


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, ordinal: str | None = "ord") -> DataFrame:
    """Records of a JSON-lines file; blank and malformed lines are left out. ``ordinal`` is the order of lines, which
    ties depend on: rows of one file keep their order by the place of their block."""
    lines = spark.read.text(path).withColumn("_at", F.monotonically_increasing_id())
    parsed = lines.where(F.trim("value") != "").select("_at", F.try_parse_json("value").alias("_v"), F.col("value"))
    good = parsed.where(F.schema_of_variant("_v").startswith("OBJECT"))
    rows = good.select("_at", F.from_json("value", schema).alias("r")).where(F.col("r").isNotNull())
    out = rows.select("_at", "r.*")
    if ordinal:
        out = out.withColumn(ordinal, F.col("_at")) if ordinal not in schema.fieldNames() else out.withColumn(ordinal, F.coalesce(F.col(ordinal), F.col("_at")))
    return out.drop("_at")


def jsonl_errors(lines: DataFrame, value: str = "value", line: str = "line") -> DataFrame:
    """(line, value) of lines that are neither blank nor JSON."""
    return lines.where((F.trim(value) != "") & F.try_parse_json(value).isNull()).select(line, value)


def read_json_object(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row from a JSON file; none if it is missing or broken."""
    from claimloom.sources.files import _exists

    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def read_records(spark: SparkSession, place: str, schema: T.StructType, field: str | None = None, stdin: TextIO | None = None) -> DataFrame:
    """The records of one JSON document: of a file, or of standard input where ``place`` is ``-``. The document is an
    array, one record, or an object that has them under ``field``. Broken documents give no rows."""
    if place == "-":
        lines = spark.createDataFrame([((stdin or sys.stdin).read(),)], "value string")
    else:
        lines = spark.read.text(place, wholetext=True)
    return records_of(lines, schema, field)


def records_of(documents: DataFrame, schema: T.StructType, field: str | None = None, value: str = "value") -> DataFrame:
    """The records of JSON documents, one document a row, with the documents' other columns: see ``read_records``."""
    parsed = F.try_parse_json(value)
    parsed = parsed if field is None else F.try_variant_get(parsed, f"$.{field}", "variant")
    kind = F.schema_of_variant(parsed)
    text = F.to_json(parsed)
    listed = F.when(kind.startswith("ARRAY"), text).when(kind.startswith("OBJECT"), F.concat(F.lit("["), text, F.lit("]")))
    keep = [c for c in documents.columns if c != value]
    return documents.select(*keep, F.explode(F.from_json(listed, T.ArrayType(schema))).alias("r")).where("r is not null").select(*keep, "r.*")


def object_or(value: Column, schema: T.StructType, default: Column) -> Column:
    """A JSON object as a struct; ``default`` for what is no object."""
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, F.from_json(value, schema)).otherwise(default)


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, lines from 1. Lines are counted block by block, so a long file is read by many
    tasks; only the counts of a file's blocks come together."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = saved(spark.read.text(path).select(at.alias("at"), F.monotonically_increasing_id().alias("_i"), "value").select("at.*", "_i", "value"))
    counts = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("file", "block", (F.sum("_n").over(Window.partitionBy("file").orderBy("block")) - F.col("_n")).alias("_before"))
    placed = rows.withColumn("_k", F.row_number().over(Window.partitionBy("file", "block").orderBy("_i")))
    return placed.join(before, ["file", "block"]).select("file", (F.col("_before") + F.col("_k")).alias("line"), "value")


def read_jsonl_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, errors): the records with ``file`` and ``line``, and (file, line, value) of lines that are no JSON."""
    lines = numbered_lines(spark, path)
    good = lines.where((F.trim("value") != "") & F.try_parse_json("value").isNotNull())
    records = good.select("file", "line", F.from_json("value", schema).alias("r")).select("file", "line", "r.*")
    return records, lines.where((F.trim("value") != "") & F.try_parse_json("value").isNull())
