"""Text sources from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.text import lenient_text
from claimloom.schemas import DENIED_DIRS, DENIED_FILES, EPISODE_DIR, PERSONAL_SOURCES, SHARED_SOURCES

FILES = "path string, bytes long, mtime_utc string, content_hash string, text string"


def is_denied(path: Column) -> Column:
    """Is it one of the files or folders that are never read?"""
    out = F.col("path").isin(DENIED_FILES) if path is None else path.isin(DENIED_FILES)
    for d in DENIED_DIRS:
        out = out | path.startswith(d)
    return out


def read_sources(spark: SparkSession, workspace: str) -> DataFrame:
    """All markdown files of a workspace and its episodes: FILES. Bytes that are no UTF-8 become replacement marks."""
    root = workspace.rstrip("/")
    found = None
    for place, prefix in ((root, ""), (f"{root}/{EPISODE_DIR.rstrip('/')}", EPISODE_DIR)):
        if not _exists(spark, place):
            continue
        part = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").option("recursiveFileLookup", "false").load(place)
        part = part.withColumn("name", F.concat(F.lit(prefix), F.element_at(F.split("path", "/"), -1)))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], FILES)
    stamp = F.concat(F.date_format(F.to_utc_timestamp("modificationTime", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return found.select(
        F.col("name").alias("path"), F.col("length").alias("bytes"), stamp.alias("mtime_utc"),
        F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("content_hash"), lenient_text(F.col("content")).alias("text")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def allowed_sources(profile: str) -> list[str]:
    return SHARED_SOURCES + (PERSONAL_SOURCES if profile == "personal" else [])


def discover(files: DataFrame, profile: str, checked: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(found, missing, denied): the allowed files that are there, those that aren't with a severity, and which of the
    paths named in ``checked`` are never read."""
    names = allowed_sources(profile)
    found = files.where((F.col("path").isin(names) | F.col("path").startswith(EPISODE_DIR)) & ~is_denied(F.col("path")))
    every = files.sparkSession.createDataFrame([(n, "warn" if n in SHARED_SOURCES else "info") for n in names], "path string, severity string")
    missing = every.join(found.select("path"), "path", "left_anti")
    asked = files.sparkSession.createDataFrame([(p,) for p in checked or []], "path string")
    return found, missing, asked.where(is_denied(F.col("path")))


def fingerprints(documents: DataFrame, path: Column, text: Column) -> DataFrame:
    """An inventory of texts held in a table: path, bytes, content_hash."""
    return documents.select(path.alias("path"), F.octet_length(text).cast("long").alias("bytes"), F.concat(F.lit("sha256:"), F.sha2(text, 256)).alias("content_hash"))


def text_schema() -> T.StructType:
    return T.StructType([T.StructField("path", T.StringType()), T.StructField("text", T.StringType())])
