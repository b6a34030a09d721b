"""What the training-data operators share: the shared folder, written tables, helpers for columns."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words in every operator here.
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and all runs on one machine (tests) a temporary one is made and set; on a cluster
    that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="claimloom-")
        spark.sparkContext.setCheckpointDir(found)  # from now on this is what getCheckpointDir() gives
    return found.rstrip("/")


def write_table(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet (with the writer's ``options``) in the shared folder and read it back.

    The files outlive lost executors. They go by ``drop_tables``, or when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/claimloom-{tag}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    for seen in _watching:
        seen.append(out)
    return out


_watching: list[list[DataFrame]] = []


@contextmanager
def tables_written() -> Iterator[list[DataFrame]]:
    """The tables that ``write_table`` makes meanwhile, for who wants to delete them."""
    seen: list[DataFrame] = []
    _watching.append(seen)
    try:
        yield seen
    finally:
        _watching.remove(seen)


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of ``write_table`` that nothing still to be computed reads."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(t._written_at)
        at.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def thrifty(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``; after its task the worker gives the memory it no longer needs back to the system,
    since workers wait for a minute and others run beside them."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    """Free memory that the allocators of this process keep (the C one only where it can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Hand texts to Python in batches of at most ``rows`` rows and about ``size`` bytes, for the rest of the session:
    whole texts are long, and a task holds a batch several times over."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        now = (spark.conf.get(key) or "").rstrip("b")
        if not now.lstrip("-").isdigit() or int(now) <= 0 or int(now) > most:
            spark.conf.set(key, str(most))


_WHITE = re.compile(r"\s")
#: Characters of a text whose words are listed at once.
SLICE = 1 << 20


def slices(text: str) -> Iterator[str]:
    """The text in parts of about SLICE characters, cut before white space, so that no word is cut. What a text's words
    take beside the text itself does then not grow with it, unless it has no white space."""
    at = 0
    while len(text) - at > SLICE:
        found = _WHITE.search(text, at + SLICE)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def text_of(col: str | Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids fall in fold -1, which nothing holds out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(-1))


def others(df: DataFrame, made: list[str]) -> list[str]:
    """Columns to carry along: an input column named as an output is replaced by it."""
    low = {c.lower() for c in made}
    return [c for c in df.columns if c.lower() not in low]
