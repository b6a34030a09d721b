"""The corpus pipeline: language, exact copies, near copies, mixture, sequences.

``run(spark, sf_dir)`` applies STAGES to ``documents``. Each stage is written to the shared folder and read back as
the next one's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import langid
from claimloom.llm.common import drop_tables, fold_of, tables_written, write_table
from claimloom.llm.exact_dedup import drop_copies
from claimloom.llm.jaccard_join import keep_first
from claimloom.llm.mixing import repeat_rows
from claimloom.llm.packing import pack
from claimloom.llm.queries import CAPACITY, tokenizer_path

#: A document goes if no language has at least this probability.
LEAST_PROBABILITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. Those without a letter go (null and empty texts too), and those where no
    language reaches LEAST_PROBABILITY. Where no document names a language, none is learned and all with a letter
    stay."""
    model = langid.train(docs, fold_of("doc_id", 4) != 2)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    made = ("_pipeline_lang", "_pipeline_score")
    found = langid.predict_languages(docs, model, made=made)
    return found.where((F.col(made[0]) != langid.UNKNOWN) & (F.col(made[1]) >= LEAST_PROBABILITY)).drop(*made)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the longest stays, then the one of the least id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of their five-word shingles the least id stays."""
    return keep_first(docs, shingle=5, num=80, den=100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: small sources are repeated (four times at most), nothing is dropped."""
    return repeat_rows(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of CAPACITY ids."""
    return pack(docs, tokenizer_path(), CAPACITY)


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mixture", mixture), ("sequences", sequences)]

#: The first stage's model and the tokenizer have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with tables_written() as made:
            docs = write_table(stage(spark, docs, sf_dir), name)
        # What this stage wrote on its way, and the documents it read, are not needed any more.
        drop_tables(*before, *[t for t in made if t is not docs])
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
