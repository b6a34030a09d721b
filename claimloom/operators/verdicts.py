"""First pass: batches, strength, verdicts, their checks and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.ranking import global_rank
from claimloom.schemas import SURVIVING, VERDICT_SCORES, VERDICTS

TOLERANCE = 0.01


def strength(score) -> Column:
    """The five merits less the noise, added in this order. ``score(name)`` gives a column."""
    first, *rest = VERDICT_SCORES
    out = F.coalesce(score(first), F.lit(0.0))
    for name in rest[:-1]:
        out = out + F.coalesce(score(name), F.lit(0.0))
    return out - F.coalesce(score(rest[-1]), F.lit(0.0))


def rule_verdict(total: Column, noise: Column) -> Column:
    """The deterministic scorer: weak or noisy candidates are rejected, middling ones wait, strong ones pass. Between
    1.5 and 2.0 the rules are silent; here such candidates wait too."""
    return F.when((total <= 0.5) | (noise >= 0.8), "reject").when(total < 2.0, "defer").otherwise("promote")


def batch_chunks(rows: DataFrame, id_col: str, size: int, cap: int) -> DataFrame:
    """``batch`` (from 0, by id; all 0 for size 0) and ``pending`` for rows past ``cap`` batches."""
    if size <= 0:
        return rows.withColumn("batch", F.lit(0).cast("long")).withColumn("pending", F.lit(False))
    ranked = global_rank(rows, id_col, out="_place")
    return ranked.withColumn("batch", F.floor(F.col("_place") / size).cast("long")).withColumn("pending", F.col("batch") >= cap).drop("_place")


def verdict_counts(scored: DataFrame) -> DataFrame:
    """A count for every verdict, 0 included."""
    return zero_filled(scored, "verdict", VERDICTS)


def zero_filled(rows: DataFrame, col: str, values: list[str]) -> DataFrame:
    every = rows.sparkSession.createDataFrame([(v,) for v in values], f"{col} string")
    return every.join(rows.groupBy(col).agg(F.count(F.lit(1)).alias("n")), col, "left").select(col, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def survivors(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("verdict").isin(SURVIVING))


def scored_candidates(verdicts: DataFrame, candidates: DataFrame, run_id: str) -> DataFrame:
    """Verdicts with what they are about; verdicts on unknown candidates keep nulls."""
    about = candidates.select("candidate_id", "text", "type_hint", "source_refs")
    return verdicts.join(about, "candidate_id", "left").withColumn("run_id", F.lit(run_id))


def only_asked(given: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """The answers to what was asked; rows on anything else, or on nothing, go."""
    return given.join(asked.select(key).distinct(), key, "left_semi").select(*given.columns)


def _rule(name: str, broken: Column) -> Column:
    return F.when(broken, F.lit(name))


def verdict_violations(verdicts: DataFrame, candidates: DataFrame, run_id: str | None = None) -> DataFrame:
    """(candidate_id, rule) for every broken rule; a batch is sound if there is none.

    All rules on a verdict's own fields are tested in one pass; ids that are repeated, unknown or missing take an
    aggregation and two anti joins.
    """
    score = lambda n: F.col("scores")[n]
    rules = [_rule("candidate_id_missing", F.coalesce(F.col("candidate_id"), F.lit("")) == "")]
    for n in VERDICT_SCORES:
        rules.append(_rule(f"score_missing:{n}", score(n).isNull()))
        rules.append(_rule(f"score_range:{n}", ~score(n).between(0.0, 1.0)))
    rules.append(_rule("strength_missing", F.col("strength").isNull()))
    rules.append(_rule("strength_formula", F.abs(F.col("strength") - strength(score)) > TOLERANCE))
    rules.append(_rule("verdict_unknown", ~F.coalesce(F.col("verdict").isin(VERDICTS), F.lit(False))))
    merges = F.coalesce(F.size("merge_candidate_ids"), F.lit(0)) > 0
    is_merge = F.coalesce(F.col("verdict") == "merge", F.lit(False))
    rules.append(_rule("merge_ids_empty", is_merge & ~merges))
    rules.append(_rule("merge_ids_populated", ~is_merge & merges))
    is_compress = F.coalesce(F.col("verdict") == "compress", F.lit(False))
    rules.append(_rule("compress_target_missing", is_compress & (F.coalesce(F.col("compress_target"), F.lit("")) == "")))
    rules.append(_rule("compress_target_populated", ~is_compress & F.col("compress_target").isNotNull()))
    if run_id is not None and "run_id" in verdicts.columns:
        rules.append(_rule("run_id_mismatch", ~F.col("run_id").eqNullSafe(F.lit(run_id))))
    own = verdicts.select("candidate_id", F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("rule"))
    ids = verdicts.where("candidate_id <> ''").select("candidate_id")
    known = candidates.select("candidate_id")
    named = lambda df, rule: df.select("candidate_id", F.lit(rule).alias("rule"))
    twice = named(ids.groupBy("candidate_id").count().where("count > 1"), "candidate_id_duplicate")
    unknown = named(ids.distinct().join(known, "candidate_id", "left_anti"), "candidate_id_unknown")
    missing = named(known.distinct().join(ids, "candidate_id", "left_anti"), "candidate_missing")
    return own.unionByName(twice).unionByName(unknown).unionByName(missing)
