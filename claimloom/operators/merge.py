"""The claim store: upsert, supersession, retirement, and the tables made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.ranking import segments
from claimloom.operators.resolve import active
from claimloom.schemas import HOMES, INACTIVE

CONTRADICTION_KEY = ["contradiction_cluster_id", "claim_id", "competing_claim_id", "competing_text"]


def upsert_claims(prior: DataFrame, new: DataFrame, last: int | None = None) -> DataFrame:
    """Both by id: the last new row of an id replaces all others, and keeps the place of the prior one; rows without
    an id go. ``ord`` of new claims starts after ``last``, by default the greatest of the prior ones."""
    last = prior.agg(F.max("ord")).first()[0] if last is None else last
    shifted = new.withColumn("_place", F.lit(0 if last is None else last + 1).cast("long") + F.col("ord"))
    rows = prior.withColumn("_place", F.col("ord")).withColumn("_gen", F.lit(0)).unionByName(shifted.withColumn("_gen", F.lit(1))).where(F.col("id") != "")
    same = Window.partitionBy("id")
    ranked = rows.withColumn("_rn", F.row_number().over(same.orderBy(F.desc("_gen"), F.desc("ord")))).withColumn("_first", F.min("_place").over(same))
    return ranked.where("_rn = 1").withColumn("ord", F.col("_first")).drop("_rn", "_first", "_place", "_gen")


def supersession_edges(new: DataFrame) -> DataFrame:
    """(target, by, ord, pos): what new claims supersede, themselves left out."""
    rows = new.select(F.col("id").alias("by"), "ord", F.posexplode("supersedes").alias("pos", "target"))
    return rows.where(F.col("target") != F.col("by"))


def apply_supersession(claims: DataFrame, new: DataFrame, run_id: str) -> DataFrame:
    """Targets become superseded, and the ids that supersede them are appended in order, each once."""
    order = F.array_sort(F.collect_list(F.struct("ord", "pos", "by")))
    by = supersession_edges(new).groupBy(F.col("target").alias("id")).agg(F.array_distinct(F.transform(order, lambda x: x["by"])).alias("_by"))
    joined = claims.join(by, "id", "left")
    hit = F.col("_by").isNotNull()
    had = F.coalesce("superseded_by", F.array().cast("array<string>"))
    return joined.withColumns({
        "superseded_by": F.when(hit, F.concat(had, F.array_except("_by", had))).otherwise(F.col("superseded_by")),
        "status": F.when(hit, "superseded").otherwise(F.col("status")),
        "updated_in_run_id": F.when(hit, F.lit(run_id)).otherwise(F.col("updated_in_run_id")),
    }).select(*claims.columns)


def chain_warnings(new: DataFrame, prior: DataFrame) -> DataFrame:
    """(new_id, target, successor): new claims that supersede a prior one that was superseded before."""
    edges = new.select(F.col("id").alias("new_id"), F.explode("supersedes").alias("target"))
    gone = prior.where("status = 'superseded'").select(
        F.col("id").alias("target"), F.coalesce(F.try_element_at("superseded_by", F.lit(-1)), F.lit("unknown")).alias("successor")
    )
    return edges.join(gone, "target").select("new_id", "target", "successor")


def unsourced(claims: DataFrame, removed: DataFrame) -> DataFrame:
    """(id, _paths): active claims all of whose sources are in ``removed`` (path), and these."""
    sources = active(claims).select("id", F.explode("provenance").alias("p")).select("id", F.col("p.source").alias("path")).where(F.col("path") != "").distinct()
    marked = sources.join(removed.select("path").distinct().withColumn("_gone", F.lit(1)), "path", "left")
    each = marked.groupBy("id").agg(F.min(F.coalesce("_gone", F.lit(0))).alias("_all"), F.array_sort(F.collect_list("path")).alias("_paths"))
    return each.where("_all = 1").select("id", "_paths")


def retire_unsourced(claims: DataFrame, removed: DataFrame, run_id: str) -> DataFrame:
    """Active claims all of whose sources are in ``removed`` (path) become candidates for retirement, with the reason."""
    lost = unsourced(claims, removed)
    joined = claims.join(lost, "id", "left")
    hit = F.col("_paths").isNotNull()
    reason = F.array(F.struct(F.lit(run_id).alias("run_id"), F.lit("all_sources_removed").alias("reason"), F.col("_paths").alias("removed_sources")))
    return joined.withColumns({
        "retirement_reasons": F.when(
            hit, F.concat(F.coalesce("retirement_reasons", F.array().cast(claims.schema["retirement_reasons"].dataType)), reason)
        ).otherwise(F.col("retirement_reasons")),
        "status": F.when(hit, "retire_candidate").otherwise(F.col("status")),
        "updated_in_run_id": F.when(hit, F.lit(run_id)).otherwise(F.col("updated_in_run_id")),
    }).select(*claims.columns)


def contradiction_cluster_id(claim_id: Column) -> Column:
    """The same on every run, so that reruns add no duplicates."""
    return F.concat(F.lit("contra-"), F.substring(F.sha2(claim_id, 256), 1, 12))


def contradiction_rows(new: DataFrame, run_id: str) -> DataFrame:
    """One row for each claim and what competes with it."""
    rows = new.select("ord", F.col("id").alias("claim_id"), F.posexplode("contradictions").alias("pos", "c"))
    return rows.select(
        "ord", "pos", contradiction_cluster_id(F.col("claim_id")).alias("contradiction_cluster_id"), "claim_id",
        F.col("c.competing_claim_id").alias("competing_claim_id"), F.col("c.competing_text").alias("competing_text"),
        F.col("c.relation").alias("relation"), F.coalesce(F.col("c.flagged_in_run_id"), F.lit(run_id)).alias("flagged_in_run_id")
    )


def merge_contradictions(prior: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct by CONTRADICTION_KEY (null equals null): the last row wins."""
    rows = prior.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)))
    last = Window.partitionBy(*CONTRADICTION_KEY).orderBy(F.desc("_gen"), F.desc("ord"), F.desc("pos"))
    return rows.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn", "_gen")


def entity_rows(claims: DataFrame) -> DataFrame:
    """(subject, claim_id): what ``entities`` gathers, a row each, so that a common subject is no long array."""
    return claims.where(F.col("subject") != "").select("subject", F.col("id").alias("claim_id")).distinct()


def route_rows(claims: DataFrame) -> DataFrame:
    """(home, claim_id) of active claims; a home without any has one row with a null id."""
    found = active(claims).where(F.col("primary_home").isNotNull()).select(F.col("primary_home").alias("home"), F.col("id").alias("claim_id"))
    every = claims.sparkSession.createDataFrame([(h,) for h in HOMES], "home string")
    return found.unionByName(every.join(found.select("home").distinct(), "home", "left_anti").withColumn("claim_id", F.lit(None).cast("string")))


def entities(claims: DataFrame) -> DataFrame:
    """(subject, claim_ids): ids of all claims, inactive ones too, of each subject as written."""
    return claims.where(F.col("subject") != "").groupBy("subject").agg(F.array_sort(F.collect_set("id")).alias("claim_ids"))


def routes(claims: DataFrame) -> DataFrame:
    """(home, claim_ids): sorted ids of active claims; every home is there."""
    every = claims.sparkSession.createDataFrame([(h,) for h in HOMES], "home string")
    found = active(claims).groupBy(F.col("primary_home").alias("home")).agg(F.array_sort(F.collect_list("id")).alias("claim_ids"))
    return every.join(found, "home", "left").select("home", F.coalesce("claim_ids", F.array().cast("array<string>")).alias("claim_ids"))


def entity_segments(claims: DataFrame, size: int) -> DataFrame:
    """(subject, segment, items): ``entities`` in lists of at most ``size`` ids."""
    return segments(entity_rows(claims), "subject", "claim_id", size)


def route_segments(claims: DataFrame, size: int) -> DataFrame:
    """(home, segment, items): ``routes`` in lists of at most ``size`` ids; homes without any aren't there."""
    return segments(route_rows(claims).where("claim_id is not null"), "home", "claim_id", size)


def cross_surface(claims: DataFrame) -> DataFrame:
    """(id, sources): distinct sorted sources of each claim, found inside the row."""
    named = F.filter(F.transform("provenance", lambda p: p["source"]), lambda s: s != "")
    return claims.select("id", F.array_sort(F.array_distinct(named)).alias("sources"))


def status_totals(claims: DataFrame) -> DataFrame:
    return claims.agg(*[F.count_if(F.col("status") == s).alias(s) for s in INACTIVE])


def claim_totals(claims: DataFrame) -> DataFrame:
    """Claims, and how many supersede something or are contradicted."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return claims.agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(size("supersedes") > 0).alias("with_supersedes"),
        F.count_if(size("contradictions") > 0).alias("with_contradictions")
    )
