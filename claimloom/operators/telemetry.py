"""Runs: token usage, event log, recall, manifest."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.dates import age_days, micros, recall_score, valid_zone
from claimloom.functions.text import shortened

# Usage sources from best to worst, and what the recall looks at.
USAGE_RANK = {"exact": 0, "approximate": 1, "unavailable": 2}
RECALLED = ["contested", "unresolved", "retire_candidate"]


def usage_fold(rows: DataFrame, *groups: str) -> DataFrame:
    """Sums of prompt, completion and total tokens, and the weakest source among them."""
    rank = F.create_map(*[F.lit(x) for kv in USAGE_RANK.items() for x in kv])
    weakest = F.max_by("source", F.coalesce(rank[F.col("source")], F.lit(2)))
    sums = [F.sum(c).cast("long").alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")]
    return rows.groupBy(*groups).agg(*sums, weakest.alias("source"))


def usage_struct(prompt: Column, completion: Column, source: str) -> Column:
    """A usage block; two counts of 0 are no count at all."""
    nothing = (prompt == 0) & (completion == 0)
    return F.struct(
        prompt.alias("prompt_tokens"), completion.alias("completion_tokens"), (prompt + completion).alias("total_tokens"),
        F.when(nothing, "unavailable").otherwise(source).alias("source")
    )


def status_by_day(events: DataFrame, ts: str, status: str) -> DataFrame:
    return events.groupBy(F.date_format(ts, "yyyy-MM-dd").alias("log_date"), F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def log_shards(events: DataFrame, ts: str, zone: str) -> DataFrame:
    """The events with ``log_date``, the local day of a UTC time, which names the log's folder."""
    return events.withColumn("log_date", F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(valid_zone(zone)), F.col(ts).cast("timestamp_ntz")), "yyyy-MM-dd"))


def recall_surface(claims: DataFrame, now: Column) -> DataFrame:
    """The one claim most worth a look: best score, then the oldest, then the least id."""
    age = age_days(F.col("updated_at"), now)
    pool = claims.where(F.col("status").isin(RECALLED)).withColumn("age_days", age)
    scored = pool.withColumn("_score", recall_score(F.col("status"), F.col("age_days"), F.coalesce(F.size("provenance"), F.lit(0)), F.col("recurrence")))
    top = scored.orderBy(F.desc("_score"), F.coalesce("updated_at", F.lit("")), "id").limit(1)
    return top.select(
        "id", "type", "status", shortened(F.coalesce("text", F.lit("")), 240, 237, "...").alias("text"), "primary_home", "updated_at",
        "age_days", F.bround("_score", 3).alias("recall_score")
    )


def posture(score: Column, names: list[str]) -> Column:
    """One of four names by the bands from 0.8, 0.5 and 0.3."""
    return F.when(score >= 0.8, names[0]).when(score >= 0.5, names[1]).when(score >= 0.3, names[2]).when(score.isNotNull(), names[3])


def run_seconds(started: Column, finished: Column) -> Column:
    return (micros(finished) - micros(started)) / 1e6


def route_warnings(claims: DataFrame) -> DataFrame:
    """Claims whose route is not strong (see ``with_routes``)."""
    return claims.where("route_state <> 'strong'").select("id", "type", "primary_home", "route_state", "route_suggested")


def state_version_of(logic: Column, manifest: Column, artifact: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", logic, manifest, artifact)), 1, 12)


def step_warnings(**steps: DataFrame) -> DataFrame:
    """(step, warning): the warnings of all steps, repeats kept; each step is a table whose first column is the warning."""
    parts = [rows.select(F.lit(step).alias("step"), F.col(rows.columns[0]).cast("string").alias("warning")) for step, rows in steps.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def scope_warnings(gone: DataFrame, waiting: DataFrame) -> DataFrame:
    """What scoping has to say: sources that went, and candidates that still wait from before."""
    left = gone.select(F.concat(F.lit("source is gone: "), "path").alias("warning"))
    return left.unionByName(waiting.select(F.concat(F.lit("waited for a batch: "), "candidate_id").alias("warning")))


def pass_warnings(attempts: DataFrame, answered: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """What a judging pass has to say: batches that were asked for again (batch, attempt, rule), and ids that were not
    asked for and whose answers were dropped."""
    again = attempts.groupBy("batch", "attempt").agg(F.count(F.lit(1)).alias("n"), F.min("rule").alias("rule"))
    said = F.format_string("batch %d was asked for again after attempt %d: %d broken rules, %s among them", "batch", F.col("attempt") + 1, "n", "rule")
    foreign = answered.select(key).distinct().join(asked.select(key), key, "left_anti").where(F.col(key) != "")
    return again.select(said.alias("warning")).unionByName(foreign.select(F.concat(F.lit("answer to nothing that was asked: "), F.col(key)).alias("warning")))


def state_version(logic: str, manifest: str, artifact: str) -> str:
    return hashlib.sha1(f"{logic}|{manifest}|{artifact}".encode()).hexdigest()[:12]


def run_report(report: dict) -> str:
    """A run for people to read, as markdown."""
    lines = [f"# Run {report['run_id']}", "", f"- status: {report['status']}", f"- mode: {report['mode']}", f"- profile: {report['profile']}"]
    lines += [f"- {k.replace('_', ' ')}: {v}" for k, v in report.items() if k not in ("run_id", "status", "mode", "profile", "warnings", "errors") and v is not None]
    for name in ("warnings", "errors"):
        if report.get(name):
            lines += ["", f"## {name.capitalize()}", "", *[f"- {x if isinstance(x, str) else ': '.join(map(str, x))}" for x in report[name]]]
    return "\n".join(lines) + "\n"


def suggests_ingest(manifest: dict) -> bool:
    """Downstream is told only of published runs whose claims changed."""
    return bool(manifest.get("publishCommitted")) and bool(manifest.get("downstreamWikiIngestSuggested"))
