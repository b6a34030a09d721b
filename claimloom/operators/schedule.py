"""Schedules and delivery of reports, as data: jobs come as a table, and actions are decided, not carried out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.dates import DEFAULT_ZONE

# What a job is assumed to have where its listing and the configuration say nothing.
DEFAULT_TIMEOUT = 1200
ACTIONS = ["skipped_indeterminate", "in_sync", "skipped_missing_fields", "skipped_missing_announce_target", "would_update"]


def _number(c: Column) -> Column:
    return F.when(c.rlike(r"^\d+$"), c.cast("int"))


def next_fire(cron: Column, now: Column) -> Column:
    """The next local time after ``now`` (without zone) of a ``minute hour * * days`` schedule, Sunday being 0; null for
    other shapes. Days that are no numbers are left out, and no day at all means every day."""
    parts = F.split(F.trim(cron), r"\s+")
    minute, hour = _number(F.get(parts, F.lit(0))), _number(F.get(parts, F.lit(1)))
    named = F.filter(F.transform(F.split(F.get(parts, F.lit(4)), ","), _number), lambda d: d.isNotNull())
    days = F.when(F.size(named) > 0, named).otherwise(F.array(*[F.lit(d) for d in range(7)]))
    midnight = F.date_trunc("DAY", now)
    seconds = hour * 3600 + minute * 60
    fires = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.timestamp_add("SECOND", seconds, F.timestamp_add("DAY", k, midnight)))
    ahead = F.filter(fires, lambda t: (t > now) & F.array_contains(days, F.dayofweek(t) - 1))
    return F.when((F.size(parts) == 5) & minute.isNotNull() & hour.isNotNull(), F.array_min(ahead))


def next_schedule(jobs: DataFrame, now: Column, prefix: str) -> DataFrame:
    """The first of the jobs (name, cron) named with ``prefix`` to run next: name, mode, fires_at. No row if none will."""
    due = jobs.where(F.col("name").startswith(prefix)).select("name", next_fire(F.col("cron"), now).alias("fires_at")).where("fires_at is not null")
    mode = F.when(F.col("name").contains("reconciliation"), "reconciliation").otherwise("incremental")
    return due.orderBy("fires_at", "name").limit(1).select("name", mode.alias("mode"), "fires_at")


@dataclass
class Delivery:
    """How reports should be delivered. Values of a wrong type count as not given."""

    enabled: bool | None = None
    channel: str | None = None
    target: str | None = None
    zone: str = DEFAULT_ZONE
    timeout: int = DEFAULT_TIMEOUT

    @classmethod
    def read(cls, state: dict | None, config: dict | None, namespace: str = "claims") -> Delivery:
        """State (under ``namespace``) before configuration; nothing is wanted where the state does not say so with a
        boolean."""
        level = lambda d, k: d.get(k) if isinstance(d, dict) and isinstance(d.get(k), dict) else {}
        text = lambda v: v if isinstance(v, str) and v else None
        reporting, cron = level(level(state, namespace), "reporting"), level(config, "cron")
        there = level(reporting, "delivery")
        enabled, timeout = reporting.get("enabled"), cron.get("timeout_seconds")
        return cls(
            enabled if isinstance(enabled, bool) else None, text(there.get("channel")) or text(cron.get("announce_channel")),
            text(there.get("to")) or text(cron.get("announce_to")),
            text(cron.get("tz")) or DEFAULT_ZONE, timeout if isinstance(timeout, int) and not isinstance(timeout, bool) and timeout > 0 else DEFAULT_TIMEOUT,
        )


def delivery_columns(state: Column, config: Column, namespace: str = "claims") -> dict[str, Column]:
    """``Delivery.read`` of JSON documents in columns."""
    def at(document: Column, path: str) -> tuple[Column, Column]:
        found = F.try_variant_get(F.try_parse_json(document), f"$.{path}", "variant")
        return found, F.coalesce(F.schema_of_variant(found), F.lit(""))

    def text(document: Column, path: str) -> Column:
        found, kind = at(document, path)
        return F.when(kind == "STRING", F.nullif(F.try_variant_get(found, "$", "string"), F.lit("")))

    said, said_kind = at(state, f"{namespace}.reporting.enabled")
    timeout, timeout_kind = at(config, "cron.timeout_seconds")
    seconds = F.try_variant_get(timeout, "$", "int")
    there = f"{namespace}.reporting.delivery"
    return {
        "enabled": F.when(said_kind == "BOOLEAN", F.try_variant_get(said, "$", "boolean")),
        "channel": F.coalesce(text(state, f"{there}.channel"), text(config, "cron.announce_channel")),
        "target": F.coalesce(text(state, f"{there}.to"), text(config, "cron.announce_to")),
        "zone": F.coalesce(text(config, "cron.tz"), F.lit(DEFAULT_ZONE)),
        "timeout": F.when((timeout_kind == "BIGINT") & (seconds > 0), seconds).otherwise(DEFAULT_TIMEOUT),
    }


def delivery_actions(jobs: DataFrame, wanted: Delivery, prefix: str) -> DataFrame:
    """(name, current, action) of jobs (name, cron, tz, deliver) against what is wanted; one of ACTIONS each. No rows
    where nothing is wanted."""
    mine = jobs.where(F.col("name").startswith(prefix) & F.lit(wanted.enabled is not None))
    desired, zone = F.lit(bool(wanted.enabled)), F.coalesce(F.when(F.trim("tz") != "", F.trim("tz")), F.lit(wanted.zone))
    lost = F.coalesce(F.trim("cron"), F.lit("")) == ""
    reachable = F.lit(bool(wanted.channel and wanted.target))
    names = dict(zip(("unknown", "same", "fields", "target", "update"), ACTIONS, strict=True))
    action = F.when(F.col("deliver").isNull(), names["unknown"]).when(F.col("deliver") == desired, names["same"])
    action = action.when(lost | (zone == ""), names["fields"]).when(desired & ~reachable, names["target"]).otherwise(names["update"])
    return mine.select("name", F.col("deliver").alias("current"), action.alias("action"))


def listed_jobs(listing: DataFrame, json_col: str, prefix: str) -> DataFrame:
    """The jobs of a scheduler's listing, one JSON object a row: name, cron, tz, deliver, message, whose names begin with
    ``prefix``. Rows that are no JSON objects are left out.

    Whether a job delivers is told in one of several spellings; the first that is there counts: the booleans ``deliver``
    and ``announce``, the reverse booleans ``no_deliver`` and ``noDeliver``, and ``delivery`` as a word. Else it is null.
    """
    value = F.try_parse_json(F.col(json_col))
    of = lambda k, kind: F.when(
        F.schema_of_variant(F.try_variant_get(value, f"$.{k}", "variant")) == kind,
        F.try_variant_get(value, f"$.{k}", {"STRING": "string", "BOOLEAN": "boolean"}[kind])
    )
    word = of("delivery", "STRING")
    deliver = F.coalesce(
        of("deliver", "BOOLEAN"), of("announce", "BOOLEAN"), ~of("no_deliver", "BOOLEAN"), ~of("noDeliver", "BOOLEAN"),
        F.when(word == "announce", True).when(word.isin("no-deliver", "no_deliver", "silent"), False)
    )
    names = of("name", "STRING")
    rows = listing.where(F.schema_of_variant(value).startswith("OBJECT") & names.startswith(prefix))
    return rows.select(
        names.alias("name"), F.coalesce(of("cron", "STRING"), of("schedule", "STRING")).alias("cron"), of("tz", "STRING").alias("tz"),
        deliver.alias("deliver"), of("message", "STRING").alias("message")
    )


def sync_plan(jobs: DataFrame, wanted: Delivery, prefix: str) -> DataFrame:
    """What a scheduler's client would carry out, in order, for the jobs that ``delivery_actions`` would update: each is
    deleted and added again. (name, step, command, cron, tz, timeout_seconds, channel, target)."""
    update = delivery_actions(jobs, wanted, prefix).where("action = 'would_update'").select("name").distinct()
    rows = jobs.join(update, "name").withColumn("command", F.explode(F.array(F.lit("delete"), F.lit("add"))))
    add = F.col("command") == "add"
    announce = add & F.lit(bool(wanted.enabled))
    zone = F.coalesce(F.when(F.trim("tz") != "", F.trim("tz")), F.lit(wanted.zone))
    return rows.select(
        "name", F.when(add, 2).otherwise(1).alias("step"), "command", F.when(add, F.col("cron")).alias("cron"),
        F.when(add, zone).alias("tz"), F.when(add, F.lit(wanted.timeout)).alias("timeout_seconds"),
        F.when(announce, F.lit(wanted.channel)).alias("channel"), F.when(announce, F.lit(wanted.target)).alias("target")
    )


def sync_status(actions: DataFrame) -> DataFrame:
    """One row, ``status``: synced if anything changes, else in_sync."""
    return actions.agg(F.when(F.count_if(F.col("action") == "would_update") > 0, "synced").otherwise("in_sync").alias("status"))


def missing_paths(document: Column, paths: list[str]) -> Column:
    """Which of the dotted paths a JSON text lacks; all of them if it is no JSON."""
    value = F.try_parse_json(document)
    tests = [F.when(F.try_variant_get(value, f"$.{p}", "variant").isNull(), F.lit(p)) for p in paths]
    return F.filter(F.array(*tests), lambda p: p.isNotNull())
