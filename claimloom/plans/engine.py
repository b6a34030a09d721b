"""A whole run: sources to claims, views and manifest."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.dates import clock, valid_zone

from claimloom.operators import clusters, delta, extract, integrity, merge, ranking, resolve, retrieval, telemetry, verdicts, views
from claimloom.plans.scorers import RuleScorer, Scorer, ScorerUnavailable
from claimloom.plans.store import TABLES, LockHeld, LockLost, Store, bucket_of
from claimloom.schemas import CLAIM, HOMES, PERSONAL_HOMES, STATUSES, SURVIVING, VERDICTS
from claimloom.sources.files import discover, read_sources

LOGIC, MANIFEST_SCHEMA, ARTIFACT_SCHEMA = "1.0.0", "1.0.0", "1.0.0"
INVENTORY = "path string, content_hash string"
CANDIDATE = "candidate_id string, text string, type_hint string, source_refs array<struct<source:string,line_span:array<int>,captured_at:string>>"
EVENT = "log_date string, timestamp string, timestamp_utc string, timezone string, domain string, component string, event string, run_id string, status string, agent string, profile string, mode string, token_usage struct<prompt_tokens:long,completion_tokens:long,total_tokens:long,source:string>, details string"
#: Warnings and errors that reports show; all of them are in the version's ``warnings`` and ``violations`` tables.
SHOWN = 50
CONTRADICTIONS = "ord long, pos int, contradiction_cluster_id string, claim_id string, competing_claim_id string, competing_text string, relation string, flagged_in_run_id string"


@dataclass
class Settings:
    workspace: str
    store: str
    run_id: str
    now: str  # ISO, UTC
    profile: str = "business"
    mode: str = "incremental"
    timezone: str = "UTC"
    batch_size: int = 40
    batch_cap: int = 10
    cluster_batch: int = 20
    attempts: int = 2
    acknowledge_upgrade: bool = False
    checked_paths: list[str] = field(default_factory=list)
    agent: str = "unknown"
    keep_staging: bool = False
    json_lines: bool = False
    #: Of the store's tables; the first version decides.
    buckets: int = 64
    #: Called with the signal after a run that published new claims, on the driver.
    downstream: Callable[[dict], None] | None = None

    @classmethod
    def resolve(cls, given: dict, env: dict, config: dict, **fixed) -> Settings:
        """Given values before the rest; the profile from the environment before the configuration, the workspace and
        time zone from the configuration before the environment."""
        aliases = {"personal-assistant": "personal", "business-employee": "business"}
        profile = given.get("profile") or env.get("PROFILE") or config.get("profile") or "business"
        first = lambda k: given.get(k) or config.get(k) or env.get(k.upper())
        agent = env.get("CLAIMLOOM_AGENT_ID") or env.get("AGENT_ID") or "unknown"
        return cls(workspace=first("workspace"), store=first("store"), profile=aliases.get(profile, profile), timezone=first("timezone") or "UTC", agent=agent, **fixed)


def version_of(text: str | None) -> tuple[int, ...]:
    return tuple(int(re.match(r"\d*", p)[0] or 0) for p in (text or "0").split("."))


def upgrade_needed(manifest: dict) -> bool:
    """Was the store written by an older version of the logic or of the formats?"""
    stored = [manifest.get(k) for k in ("logic", "manifest_schema", "artifact_schema")]
    return bool(manifest) and any(version_of(a) < version_of(b) for a, b in zip(stored, (LOGIC, MANIFEST_SCHEMA, ARTIFACT_SCHEMA), strict=True))


def claims_of(canonical: DataFrame, prior: DataFrame, settings: Settings) -> DataFrame:
    """Second-pass claims as stored ones: ids and dispositions settled against the store."""
    c = lambda n: F.col("canonical")[n].alias(n)
    flagged = F.transform(
        "contradictions",
        lambda x: F.struct(
            x["competing_claim_id"].alias("competing_claim_id"), x["competing_text"].alias("competing_text"),
            x["relation"].alias("relation"), F.lit(settings.run_id).alias("flagged_in_run_id")
        )
    )
    flat = canonical.select(
        F.col("source_cluster_id").alias("id"), "claim_id", "source_cluster_id", c("type"), c("status"), c("text"), c("subject"), c("predicate"), c("object"), c("primary_home"),
        F.coalesce(
            F.col("canonical")["secondary_tags"], F.array().cast("array<string>")
        ).alias("secondary_tags"), F.lit(settings.profile).alias("profile_scope"), "scores", "provenance", flagged.alias("contradictions"),
        "supersedes", "superseded_by", "freshness_posture", "confidence_posture", "rationale", "route_rationale",
    )
    done = resolve.dispositions(flat, prior)
    numbered = ranking.global_rank(done, "source_cluster_id", out="ord")
    status = F.when(F.col("disposition") == "probable_duplicate", "probable_duplicate").otherwise(F.col("status"))
    out = numbered.withColumns(
        {
            "id": F.col("final_id"), "status": status, "recurrence": F.lit(None).cast("double"),
            "updated_in_run_id": F.lit(settings.run_id), "updated_at": F.lit(settings.now),
            "retirement_reasons": F.array().cast(CLAIM["retirement_reasons"].dataType)
        }
    )
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CLAIM.fields])


class Engine:
    """One run: sources to a published version, or a report that says why not.

    What becomes of a run's files depends on its status: of a published version the tables and views stay, of one that
    was skipped nothing, and of one that failed everything, with its failure records.
    """

    def __init__(self, spark: SparkSession, settings: Settings, scorer: Scorer | None = None):
        self.spark, self.settings, self.scorer = spark, settings, scorer or RuleScorer()
        self.store = Store(spark, settings.store)
        self.clock = clock(settings.now, settings.timezone)

    def run(self) -> dict:
        """One run under the store's lock. Returns the report: its ``status`` is one of schemas.RUN_STATUSES."""
        s, store = self.settings, self.store
        manifest = store.manifest()
        if upgrade_needed(manifest) and not s.acknowledge_upgrade:
            return self._blocked(manifest)
        if manifest.get("version_dir") == f"v={s.run_id}":
            return self._report("failed", reason="the run id is that of the published version")
        try:
            self.lock = store.lock(s.run_id)
        except LockHeld as held:
            return self._report("skipped", reason=f"run {held} is at work")
        try:
            self.after, manifest = store.current()  # as it is now that nobody else publishes
            self._log("run_started", self._report("ok"))
            try:
                getattr(self.scorer, "preflight", lambda: None)()
                report = self._locked(manifest)
            except ScorerUnavailable as missing:
                report = self._report("failed", reason=f"the scorer is not available: {missing}")
            except LockLost as lost:
                report = self._report("skipped_superseded", reason=str(lost))
            self._clean(report["status"])
            self._log({"ok": "run_completed", "skipped": "run_skipped"}.get(report["status"], "run_failed"), report)
            self._remember(report)
            store.write_text("last-run.md", telemetry.run_report(report | {"finished_at": f"{self.clock['timestamp']} {self.clock['timezone']}"}))
            return report
        finally:
            store.unlock(self.lock)

    def _report(self, status: str, **more) -> dict:
        s = self.settings
        return {"status": status, "run_id": s.run_id, "mode": s.mode, "profile": s.profile, "warnings": [], **more}

    def _blocked(self, manifest: dict) -> dict:
        """The store is of an older version: a marker tells so, until a run acknowledges the upgrade."""
        names = dict(zip(("logic", "manifest_schema", "artifact_schema"), (LOGIC, MANIFEST_SCHEMA, ARTIFACT_SCHEMA), strict=True))
        older = next(k for k, now in names.items() if version_of(manifest.get(k)) < version_of(now))
        marker = f"upgrade-pending-{manifest.get(older)}-{names[older]}.json"
        said = {"from": manifest.get(older), "to": names[older], "reason": f"{older}_mismatch", **self.clock, "instructions": "run once with acknowledge_upgrade"}
        self.store.write_text(f"_upgrades/{marker}", json.dumps(said, indent=1))
        return self._report(
            "upgrade_required", reason="the store is of an older version", upgrade=said, stored={k: manifest.get(k) for k in names},
            running=names, marker=f"_upgrades/{marker}"
        )

    def _clean(self, status: str) -> None:
        s, store = self.settings, self.store
        if status == "ok":
            store.delete(f"failures/run_id={s.run_id}")
            store.delete(f"quarantine/run_id={s.run_id}")
            if s.acknowledge_upgrade:
                store.delete("_upgrades")
            if not s.keep_staging:
                store.keep_tables(s.run_id)
        elif status.startswith("skipped") and not s.keep_staging:
            store.drop_version(s.run_id)

    def _log(self, event: str, report: dict) -> None:
        s, c = self.settings, self.clock
        details = {k: v for k, v in report.items() if k not in ("status", "run_id", "mode", "profile", "recall")}
        row = (
            c["timestamp"][:10], c["timestamp"], c["timestamp_utc"], c["timezone"], "memory", "claimloom", event, s.run_id,
            report["status"], s.agent, s.profile, s.mode, (0, 0, 0, "unavailable"), json.dumps(details, default=str, ensure_ascii=False)
        )
        self.store.append("events", self.spark.createDataFrame([row], EVENT).coalesce(1), "log_date")

    def _remember(self, report: dict) -> None:
        """When each mode last succeeded, and up to which cursor."""
        if report["status"] == "ok":
            text = self.store.read_text("last-runs.json")
            last = json.loads(text) if text else {}
            self.store.write_text("last-runs.json", json.dumps(last | {report["mode"]: self.clock["timestamp"], "cursor": report["cursor"]}))

    def _locked(self, manifest: dict) -> dict:
        s, store = self.settings, self.store
        mode = "reconciliation" if s.acknowledge_upgrade else s.mode
        found, missing, denied = discover(read_sources(self.spark, s.workspace), s.profile, s.checked_paths)
        if not denied.isEmpty():
            return self._report("failed", reason="a path was named that is never read")
        found = store.save(s.run_id, "sources", found)
        # The inventory of the last run that succeeded, so changes of failed runs are seen again.
        before = store.load("inventory", INVENTORY, manifest)
        scope, kind, gone = delta.select_scope(found, before if manifest else None, mode)
        prior = store.load("claims", CLAIM, manifest)
        sweep = not gone.isEmpty()
        waiting = store.load("pending", CANDIDATE, manifest)
        #: Warnings of the steps so far.
        self.told: dict[str, DataFrame] = {"scope": telemetry.scope_warnings(gone, waiting)}
        if scope.isEmpty() and not sweep and waiting.isEmpty():
            recall = [r.asDict() for r in telemetry.recall_surface(prior, F.lit(s.now)).collect()]
            return self._report("skipped", reason="nothing changed", claims_total=prior.count(), recall=recall[0] if recall else None)

        fresh = extract.extract_candidates(
            scope.select("path", "text", F.col("mtime_utc").alias("captured_at"))
        ).select("candidate_id", "text", "type_hint", "source_refs")
        candidates = fresh.unionByName(waiting.join(fresh.select("candidate_id"), "candidate_id", "left_anti")).dropDuplicates(["candidate_id"])
        batched = store.save(s.run_id, "candidates", verdicts.batch_chunks(candidates, "candidate_id", s.batch_size, s.batch_cap))
        now_scored = batched.where("not pending").drop("pending")
        pending = store.save(s.run_id, "pending", batched.where("pending").drop("batch", "pending"))
        given, failure = self._judged("verdicts", now_scored, "candidate_id", s.batch_size, self.scorer.verdicts, lambda v, rows: verdicts.verdict_violations(v, rows))
        if failure is not None:
            return failure
        scored = store.save(s.run_id, "scored", verdicts.scored_candidates(given, now_scored, s.run_id))
        for verdict in ("reject", "defer"):
            store.append(f"ledger_{verdict}", scored.where(F.col("verdict") == verdict).select("candidate_id", "run_id", "verdict", "strength", "rationale", "text"))
        counts = {r["verdict"]: r["n"] for r in verdicts.verdict_counts(scored).collect()}
        surviving = verdicts.survivors(scored)
        new = self.spark.createDataFrame([], CLAIM)
        if any(counts[v] for v in SURVIVING):
            # A repeated id would be in several batches of clusters; the checks have made sure there is none.
            made = store.save(s.run_id, "clusters", verdicts.batch_chunks(clusters.build_clusters(surviving), "cluster_id", s.cluster_batch, 1 << 62).drop("pending"))
            shown = store.save(s.run_id, "shown", self._shown(made, prior, mode)) if mode == "reconciliation" else self.spark.createDataFrame([], CLAIM)
            canonical, failure = self._judged(
                "claims", made, "cluster_id", s.cluster_batch, lambda rows: self.scorer.claims(rows, shown, s.profile),
                lambda c, rows: integrity.canonical_violations(c, rows, s.profile, shown.select("id")), "source_cluster_id"
            )
            if failure is not None:
                return failure
            new = store.save(s.run_id, "new_claims", claims_of(canonical, prior, s))
        elif not sweep:
            return self._report("skipped", reason="no candidate was kept", verdicts=counts)
        return self._publish(manifest, found, scope, before, prior, new, gone, counts, missing, pending, kind)

    def _shown(self, made: DataFrame, prior: DataFrame, mode: str) -> DataFrame:
        """The prior claims that the second pass is shown."""
        hint, cap, each = F.col("cluster_hints"), *retrieval.caps(mode)
        hints = made.select(
            "cluster_id", hint["shared_subject"].alias("subject"), hint["shared_entities"].alias("entities"),
            F.array_join(F.transform("candidates", lambda c: c["text"]), " ").alias("text"),
            hint["proposed_type"].alias("proposed_type"), hint["proposed_primary_home"].alias("proposed_home"),
        )
        ranked = retrieval.widened(retrieval.ranked_priors(hints, prior, F.lit(self.settings.now), each + retrieval.BONUS), each)
        return prior.join(retrieval.global_cap(ranked, cap).select(F.col("claim_id").alias("id")), "id", "left_semi")

    def _judged(
        self, step: str, rows: DataFrame, key: str, size: int, ask: Callable, check: Callable, out_key: str | None = None
    ) -> tuple[DataFrame | None, dict | None]:
        """The scorer's answers to ``rows`` (with a ``batch``), or a report of the failure.

        All batches are asked for at once. Those whose answers break a rule are asked for again while attempts are left,
        the others keep their answers. Of batched answers only rows that were asked for count. One batch that stays
        broken fails the step: the first one is reported, and its answers and payload are kept.
        """
        s, store, out_key = self.settings, self.store, out_key or key
        asked = rows.select(F.col(key).alias(out_key), "batch")
        todo, good, tries, said = rows, None, [], []
        for attempt in range(max(1, s.attempts)):
            if hasattr(self.scorer, "keep"):
                self.scorer.keep = lambda said, name=f"{step}-{attempt}-answers": store.save(s.run_id, name, said)
            given = store.save(s.run_id, f"{step}-{attempt}", ask(todo))
            said.append(given.select(out_key))
            if size:
                given = verdicts.only_asked(given, todo.select(F.col(key).alias(out_key)), out_key)
            found = check(given, todo)
            broken = found.select(F.col(found.columns[0]).alias(out_key), "rule")
            broken = store.save(
                s.run_id, f"{step}-{attempt}-broken",
                broken.join(asked, out_key, "left").select(out_key, "rule", F.coalesce("batch", F.lit(0)).alias("batch"))
            )
            bad = broken.select("batch").distinct()
            sound = given.join(asked.join(bad, "batch", "left_semi").select(out_key), out_key, "left_anti").select(*given.columns)
            good = sound if good is None else good.unionByName(sound)
            if broken.isEmpty():
                self.told[step] = self._pass_warnings(tries, said if size else [], asked, out_key)
                return good, None
            tries.append(broken.select("batch", "rule", F.lit(attempt).alias("attempt")))
            todo = rows.join(bad, "batch", "left_semi").select(*rows.columns)
        first = broken.agg(F.min("batch")).first()[0]
        worst = broken.where(F.col("batch") == first)
        payload = todo.where(F.col("batch") == first).select(F.to_json(F.struct("*")).alias("payload"))
        answers = given.join(asked.where(F.col("batch") == first).select(out_key), out_key, "left_semi").select(F.to_json(F.struct("*")).alias("answer"))
        about = [
            F.lit(s.run_id).alias("run_id"), F.lit(step).alias("step"), F.lit(first).cast("long").alias("batch"),
            F.lit(max(1, s.attempts)).alias("attempts"), F.lit(self.clock["timestamp_utc"]).alias("timestamp_utc")
        ]
        parts = [
            ("error", worst.select(F.to_json(F.struct(out_key, "rule")).alias("body"))),
            ("payload", payload.select(F.col("payload").alias("body"))), ("answer", answers.select(F.col("answer").alias("body")))
        ]
        if getattr(self.scorer, "last", None) is not None:
            parts.append(("raw", self.scorer.last.where(F.col("batch") == first).select(F.coalesce("answer", "error").alias("body"))))
        for kind, part in parts:
            store.append("failures", part.select(*about, F.lit(kind).alias("kind"), "body"), "run_id")
        return None, self._failed(step, worst.select(out_key, "rule"), batch=first, attempts=max(1, s.attempts), record=f"failures/run_id={s.run_id}")

    def _pass_warnings(self, tries: list[DataFrame], said: list[DataFrame], asked: DataFrame, key: str) -> DataFrame:
        """Of a pass whose batches are all sound by now."""
        attempts = self.spark.createDataFrame([], "batch long, rule string, attempt int")
        for part in tries:
            attempts = attempts.unionByName(part)
        answered = asked.select(key).limit(0)
        for part in said:
            answered = answered.unionByName(part)
        return telemetry.pass_warnings(attempts, answered, asked, key)

    def _failed(self, what: str, broken: DataFrame, **more) -> dict:
        rows = broken.limit(SHOWN).collect()  # a report shows some of them; all are in the quarantine
        self.store.append("quarantine", broken.select(F.col(broken.columns[0]).alias("id"), "rule", F.lit(self.settings.run_id).alias("run_id")), "run_id")
        errors = [tuple(r) for r in rows]
        return self._report("partial_failure", failed=what, errors=errors, partial_failures=[{"pass": what, "errors": errors, **more}], **more)

    def _touched(self, name: str, ids: DataFrame) -> list[int]:
        """The buckets of a table that hold one of the ids; all of them if the table has none yet."""
        if name not in self.where:
            return list(range(self.buckets))
        return sorted(r["b"] for r in ids.select(bucket_of(F.col(ids.columns[0]), self.buckets).alias("b")).distinct().collect())

    def _saved(self, name: str, rows: DataFrame, changed: list[int]) -> DataFrame:
        """The table with the ``changed`` buckets as they are in ``rows``; the others stay where they are."""
        self.where[name] = self.store.save_buckets(self.settings.run_id, name, rows, self.buckets, changed, self.where.get(name, {}))
        return self.store.open(name, rows.schema, self.where[name])

    def _tables(self, found: DataFrame, before: DataFrame, prior: DataFrame, new: DataFrame, gone: DataFrame) -> dict[str, DataFrame]:
        """The new version's tables, of which only buckets are written that something changes in."""
        s, store = self.settings, self.store
        hit = [new.select("id"), merge.supersession_edges(new).select(F.col("target").alias("id")), merge.unsourced(prior, gone).select("id")]
        touched = self._touched("claims", hit[0].unionByName(hit[1]).unionByName(hit[2]))
        part = prior.where(bucket_of("id", self.buckets).isin(*touched)) if "claims" not in self.where else store.open("claims", CLAIM, self.where["claims"], touched)
        merged = merge.apply_supersession(merge.upsert_claims(part, new, prior.agg(F.max("ord")).first()[0]), new, s.run_id)
        claims = self._saved("claims", merge.retire_unsourced(merged, gone, s.run_id).select(*CLAIM.fieldNames()), touched)
        rows = merge.contradiction_rows(new, s.run_id)
        competing = self._touched("contradictions", rows.select("claim_id"))
        known = self.known_contradictions
        old = store.open("contradictions", known.schema, self.where["contradictions"], competing) if "contradictions" in self.where else known
        return {
            "claims": claims, "contradictions": self._saved("contradictions", merge.merge_contradictions(old, rows), competing),
            "entities": self._saved("entities", merge.entity_rows(claims), touched),
            # Homes without a claim have a row without one.
            "routes": self._saved("routes", merge.route_rows(claims), sorted({0, *touched})),
            "inventory": self._saved(
                "inventory", found.select("path", "content_hash"),
                self._touched("inventory", delta.changed_sources(found, before).select("path").unionByName(gone.select("path")))
            )
        }

    def _publish(
        self, manifest: dict, found: DataFrame, scope: DataFrame, before: DataFrame, prior: DataFrame, new: DataFrame, gone: DataFrame,
        counts: dict, missing: DataFrame, pending: DataFrame, kind: str
    ) -> dict:
        s, store = self.settings, self.store
        self.buckets, self.where = manifest.get("buckets", s.buckets), dict(manifest.get("files", {}))
        self.known_contradictions = store.load("contradictions", CONTRADICTIONS, manifest)
        tables = self._tables(found, before, prior, new, gone)
        claims, contradictions, routes, inventory = (tables[k] for k in ("claims", "contradictions", "routes", "inventory"))
        cursor = delta.cursor_hash(found).first()["cursor"]
        shown = [h for h in views.VIEWS if s.profile == "personal" or h not in PERSONAL_HOMES]
        headings = []
        for home in shown:
            head = views.view_head(home, self.clock["timestamp"], self.clock["timezone"])
            filled = store.write_view(f"v={s.run_id}/views/{home}", head, views.view_lines(views.VIEWS[home](claims)))
            headings.append((home, "### " if filled else ""))
        if s.json_lines:
            for name, table in (("claims", claims), ("contradictions", contradictions)):
                store.save_lines(s.run_id, name, table)

        by = lambda c, n: {r[c]: r["n"] for r in claims.groupBy(c).agg(F.count(F.lit(1)).alias("n")).collect() if r[c] in n}
        totals = claims.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        added = new.count()
        warnings = store.save(s.run_id, "warnings", self._warnings(new, prior, missing, claims))
        told, told_n = self._some(warnings, "warning")
        made = {
            "version": LOGIC, "logic": LOGIC, "manifest_schema": MANIFEST_SCHEMA, "artifact_schema": ARTIFACT_SCHEMA,
            "state_version": telemetry.state_version(LOGIC, MANIFEST_SCHEMA, ARTIFACT_SCHEMA),
            "runId": s.run_id, "mode": s.mode, "status": "ok", "profileScope": s.profile, "timezone": self.clock["timezone"],
            "startedAt": self.clock["timestamp"], "finishedAt": self.clock["timestamp"], "finishedAt_utc": self.clock["timestamp_utc"],
            "sourceInventory": {"table": "inventory", "sources": inventory.count()}, "processedSegments": {"sources": scope.count()},
            "promotionStats": counts, "claimStats": by("status", STATUSES), "homeStats": by("primary_home", HOMES),
            "warnings": told, "warningCount": told_n, "partialFailures": [], "lastSuccessfulCursor": cursor, "delta": kind,
            "claims_total": totals, "views": shown, "buckets": self.buckets, "files": self.where, "publishCommitted": True, "downstreamWikiIngestSuggested": added > 0,
        }
        broken = self._validated(claims, routes, headings, made)
        errors = broken.where(~F.col("rule").startswith("warn:"))
        if not errors.isEmpty():
            return self._failed("validate", errors, reason="the new version breaks a rule and is not published")
        checked = integrity.report_status(broken).first()["status"]
        store.publish(s.run_id, made, self.after, self.lock)
        if telemetry.suggests_ingest(made):
            signal = {"run_id": s.run_id, "claims": totals}
            store.write_text("signal.json", json.dumps(signal))
            if s.downstream is not None:
                try:
                    s.downstream(signal)
                except Exception as wrong:  # the run is published; what comes after it can only warn
                    told.append(f"downstream: {type(wrong).__name__}: {wrong}")
        return self._report(
            "ok", warnings=told, warning_count=told_n, validation=checked, verdicts={v: counts.get(v, 0) for v in VERDICTS},
            claims_new=added, claims_total=totals, pending=pending.count(), cursor=cursor, delta=kind, views=shown
        )

    def _warnings(self, new: DataFrame, prior: DataFrame, missing: DataFrame, claims: DataFrame) -> DataFrame:
        """(step, warning) of all steps."""
        said = lambda rows, form, *cols: rows.select(F.format_string(form, *cols).alias("warning"))
        misplaced = telemetry.route_warnings(resolve.with_routes(claims.where(F.col("updated_in_run_id") == self.settings.run_id)))
        zone = [] if valid_zone(self.settings.timezone) == self.settings.timezone else [
            (f"there is no zone {self.settings.timezone}; {self.clock['timezone']} is used",)
        ]
        return telemetry.step_warnings(
            discover=said(missing.where("severity = 'warn'"), "missing source %s", "path"), **self.told,
            supersession=said(merge.chain_warnings(new, prior), "%s supersedes %s, which %s superseded before", "new_id", "target", "successor"),
            route=said(misplaced, "%s: %s in %s is %s", "id", "type", "primary_home", "route_state"),
            settings=self.spark.createDataFrame(zone, "warning string")
        )

    def _some(self, rows: DataFrame, col: str) -> tuple[list[str], int]:
        """The first SHOWN values in order of step and text, and how many there are."""
        return [r[col] for r in rows.orderBy("step", col).limit(SHOWN).collect()], rows.count()

    def _validated(self, claims: DataFrame, routes: DataFrame, headings: list[tuple[str, str]], manifest: dict) -> DataFrame:
        """All that is wrong with a version that is about to be published: (id, rule)."""
        s, store = self.settings, self.store
        shown = [h for h, _ in headings]
        out = integrity.claim_violations(claims, s.profile).unionByName(integrity.route_violations(routes, claims))
        out = out.unionByName(integrity.view_violations(self.spark.createDataFrame(headings, "home string, text string"), claims, s.profile))
        listing = [(s.run_id, [*store.names(f"v={s.run_id}"), *self.where], store.names(f"v={s.run_id}/views"))]
        out = out.unionByName(integrity.store_violations(self.spark.createDataFrame(listing, "id string, tables array<string>, views array<string>"), TABLES, shown))
        document = self.spark.createDataFrame([("manifest", json.dumps(manifest))], "name string, body string")
        return store.save(s.run_id, "violations", out.unionByName(integrity.manifest_violations(document, "name", "body")))
