"""The engine's operators as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions import dates, text
from claimloom.operators import clusters, delta, extract, integrity, merge, recovery, resolve, retrieval, schedule, telemetry, verdicts, views
from claimloom.operators.saving import scratch_folder
from claimloom.plans.engine import Settings, claims_of
from claimloom.plans.oracle import ORACLE
from claimloom.plans.store import TABLES
from claimloom.schemas import CLAIM_SCORES, CONFIDENCE, DEFAULT_HOME, EP, FRESHNESS, HI, HOMES, LT, PB, TYPES, WI
from claimloom.sources import files, fixtures, jsonl

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents")


def _joined(c: str | Column) -> Column:
    return F.array_join(c, ",")


def _six(c: str | Column) -> Column:
    return F.round(c, 6)


# Sources and splits


@_query
def extract_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.src_docs(_docs(spark, sf_dir))
    rows = extract.with_paragraphs(docs).select("doc_id", F.explode("units").alias("u"))
    return rows.select(
        "doc_id", F.col("u.start").alias("line_start"), F.col("u.end").alias("line_end"), F.length("u.body").cast("long").alias("n_chars"),
        F.md5("u.body").alias("body_md5")
    )


@_query
def extract_h2_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.sectioned_docs(_docs(spark, sf_dir))
    rows = extract.with_sections(docs).select("doc_id", F.explode("units").alias("u"))
    return rows.select("doc_id", F.col("u.start").alias("line_start"), F.col("u.end").alias("line_end"), F.md5("u.body").alias("body_md5"))


@_query
def candidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.extract_candidates(fixtures.src_docs(_docs(spark, sf_dir)).select("path", "text"))
    return out.select(F.regexp_extract("path", r"(\d+)", 1).cast("long").alias("doc_id"), "line_start", "candidate_id")


@_query
def fingerprint_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return files.fingerprints(docs, F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".md")), F.col("text"))


@_query
def delta_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    prior, current = fixtures.inventories(_docs(spark, sf_dir))
    return delta.changed_sources(current, prior)


@_query
def removed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    prior, current = fixtures.inventories(_docs(spark, sf_dir))
    return delta.removed_sources(current, prior)


@_query
def cursor_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.cursor_hash(fixtures.inventories(_docs(spark, sf_dir))[1])


# First pass


@_query
def strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.verdict_rows(_docs(spark, sf_dir).where("doc_id is not null"))
    d = F.col("doc_id")
    plain = {
        n: ((d * k) % 101) / 100.0 for n,
        k in zip(
            ["durability", "future_judgment_value", "action_value", "identity_relationship_weight", "cross_time_persistence", "noise_risk"],
            (3, 7, 11, 13, 17, 19), strict=True
        )
    }
    return rows.select("candidate_id", _six(verdicts.strength(lambda n: plain[n])).alias("strength"))


@_query
def verdict_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    d = F.col("doc_id")
    plain = {
        n: ((d * k) % 101) / 100.0 for n,
        k in zip(
            ["durability", "future_judgment_value", "action_value", "identity_relationship_weight", "cross_time_persistence", "noise_risk"],
            (3, 7, 11, 13, 17, 19), strict=True
        )
    }
    return docs.select(
        F.concat(F.lit("cand-"), d.cast("string")).alias("candidate_id"),
        verdicts.rule_verdict(verdicts.strength(lambda n: plain[n]), plain["noise_risk"]).alias("verdict")
    )


@_query
def verdict_counts_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.verdict_counts(fixtures.verdict_rows(_docs(spark, sf_dir)))


@_query
def verdict_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    rows = fixtures.verdict_rows(docs)
    extra = docs.where("doc_id % 50 = 0").select(F.concat(F.lit("cand-"), (F.col("doc_id") + 1_000_000_000).cast("string")).alias("candidate_id"))
    return verdicts.verdict_violations(rows, rows.select("candidate_id").unionByName(extra))


@_query
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.batch_chunks(fixtures.verdict_rows(_docs(spark, sf_dir)).select("candidate_id"), "candidate_id", 40, 10)


@_query
def json_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 4
    raw = F.when(e == 0, F.col("props")).when(e == 1, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(
        e == 2, F.concat(F.lit("Here it is: "), "props", F.lit(" as asked."))
    ).otherwise("no answer")
    value = recovery.recovered_json(raw)
    return _read(spark, sf_dir, "events").select(
        "event_id", recovery.recovery_step(raw).alias("step"), F.try_variant_get(value, "$.k", "bigint").alias("k"),
        recovery.recovery_error(raw, ["k"]).alias("error")
    )


# Clusters


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id")
    return clusters.merge_components(fixtures.merge_edges(docs), docs.select(F.col("doc_id").alias("id")))


@_query
def merge_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir)


@_query
def cluster_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _labels(spark, sf_dir).withColumn("id", F.concat(F.lit("d"), F.lpad(F.col("id").cast("string"), 12, "0")))
    return clusters.cluster_ids(named).select("cluster_id", "members")


@_query
def shared_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The SQL engine's word classes are ASCII, so other letters become one that both know.
    docs = _docs(spark, sf_dir).select(F.col("doc_id").alias("id"), F.regexp_replace("text", r"[^\x00-\x7F]", "x").alias("text"))
    members = _labels(spark, sf_dir).join(docs, "id")
    return clusters.shared_entities(members, "component").select("component", _joined("entities").alias("entities"))


@_query
def majority_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    hint = F.get(F.array(*[F.lit(t) for t in TYPES]), (F.floor(F.col("id") * 5 / 3) % 14).cast("int"))
    return clusters.first_mode(_labels(spark, sf_dir).withColumn("h", hint), "component", "h", ["id"], "hint")


# Text functions


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.claims(_docs(spark, sf_dir))


def _prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.claims_prior(_docs(spark, sf_dir))


def _new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.claims_new(_docs(spark, sf_dir))


@_query
def norm_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _read(spark, sf_dir, "part").select(F.col("p_name").alias("s")).union(
        _read(spark, sf_dir, "customer").select("c_name")
    ).union(_claims(spark, sf_dir).select("subject"))
    return names.distinct().select("s", text.subject_key(F.col("s")).alias("n"))


@_query
def norm_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    names = part.select(F.col("p_name").alias("s")).union(part.select("p_type")).union(_claims(spark, sf_dir).select("predicate"))
    return names.distinct().select("s", text.predicate_key(F.col("s")).alias("n"))


@_query
def retrieval_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = text.retrieval_tokens(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.array_sort(tokens).alias("t")).select(
        "doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens_md5")
    )


@_query
def dup_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = text.duplicate_tokens(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.array_sort(tokens).alias("t")).select(
        "doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens_md5")
    )


@_query
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _claims(spark, sf_dir).select("ord", "id", text.duplicate_tokens(F.col("text")).alias("t"))
    after = rows.select((F.col("ord") - 1).alias("ord"), F.col("id").alias("b"), F.col("t").alias("u"))
    return rows.join(after, "ord").select(F.col("id").alias("a"), "b", _six(text.jaccard(F.col("t"), F.col("u"))).alias("j"))


@_query
def entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select(
        "doc_id", F.explode(text.entity_mentions(F.col("text"))).alias("entity")
    ).groupBy("doc_id", "entity").agg(F.count(F.lit(1)).alias("n"))


@_query
def text_truncations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, sf_dir).select(
        "doc_id", F.md5(text.shortened(t, 80, 77, "…")).alias("heading_md5"), F.md5(text.shortened(t, 240, 237, "...")).alias("recall_md5"),
        text.approximate_tokens(t).alias("tokens")
    )


# New claims against prior ones


@_query
def exact_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.exact_reuse(_new(spark, sf_dir), _prior(spark, sf_dir))


@_query
def probable_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, prior = _new(spark, sf_dir), _prior(spark, sf_dir)
    left = new.join(resolve.exact_reuse(new, prior).select("id"), "id", "left_anti")
    return resolve.probable_duplicates(left, prior).select("id", "target_id", "score")


@_query
def probable_duplicates_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New claims and priors whose texts are those of documents."""
    rows = fixtures.text_claims(_docs(spark, sf_dir))
    return resolve.probable_duplicates(rows.where("is_new"), rows.where("not is_new")).select("id", "target_id", "score")


@_query
def disposition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve.dispositions(_new(spark, sf_dir), _prior(spark, sf_dir))
    return out.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.ranked_priors(fixtures.clusters_q(_docs(spark, sf_dir)).withColumn("subject", F.lower("subject")), _prior(spark, sf_dir))


@_query
def prior_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).where("rank between 1 and 5").select("cluster_id", "claim_id", "rank", _six("score").alias("score"))


@_query
def prior_topk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters and priors whose texts are those of documents."""
    docs = _docs(spark, sf_dir)
    asks = fixtures.clusters_q(docs, fixtures.text_claims).withColumn("subject", F.lower("subject"))
    ranked = retrieval.ranked_priors(asks, fixtures.text_claims(docs).where("not is_new"), border=False)
    return ranked.where("rank between 1 and 5").select("cluster_id", "claim_id", "rank", _six("score").alias("score"))


@_query
def prior_topk_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.widened(_ranked(spark, sf_dir)).select("cluster_id", "claim_id", "rank")


@_query
def prior_global_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.global_cap(retrieval.widened(_ranked(spark, sf_dir))).select("claim_id", _six("score").alias("score"))


@_query
def contradiction_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.contradiction_candidates(retrieval.widened(_ranked(spark, sf_dir))).select("cluster_id", _joined("ids").alias("ids"))


@_query
def newest_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.newest_priors(_prior(spark, sf_dir)).select("id")


# The store


@_query
def upsert_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _claims(spark, sf_dir)
    old = rows.where("ord % 2 = 0")
    out = merge.upsert_claims(old, rows.where("ord % 3 = 0").withColumn("status", F.concat(F.lit("fresh-"), "status")))
    return out.join(old.select("id", F.lit(True).alias("_old")), "id", "left").select("id", "status", F.coalesce("_old", F.lit(False)).alias("was_there"))


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prior(spark, sf_dir).unionByName(_new(spark, sf_dir))


@_query
def apply_supersession(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merge.apply_supersession(_store(spark, sf_dir), _new(spark, sf_dir), fixtures.RUN)
    return out.select("id", "status", _joined("superseded_by").alias("superseded_by"))


@_query
def chain_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.chain_warnings(_new(spark, sf_dir), _prior(spark, sf_dir))


@_query
def stale_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = spark.createDataFrame([(p,) for p in fixtures.REMOVED], "path string")
    out = merge.retire_unsourced(_prior(spark, sf_dir), gone, fixtures.RUN)
    return out.select("id", "status", F.coalesce(_joined(F.get(F.col("retirement_reasons"), F.lit(0))["removed_sources"]), F.lit("")).alias("removed"))


@_query
def contradiction_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.contradiction_rows(_new(spark, sf_dir), fixtures.RUN).drop("ord", "pos", "competing_text")


@_query
def contradiction_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _claims(spark, sf_dir)
    out = merge.merge_contradictions(merge.contradiction_rows(rows, "run-1"), merge.contradiction_rows(rows.where("ord % 2 = 0"), "run-2"))
    return out.select("contradiction_cluster_id", "claim_id", "competing_claim_id", "flagged_in_run_id")


@_query
def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.entities(_claims(spark, sf_dir)).select("subject", F.size("claim_ids").cast("long").alias("n"), F.md5(_joined("claim_ids")).alias("ids_md5"))


@_query
def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.routes(_claims(spark, sf_dir)).select("home", F.size("claim_ids").cast("long").alias("n"), F.md5(_joined("claim_ids")).alias("ids_md5"))


@_query
def cross_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.cross_surface(_claims(spark, sf_dir)).select("id", _joined("sources").alias("sources"))


@_query
def status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.status_totals(_claims(spark, sf_dir))


@_query
def claim_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.claim_totals(_new(spark, sf_dir))


@_query
def home_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.zero_filled(resolve.active(_claims(spark, sf_dir)), "primary_home", HOMES)


# Routes and checks


@_query
def route_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.with_routes(_claims(spark, sf_dir)).select("id", "route_state", "route_score", "route_suggested")


@_query
def route_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.route_warnings(resolve.with_routes(_claims(spark, sf_dir))).drop("route_suggested")


@_query
def default_homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = F.create_map(*[F.lit(x) for kv in DEFAULT_HOME.items() for x in kv])
    return _claims(spark, sf_dir).select("id", F.try_element_at(home, F.col("type")).alias("proposed_home"))


@_query
def normalization_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resolve.with_keys(_claims(spark, sf_dir))
    made = resolve.stable_id(F.col("subject"), F.col("predicate"), F.col("text"), F.col("primary_home"))
    return rows.select("id", resolve.signature().alias("sig"), made.alias("stable_id"))


@_query
def integrity_supersedes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.supersession_violations(fixtures.broken_claims(_docs(spark, sf_dir)))


@_query
def integrity_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _claims(spark, sf_dir)
    wrong = F.when(F.col("ord") % 10 == 0, "OTHER.md").otherwise(F.col("primary_home"))
    named = F.when(F.col("ord") % 15 == 0, F.concat(F.lit("unknown-"), F.col("ord").cast("string"))).otherwise(F.col("id"))
    return integrity.route_violations(rows.select(wrong.alias("home"), named.alias("claim_id")), rows)


@_query
def integrity_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.claim_violations(fixtures.broken_claims(_docs(spark, sf_dir)), "business")


# Runs


@_query
def recall_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.recall_surface(_prior(spark, sf_dir), F.lit(fixtures.NOW)).select("id", "status", "age_days", "recall_score")


@_query
def age_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, now = F.col("updated_at"), F.lit(fixtures.NOW)
    return _claims(spark, sf_dir).select("id", dates.age_days(at, now).alias("age"), _six(dates.days_since(at, now)).alias("days"))


@_query
def usage_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    rows = _read(spark, sf_dir, "events").select(
        "event_type", F.col("user_id").alias("prompt_tokens"), (e % 7).alias("completion_tokens"),
        (F.col("user_id") + e % 7).alias("total_tokens"),
        F.get(F.array(F.lit("exact"), F.lit("approximate"), F.lit("unavailable")), (e % 3).cast("int")).alias("source")
    )
    return telemetry.usage_fold(rows, "event_type")


@_query
def event_status_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.status_by_day(_read(spark, sf_dir, "events"), "ts", "event_type")


@_query
def posture_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = (F.col("ord") * 7 % 101) / 100.0
    return _claims(spark, sf_dir).select("id", telemetry.posture(score, FRESHNESS).alias("freshness"), telemetry.posture(score, CONFIDENCE).alias("confidence"))


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job a customer: some fields missing, some schedules odd."""
    k = F.col("c_custkey")
    name = F.concat(F.when(k % 9 == 0, "other-").otherwise("claims-"), F.when(k % 2 == 0, "reconciliation-").otherwise("incremental-"), k.cast("string"))
    cron = F.when(k % 7 == 0, "").otherwise(
        F.concat((k % 60).cast("string"), F.lit(" "), (k % 24).cast("string"), F.lit(" * * "), F.when(k % 5 == 0, "*").otherwise((k % 7).cast("string")))
    )
    return _read(spark, sf_dir, "customer").select(
        "c_custkey", name.alias("name"), cron.alias("cron"), F.lit("UTC").alias("tz"), F.when(k % 4 != 0, k % 3 == 0).alias("deliver")
    )


@_query
def next_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2025-03-01 10:30:00").cast("timestamp_ntz").cast("timestamp")
    return _jobs(spark, sf_dir).select("c_custkey", F.date_format(schedule.next_fire(F.col("cron"), now), "yyyy-MM-dd HH:mm").alias("fires_at"))


@_query
def next_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2025-03-01 10:30:00").cast("timestamp_ntz").cast("timestamp")
    return schedule.next_schedule(_jobs(spark, sf_dir), now, "claims-").select("name", "mode", F.date_format("fires_at", "yyyy-MM-dd HH:mm").alias("fires_at"))


@_query
def delivery_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = schedule.Delivery(enabled=True, channel="c", target=None)
    return schedule.delivery_actions(_jobs(spark, sf_dir), wanted, "claims-").groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@_query
def config_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"cron": {"tz": "UTC"}, "props": '), "props", F.lit("}"))).otherwise(F.col("props"))
    return _read(spark, sf_dir, "events").select("event_id", _joined(schedule.missing_paths(made, ["cron.tz", "props.k", "k"])).alias("missing"))


@_query
def prior_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = retrieval.prior_context(_prior(spark, sf_dir))
    return rows.select(
        "claim_id", "type", "primary_home", _joined(F.transform("provenance", lambda p: p["source"])).alias("sources"),
        F.get(F.col("provenance"), F.lit(0))["line_span"][1].alias("last_line")
    )


# Views


def _view(spark: SparkSession, sf_dir: str, home: str) -> DataFrame:
    return views.VIEWS[home](fixtures.claims_for_views(_docs(spark, sf_dir))).select("section_ord", "section", "row_ord", "id", F.md5("block").alias("block_md5"))


@_query
def view_ltmemory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, LT)


@_query
def view_playbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, PB)


@_query
def view_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, EP)


@_query
def view_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, HI)


@_query
def view_wishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, WI)


# Files and lines


@_query
def discovered_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, missing, denied = files.discover(fixtures.source_files(_docs(spark, sf_dir)), "personal", fixtures.CHECKED)
    row = lambda df, kind: df.select(F.lit(kind).alias("kind"), "path", F.col("severity") if "severity" in df.columns else F.lit(None).cast("string").alias("severity"))
    return row(found, "found").unionByName(row(missing, "missing")).unionByName(row(denied, "denied"))


@_query
def denied_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.source_files(_docs(spark, sf_dir)).where(files.is_denied(F.col("path")))


@_query
def type_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.source_files(_docs(spark, sf_dir)).select("path", extract.type_hint(F.col("path")).alias("hint"))


@_query
def jsonl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.written_lines(_read(spark, sf_dir, "customer"))
    return jsonl.read_jsonl(spark, path, T.StructType.fromDDL("k long, name string"), None)


@_query
def jsonl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.written_lines(_read(spark, sf_dir, "customer"))
    return jsonl.read_jsonl_checked(spark, path, T.StructType.fromDDL("k long, name string"))[1].select("line", "value")


@_query
def episode_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract.with_whole(_docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.explode("units").alias("u"))
    return rows.select("doc_id", F.col("u.start").alias("line_start"), F.col("u.end").alias("line_end"), F.md5("u.body").alias("body_md5"))


# Passes


@_query
def cluster_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = clusters.build_clusters(fixtures.survivors(_docs(spark, sf_dir)))
    each = lambda f: F.transform("candidates", f)
    sources = F.array_sort(F.array_distinct(F.flatten(each(lambda c: F.transform(c["source_refs"], lambda r: r["source"])))))
    hints = F.col("cluster_hints")
    return made.select(
        "cluster_id", _joined(each(lambda c: c["candidate_id"])).alias("members"), _joined(sources).alias("sources"),
        hints["shared_subject"].alias("subject"), hints["proposed_type"].alias("kind"), hints["proposed_primary_home"].alias("home")
    )


@_query
def scored_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    known = docs.where("doc_id % 3 <> 0").select(
        F.concat(F.lit("cand-"), F.col("doc_id").cast("string")).alias("candidate_id"), "text", F.lit("fact").alias("type_hint"),
        F.array().cast("array<string>").alias("source_refs")
    )
    return verdicts.scored_candidates(fixtures.verdict_rows(docs), known, fixtures.RUN).select(
        "candidate_id", "verdict", "run_id", "type_hint", F.md5("text").alias("text_md5")
    )


@_query
def asked_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.verdict_rows(_docs(spark, sf_dir))
    return verdicts.only_asked(rows, rows.where("doc_id % 4 = 0"), "candidate_id").select("candidate_id", "verdict")


@_query
def canonical_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims, made, shown = fixtures.canonical_rows(_docs(spark, sf_dir))
    return integrity.canonical_violations(claims, made, "business", shown)


@_query
def stored_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, none = _new(spark, sf_dir), F.lit(None).cast("string")
    canonical = F.struct("type", "status", "text", "subject", "predicate", "object", "primary_home", "secondary_tags")
    answers = new.select(
        F.lit("<new>").alias("claim_id"), F.col("id").alias("source_cluster_id"),
        F.struct(*[F.lit(0.5).alias(n) for n in CLAIM_SCORES]).alias("scores"), canonical.alias("canonical"), "provenance",
        "contradictions", "supersedes", "superseded_by", none.alias("freshness_posture"), "confidence_posture", none.alias("rationale"),
        none.alias("route_rationale")
    )
    out = claims_of(answers, _prior(spark, sf_dir), Settings("", "", fixtures.RUN, fixtures.NOW))
    flagged = F.get(F.col("contradictions"), F.lit(0))["flagged_in_run_id"]
    return out.select(
        "source_cluster_id", "id", "status", "profile_scope", "updated_in_run_id", "updated_at", flagged.alias("flagged_in"),
        _joined(F.transform("provenance", lambda p: p["source"])).alias("sources")
    )


RECENT = "2024-02-05T00:00:00Z"


def _ranked_recent(spark: SparkSession, sf_dir: str, keep: int) -> DataFrame:
    return retrieval.ranked_priors(fixtures.clusters_q(_docs(spark, sf_dir)).withColumn("subject", F.lower("subject")), _prior(spark, sf_dir), F.lit(RECENT), keep)


@_query
def prior_topk_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked_recent(spark, sf_dir, 5).where("rank between 1 and 5").select("cluster_id", "claim_id", "rank", _six("score").alias("score"))


@_query
def reconciliation_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, each = retrieval.caps("reconciliation")
    ranked = _ranked_recent(spark, sf_dir, each + retrieval.BONUS)
    return retrieval.global_cap(retrieval.widened(ranked, each), cap).select("claim_id", _six("score").alias("score"))


# Checks of a published version


def _views(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(LT, "nothing"), (PB, "### a claim"), (EP, "nothing"), (HI, "nothing"), (WI, "### a wish")], "home string, text string")


@_query
def view_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _claims(spark, sf_dir)
    both = [integrity.view_violations(_views(spark), rows, p).withColumn("profile", F.lit(p)) for p in ("business", "personal")]
    return both[0].unionByName(both[1])


@_query
def check_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = integrity.claim_violations(fixtures.broken_claims(_docs(spark, sf_dir)), "business")
    parts = {"all": found, "warnings": found.where("rule like 'warn:%'"), "none": found.where("rule = ''")}
    out = [integrity.report_status(rows).withColumn("part", F.lit(name)) for name, rows in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@_query
def manifest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.manifest_violations(fixtures.manifests(_docs(spark, sf_dir)), "doc_id", "body")


@_query
def store_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.store_violations(fixtures.listed_versions(_docs(spark, sf_dir)), TABLES, HOMES)


@_query
def upgrade_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.upgrade_states(fixtures.stored_versions(_docs(spark, sf_dir)), "doc_id", "body", {"logic": "1.10.0", "artifact_schema": "1.0"})


@_query
def delivery_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.reporting_states(_read(spark, sf_dir, "customer"))
    return rows.select("c_custkey", *[c.alias(n) for n, c in schedule.delivery_columns(F.col("state"), F.col("config")).items()])


@_query
def log_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry.log_shards(_read(spark, sf_dir, "events"), "ts", "Etc/GMT+5")
    return rows.groupBy("log_date").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


@_query
def first_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.when(F.col("ord") % 6 == 0, F.get("secondary_tags", F.lit(0))).when(F.col("ord") % 5 == 0, "")
    return _claims(spark, sf_dir).select("id", text.first_filled(tag, F.col("confidence_posture"), F.col("object")).alias("found"))


@_query
def lenient_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.unhex(F.lit("FF41C3")))
    return _docs(spark, sf_dir).select("doc_id", F.md5(text.lenient_text(content)).alias("text_md5"))


@_query
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.json_documents(_read(spark, sf_dir, "customer"))
    return jsonl.records_of(rows, T.StructType().add("k", "long").add("name", "string"), "rows", "body")


@_query
def json_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType().add("rows", T.ArrayType(T.StructType().add("k", "long")))
    none = F.struct(F.array().cast("array<struct<k:long>>").alias("rows"))
    found = jsonl.object_or(F.col("body"), schema, none)
    return fixtures.json_documents(_read(spark, sf_dir, "customer")).select("c_custkey", F.coalesce(F.size(found["rows"]), F.lit(-1)).cast("long").alias("n"))


@_query
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "lines")
    rows = _claims(spark, sf_dir).select("ord", "id", "object", "text", "secondary_tags", "recurrence")
    jsonl.write_jsonl(rows, path)
    return jsonl.read_jsonl(spark, path, rows.schema).select("ord", "id", "object", "text", _joined("secondary_tags").alias("tags"), "recurrence")


SEGMENT = 64


@_query
def entity_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(merge.entity_segments(_claims(spark, sf_dir), SEGMENT), "subject")


@_query
def route_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(merge.route_segments(_claims(spark, sf_dir), SEGMENT), "home")


def _segments(rows: DataFrame, group: str) -> DataFrame:
    return rows.select(group, "segment", F.size("items").cast("long").alias("n"), F.md5(_joined("items")).alias("ids_md5"))


@_query
def step_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    before, now = fixtures.inventories(docs)
    verdicts_, asked = fixtures.verdict_rows(docs), _candidates_asked(docs)
    broken = verdicts.verdict_violations(verdicts_, asked).where("candidate_id <> ''").withColumn("n", F.regexp_extract("candidate_id", r"(\d+)", 1).cast("long"))
    tries = broken.select((F.col("n") % 10).alias("batch"), (F.col("n") % 2).cast("int").alias("attempt"), "rule")
    claims = _claims(spark, sf_dir)
    return telemetry.step_warnings(
        scope=telemetry.scope_warnings(delta.removed_sources(now, before), docs.where("doc_id % 9 = 0").select(F.col("doc_id").cast("string").alias("candidate_id"))),
        verdicts=telemetry.pass_warnings(tries, verdicts_, asked, "candidate_id"),
        route=telemetry.route_warnings(resolve.with_routes(claims)).select("id")
    )


def _candidates_asked(docs: DataFrame) -> DataFrame:
    """All but some of the candidates that there are verdicts on."""
    return docs.where("doc_id % 45 <> 0").select(F.concat(F.lit("cand-"), F.col("doc_id").cast("string")).alias("candidate_id"))


@_query
def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.entity_rows(_claims(spark, sf_dir))


@_query
def route_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.route_rows(_claims(spark, sf_dir))


# Times, versions, usage


@_query
def claim_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, d = F.col("updated_at"), F.col("ord") % 5
    bare = F.replace(at, F.lit("Z"), F.lit(""))
    odd = F.when(d == 0, at).when(d == 1, F.concat(bare, F.lit("+02:00"))).when(d == 2, bare).when(d == 3, "junk")
    return _claims(spark, sf_dir).select("id", dates.epoch(odd).alias("epoch"))


@_query
def time_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _claims(spark, sf_dir)
    known, unknown = (rows.select("id", F.lit(z).alias("asked"), *dates.time_triple(F.col("updated_at"), z)) for z in ("Etc/GMT+5", "Nowhere/None"))
    return known.unionByName(unknown)


@_query
def schedule_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_id", dates.in_window(F.dayofweek("ts") - 1, F.hour("ts"), fixtures.SCHEDULES).alias("inside"))


@_query
def run_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return _docs(spark, sf_dir).select("doc_id", telemetry.run_seconds(fixtures.updated_at(d), fixtures.updated_at(d + d % 50)).alias("seconds"))


@_query
def version_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    version = F.concat((k % 10).cast("string"), F.lit("."), (k % 77).cast("string"), F.lit("-rc."), F.when(k % 3 == 0, "x").otherwise((k % 5).cast("string")))
    return _read(spark, sf_dir, "part").select("p_partkey", _joined(F.transform(text.version_tuple(version), lambda x: x.cast("string"))).alias("parts"))


@_query
def state_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    logic = F.concat(F.lit("1."), (k % 9).cast("string"), F.lit(".0"))
    manifest = F.concat(F.lit("1.0."), F.col("p_size").cast("string"))
    return _read(spark, sf_dir, "part").select("p_partkey", telemetry.state_version_of(logic, manifest, F.lit("1.0.0")).alias("state"))


@_query
def usage_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    made = telemetry.usage_struct(e % 3, F.when(e % 2 == 0, 0).otherwise(e % 7), "exact")
    return _read(spark, sf_dir, "events").select("event_id", made.alias("u")).select("event_id", "u.*")


@_query
def unwrapped_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    said = F.concat(F.lit("said "), e.cast("string"))
    made = F.when(
        e % 5 == 0, F.concat(F.lit('{"response": "'), said, F.lit('", "text": "later"}'))
    ).when(e % 5 == 1, F.concat(F.lit('{"message": " ", "content": "'), said, F.lit('"}')))
    made = made.when(e % 5 == 2, F.concat(F.lit('{"output": {"k": 1}, "result": "'), said, F.lit('"}'))).when(e % 5 == 3, said).otherwise(F.col("props"))
    return _read(spark, sf_dir, "events").select("event_id", recovery.unwrapped(made).alias("answer"))


# Scheduler


@_query
def listed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.listed_jobs(fixtures.listings(_read(spark, sf_dir, "customer")), "body", "claims-").select("name", "cron", "deliver")


@_query
def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = schedule.listed_jobs(fixtures.listings(_read(spark, sf_dir, "customer")), "body", "claims-")
    return schedule.sync_plan(jobs, schedule.Delivery(enabled=True, channel="c", target="t"), "claims-")
