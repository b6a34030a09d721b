"""Checks of canonical claims and of the published tables. Each gives rows of (id, rule), empty if all is well."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.text import blank, strip, version_tuple
from claimloom.operators.resolve import active, route_state
from claimloom.schemas import CLAIM_SCORES, CONFIDENCE, DIGEST_CAP, EPISODE_DIR, FRESHNESS, HOMES, INACTIVE, MANIFEST_KEYS, PERSONAL_HOMES, PROFILES, PROVENANCE_TYPES, RELATIONS, RUN_STATUSES, STATUSES, TYPES


def _not_in(c: Column, allowed: list[str]) -> Column:
    return ~F.coalesce(c.isin(allowed), F.lit(False))


def _broken(rows: DataFrame, key: Column, rules: dict[str, Column]) -> DataFrame:
    tests = F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()])
    return rows.select(key.alias("id"), F.explode(F.filter(tests, lambda x: x.isNotNull())).alias("rule"))


def _named(rows: DataFrame, col: str, rule: str) -> DataFrame:
    return rows.select(F.col(col).alias("id"), F.lit(rule).alias("rule"))


def canonical_violations(claims: DataFrame, clusters: DataFrame, profile: str, prior_ids: DataFrame) -> DataFrame:
    """Second-pass claims (claim_id, source_cluster_id, scores, canonical, provenance, contradictions, postures) against
    their clusters (cluster_id, candidates) and the prior claims shown (id)."""
    c, key = (lambda n: F.col("canonical")[n]), F.col("source_cluster_id")
    rules = {}
    for n in CLAIM_SCORES:
        rules[f"score_missing:{n}"] = F.col("scores")[n].isNull()
        rules[f"score_range:{n}"] = ~F.col("scores")[n].between(0.0, 1.0)
    rules |= {
        "type": _not_in(c("type"), TYPES), "status": _not_in(c("status"), STATUSES), "primary_home": _not_in(c("primary_home"), HOMES),
        "personal_home": c("primary_home").isin(PERSONAL_HOMES) & F.lit(profile != "personal"),
        "text_empty": strip(F.coalesce(c("text"), F.lit(""))) == "", "provenance_empty": F.coalesce(F.size("provenance"), F.lit(0)) == 0,
        "provenance_type": F.exists("provenance", lambda p: p["type"].isNotNull() & _not_in(p["type"], PROVENANCE_TYPES)),
        "contradiction_empty": F.exists(
            "contradictions",
            lambda x: (F.coalesce(x["competing_claim_id"], F.lit("")) == "") & (F.coalesce(x["competing_text"], F.lit("")) == "")
        ),
        "contradiction_relation": F.exists("contradictions", lambda x: x["relation"].isNotNull() & _not_in(x["relation"], RELATIONS)),
        "freshness_posture": F.col("freshness_posture").isNotNull() & _not_in(F.col("freshness_posture"), FRESHNESS),
        "confidence_posture": F.col("confidence_posture").isNotNull() & _not_in(F.col("confidence_posture"), CONFIDENCE),
    }
    own = _broken(claims, key, rules)
    ids = claims.select("source_cluster_id")
    known = clusters.select(F.col("cluster_id").alias("source_cluster_id"))
    twice = _named(ids.groupBy("source_cluster_id").count().where("count > 1"), "source_cluster_id", "cluster_duplicate")
    unknown = _named(ids.distinct().join(known, "source_cluster_id", "left_anti"), "source_cluster_id", "cluster_unknown")
    missing = _named(known.join(ids, "source_cluster_id", "left_anti"), "source_cluster_id", "cluster_missing")
    named = claims.where(F.coalesce("claim_id", F.lit("")) != "<new>").select("source_cluster_id", "claim_id")
    strange = _named(named.join(prior_ids.select(F.col("id").alias("claim_id")), "claim_id", "left_anti"), "source_cluster_id", "claim_id_unknown")
    allowed = clusters.select("cluster_id", F.explode("candidates").alias("m")).select("cluster_id", F.explode("m.source_refs").alias("r")).select(
        F.col("cluster_id").alias("source_cluster_id"), F.col("r.source").alias("source")
    )
    used = claims.select(
        "source_cluster_id", F.explode("provenance").alias("p")
    ).select("source_cluster_id", F.col("p.source").alias("source")).where(F.col("source") != "")
    untraced = _named(
        used.distinct().join(allowed, ["source_cluster_id", "source"], "left_anti").select("source_cluster_id").distinct(),
        "source_cluster_id", "provenance_untraceable"
    )
    out = own
    for part in (twice, unknown, missing, strange, untraced):
        out = out.unionByName(part)
    return out


def claim_violations(claims: DataFrame, profile: str) -> DataFrame:
    """Stored claims: errors as they are named, warnings with ``warn:`` before the name. A claim without an id has no
    other finding."""
    home, body = F.col("primary_home"), F.coalesce(F.col("text"), F.lit(""))
    # Routes are only looked at where type and home are ones the profile has.
    allowed = HOMES if profile == "personal" else [h for h in HOMES if h not in PERSONAL_HOMES]
    state = F.when(F.col("type").isin(TYPES) & home.isin(allowed), route_state(F.col("type"), home)["route_state"])
    rules = {
        "type": _not_in(F.col("type"), TYPES), "status": _not_in(F.col("status"), STATUSES),
        "primary_home": _not_in(home, HOMES), "personal_home": home.isin(PERSONAL_HOMES) & F.lit(profile != "personal"),
        "route_impossible": state == "impossible", "warn:route": state.isin("acceptable", "suspicious"),
        "text_empty": strip(body) == "", "provenance_empty": F.coalesce(F.size("provenance"), F.lit(0)) == 0,
        "warn:self_tag": F.array_contains("secondary_tags", home), "warn:profile_scope": F.col("profile_scope").isNotNull() & _not_in(F.col("profile_scope"), PROFILES),
        "warn:digest_long": (F.col("type") == "episode") & (F.length(body) > DIGEST_CAP),
        "warn:episode_source": (F.col("type") == "episode") & (F.size("provenance") > 0) & ~F.coalesce(
            F.get(F.col("provenance"), F.lit(0))["source"].startswith(EPISODE_DIR), F.lit(False)
        ),
    }
    named = blank(F.col("id")) != ""
    rules = {"id_missing": ~named} | {rule: named & test for rule, test in rules.items()}
    twice = _named(claims.where(F.col("id") != "").groupBy("id").count().where("count > 1"), "id", "id_duplicate")
    return _broken(claims, F.col("id"), rules).unionByName(twice).unionByName(supersession_violations(claims))


def supersession_violations(claims: DataFrame) -> DataFrame:
    """Self references, edges written on one side only, and targets that are not marked superseded (errors); ids that no
    claim has (warnings)."""
    rows = claims.where(blank(F.col("id")) != "")
    marked = rows.groupBy(F.col("id").alias("other")).agg(F.max(F.coalesce(F.col("status") == "superseded", F.lit(False))).alias("_marked"))
    down = rows.select("id", F.explode("supersedes").alias("other"))
    up = rows.select("id", F.explode("superseded_by").alias("other"))
    out = _named(down.where("id = other"), "id", "supersedes_self").unionByName(_named(up.where("id = other"), "id", "superseded_by_self"))
    there = down.join(marked, "other", "left")
    out = out.unionByName(_named(there.where("_marked is null"), "id", "warn:supersedes_dangling"))
    out = out.unionByName(_named(there.where("not _marked"), "id", "supersedes_status"))
    out = out.unionByName(_named(up.join(marked, "other", "left_anti"), "id", "warn:superseded_by_dangling"))
    back = up.select(F.col("other").alias("id"), F.col("id").alias("other"))
    return out.unionByName(_named(there.where("_marked is not null and id <> other").join(back, ["id", "other"], "left_anti"), "id", "supersedes_one_sided"))


def route_violations(routes: DataFrame, claims: DataFrame) -> DataFrame:
    """Routed ids, as (home, claim_ids) or as (home, claim_id), that are unknown, of another home, or inactive."""
    rows = routes.select("home", F.col("claim_id").alias("id") if "claim_id" in routes.columns else F.explode("claim_ids").alias("id")).where("id is not null")
    joined = rows.join(claims.select("id", "primary_home", "status", F.lit(True).alias("_known")), "id", "left")
    known = F.col("_known").isNotNull()
    rules = {"route_unknown": ~known, "route_home": known & ~F.col("primary_home").eqNullSafe(F.col("home")), "route_inactive": known & F.col("status").isin(INACTIVE)}
    return _broken(joined, F.col("id"), rules)


def view_violations(views: DataFrame, claims: DataFrame, profile: str) -> DataFrame:
    """Views (home, text) without a claim heading though their home has active claims, and personal views where the
    profile has none."""
    counts = active(claims).groupBy(F.col("primary_home").alias("home")).agg(F.count(F.lit(1)).alias("n"))
    joined = views.join(counts, "home", "left")
    personal = F.col("home").isin(PERSONAL_HOMES)
    rules = {
        "warn:view_empty": (F.col("n") > 0) & ~F.col("text").contains("###") & (~personal | F.lit(profile == "personal")),
        "warn:view_personal": personal & F.lit(profile != "personal")
    }
    return _broken(joined, F.col("home"), rules)


def store_violations(listings: DataFrame, tables: list[str], views: list[str]) -> DataFrame:
    """What versions (id, names of their ``tables``, of their ``views``) lack: tables (errors) and views (warnings)."""
    lacks = lambda names, wanted, rule: F.transform(
        F.array_except(F.array(*[F.lit(w) for w in wanted]).cast("array<string>"), F.coalesce(names, F.array().cast("array<string>"))),
        lambda x: F.concat(F.lit(rule), x)
    )
    broken = F.concat(lacks(F.col("tables"), tables, "table_missing:"), lacks(F.col("views"), views, "warn:view_missing:"))
    return listings.select("id", F.explode(broken).alias("rule"))


def manifest_violations(manifests: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Manifests (id, JSON text) that are no JSON object, lack a required key (one with a null value counts as there),
    or have an unknown status or profile (warnings)."""
    value = F.try_parse_json(F.col(json_col))
    keys = F.coalesce(F.json_object_keys(F.col(json_col)), F.array().cast("array<string>"))
    text = lambda k: F.try_variant_get(value, f"$.{k}", "string")
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    rules = {"manifest_unreadable": ~is_object} | {f"manifest_key:{k}": is_object & ~F.array_contains(keys, k) for k in MANIFEST_KEYS}
    rules |= {
        "warn:manifest_status": text("status").isNotNull() & _not_in(text("status"), RUN_STATUSES),
        "warn:manifest_profile": text("profileScope").isNotNull() & _not_in(text("profileScope"), PROFILES)
    }
    return _broken(manifests, F.col(id_col), rules)


def upgrade_states(manifests: DataFrame, id_col: str, json_col: str, running: dict[str, str]) -> DataFrame:
    """(id, state) of stores by their manifests: ``refuse`` where any version of ``running`` is newer than the stored one,
    ``warn`` where one is older, ``new`` where there is no manifest, else ``ok``. A version that isn't stored is the oldest."""
    value = F.try_parse_json(F.col(json_col))
    stored = {k: version_tuple(F.coalesce(F.try_variant_get(value, f"$.{k}", "string"), F.lit("0"))) for k in running}
    now = {k: version_tuple(F.lit(v)) for k, v in running.items()}
    some = lambda test: reduce(or_, [test(stored[k], now[k]) for k in running])
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    state = F.when(~is_object, "new").when(some(lambda a, b: a < b), "refuse").when(some(lambda a, b: a > b), "warn").otherwise("ok")
    return manifests.select(F.col(id_col).alias("id"), state.alias("state"))


def report_status(violations: DataFrame) -> DataFrame:
    """One row, ``status``: errors before warnings before ok."""
    worst = F.max(F.when(F.col("rule").startswith("warn:"), 1).otherwise(2))
    return violations.agg(F.when(worst == 2, "errors").when(worst == 1, "warnings").otherwise("ok").alias("status"))
