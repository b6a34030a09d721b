"""Views over the driver's tables in the shape of the engine's records, by plain arithmetic on ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.saving import scratch_folder
from claimloom.schemas import CLAIM_SCORES, DENIED_FILES, HOMES, MANIFEST_KEYS, PERSONAL_SOURCES, RELATIONS, SHARED_SOURCES, STATUSES, TYPES

STEMS = ["prefers", "prefer", "uses", "moves", "relocates", "noted"]
NOW = "2025-03-01T00:00:00Z"
REMOVED = ["src3", "src9", "src1"]
RUN = "run-1"
#: Some of the allowed sources, and all that are never read.
NAMED = [SHARED_SOURCES[0], SHARED_SOURCES[2], PERSONAL_SOURCES[0], *DENIED_FILES]
CHECKED = ["runtime/x.json", "SOUL.md", "MEMORY.md"]
HINTS = ["fact", "lesson", "method", "unknown", "episode"]
#: The tables of a version, in the store's order.
TABLE_NAMES = ["claims", "contradictions", "entities", "routes", "inventory", "pending"]
SCHEDULES = ["0 3 * * 1,3", "30 22 * * 0", "not a schedule"]
FLAGS = [
    '"deliver": true', '"announce": false', '"no_deliver": true', '"noDeliver": false', '"delivery": "silent"',
    '"delivery": "announce", "deliver": "yes"', '"other": 1'
]


def _pick(values: list[str], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def src_docs(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id", F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"),
        F.replace(F.coalesce("text", F.lit("")), F.lit(".\n"), F.lit(".\n\n")).alias("text")
    )


def sectioned_docs(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.replace(F.coalesce("text", F.lit("")), F.lit(".\n"), F.lit(".\n## ")).alias("text"))


def _id(doc: Column, lang: Column, source: Column) -> Column:
    return F.concat(F.lit("cl-"), F.substring(F.sha2(F.concat_ws("|", source, lang, doc.cast("string")), 256), 1, 16))


def updated_at(hours: Column) -> Column:
    """2024 and so many hours, as text; built from text, so no session time zone matters."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(hours / 24).cast("int"))
    return F.concat(day.cast("string"), F.lit("T"), F.lpad((hours % 24).cast("string"), 2, "0"), F.lit(":00:00Z"))


def claims(documents: DataFrame) -> DataFrame:
    """Claim records from documents; ``is_new`` splits them into the store and what a run adds."""
    d = F.col("doc_id")
    topic = F.concat(F.lit("topic-"), "lang")
    stem = _pick(STEMS, F.floor(d / 4) % 6)
    via = F.floor(d / 24) % 4
    sources = F.array_sort(F.array_distinct(F.array(F.concat(F.lit("src"), (d % 20).cast("string")), F.concat(F.lit("src"), (d * 7 % 20).cast("string")))))
    # Neighbours in the table are what contradicts and supersedes.
    near = lambda k: F.concat(F.lit("cl-"), F.substring(F.sha2(F.concat(F.lit("near|"), (d + k).cast("string")), 256), 1, 16))
    contra = F.array(
        F.struct(
            near(2).alias("competing_claim_id"), F.lit(None).cast("string").alias("competing_text"),
            _pick(RELATIONS, d % 3).alias("relation"), F.lit(None).cast("string").alias("flagged_in_run_id")
        )
    )
    prov = F.transform(
        sources,
        lambda s: F.struct(
            s.alias("source"), F.array((d % 50 + 1).cast("int"), (d % 50 + 3).cast("int")).alias("line_span"),
            F.lit("direct").alias("type"), updated_at(d).alias("captured_at")
        )
    )
    return documents.select(
        d.alias("ord"), _id(d, F.col("lang"), F.col("source")).alias("id"),
        F.when(d % 4 == 0, topic).when(
            d % 4 == 1, F.concat(F.lit("The "), topic)
        ).when(d % 4 == 2, F.concat(topic, F.lit("s"))).otherwise(F.upper(topic)).alias("subject"),
        F.when(via == 0, stem).otherwise(F.concat(stem, F.lit(" via "), via.cast("string"))).alias("predicate"),
        F.when(d % 7 != 0, F.col("lang")).alias("object"),
        _pick(HOMES, F.floor(d / 2) % 5).alias("primary_home"), _pick(STATUSES, F.floor(d / 5) % 7).alias("status"), _pick(TYPES, d % 14).alias("type"),
        (d % 3 == 0).alias("is_new"),
        F.concat(F.lit("operator "), stem, F.lit(" "), "lang", F.lit(" item "), (d % 10).cast("string"), F.lit(" source "), "source").alias("text"),
        updated_at(d).alias("updated_at"), prov.alias("provenance"),
        F.when(d % 11 == 0, contra).otherwise(F.array().cast(contra_type())).alias("contradictions"),
        F.when(d % 6 == 0, F.array(F.concat(F.lit("tag"), (d % 5).cast("string")))).otherwise(F.array(F.lit("NOTES.md"))).alias("secondary_tags"),
        F.when(d % 5 == 0, F.lit("high")).alias("confidence_posture"), F.when(d % 13 == 0, (d % 8).cast("double")).alias("recurrence"),
        F.lit(None).cast("string").alias("updated_in_run_id"), F.array().cast("array<string>").alias("superseded_by"),
        F.array().cast("array<struct<run_id:string,reason:string,removed_sources:array<string>>>").alias("retirement_reasons"), "lang",
    )


def text_claims(documents: DataFrame) -> DataFrame:
    """The claims, each with the whole text of its document in place of a made one."""
    said = documents.select(F.col("doc_id").alias("ord"), F.coalesce("text", F.lit("")).alias("text"))
    return claims(documents).drop("text").join(said, "ord").select(*claims(documents).columns)


def claims_for_views(documents: DataFrame) -> DataFrame:
    """The claims with another deal of states, so that every view has rows."""
    return claims(documents).withColumn("status", _pick(STATUSES, F.floor(F.col("ord") / 11) % 7))


def contra_type() -> str:
    return "array<struct<competing_claim_id:string,competing_text:string,relation:string,flagged_in_run_id:string>>"


def claims_prior(documents: DataFrame) -> DataFrame:
    return claims(documents).where("not is_new").withColumn("supersedes", F.array().cast("array<string>"))


def claims_new(documents: DataFrame) -> DataFrame:
    """Every third new claim names, as superseded, the claim of the next document where that one is a prior claim."""
    rows = claims(documents)
    nxt = rows.where("not is_new").select((F.col("ord") - 1).alias("ord"), F.col("id").alias("_next"))
    joined = rows.where("is_new").join(nxt, "ord", "left")
    named = F.when((F.col("ord") % 9 == 0) & F.col("_next").isNotNull(), F.array("_next")).otherwise(F.array().cast("array<string>"))
    return joined.withColumn("supersedes", named).drop("_next")


def clusters_q(documents: DataFrame, made: Callable[[DataFrame], DataFrame] = claims) -> DataFrame:
    """Groups of new claims as clusters to look up priors for."""
    rows = made(documents).where("is_new").withColumn("g", F.floor(F.col("ord") / 30))
    grouped = rows.groupBy("lang", "g").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), " ").alias("text"),
        F.min(F.struct("ord", "type", "primary_home")).alias("f")
    )
    return grouped.select(
        F.concat(F.lit("clust-"), "lang", F.lit("-"), F.lpad(F.col("g").cast("string"), 8, "0")).alias("cluster_id"),
        F.concat(F.lit("Topic-"), "lang").alias("subject"), F.array(F.lit("operator"), F.col("lang")).alias("entities"), "text",
        F.col("f.type").alias("proposed_type"), F.col("f.primary_home").alias("proposed_home")
    )


def inventories(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prior, current) inventories: some sources are new, some gone, some changed."""
    path = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".md"))
    rows = documents.select("doc_id", path.alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"))
    current = rows.where("doc_id % 17 <> 0").select(
        "path",
        F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("new-"), "content_hash")).otherwise(F.col("content_hash")).alias("content_hash")
    )
    return rows.where("doc_id % 19 <> 0").select("path", "content_hash"), current


def verdict_rows(documents: DataFrame) -> DataFrame:
    """Verdicts with six scores from the id, and some broken ones."""
    d = F.col("doc_id")
    names = ["durability", "future_judgment_value", "action_value", "identity_relationship_weight", "cross_time_persistence", "noise_risk"]
    scores = {n: ((d * k) % 101) / 100.0 for n, k in zip(names, (3, 7, 11, 13, 17, 19), strict=True)}
    total = scores[names[0]]
    for n in names[1:5]:
        total = total + scores[n]
    total = total - scores["noise_risk"]
    shown = [F.when(d % 29 == 0, 1.2).otherwise(scores[names[0]]).alias(names[0]), *[scores[n].alias(n) for n in names[1:]]]
    verdict = F.when((total <= 0.5) | (scores["noise_risk"] >= 0.8), "reject").when(total < 2.0, "defer").otherwise("promote")
    return documents.select(
        F.concat(F.lit("cand-"), d.cast("string")).alias("candidate_id"), F.struct(*shown).alias("scores"),
        F.when(d % 23 == 0, total + 0.05).otherwise(total).alias("strength"),
        F.when(d % 31 == 0, "compress").otherwise(verdict).alias("verdict"), F.array().cast("array<string>").alias("merge_candidate_ids"),
        F.lit(None).cast("string").alias("compress_target"), "doc_id"
    )


def merge_edges(documents: DataFrame) -> DataFrame:
    return documents.where("doc_id % 12 < 8").select(F.col("doc_id").alias("src"), (F.col("doc_id") + 4).alias("dst"))


def source_files(documents: DataFrame) -> DataFrame:
    """(path): files of a workspace, allowed and not."""
    d = F.col("doc_id")
    rest = F.concat(_pick(["episodes/", "memory/", "notes/"], d % 3), d.cast("string"), F.lit(".md"))
    return documents.select(F.when(d < len(NAMED), _pick(NAMED, d)).otherwise(rest).alias("path"))


def written_lines(customer: DataFrame) -> str:
    """A folder with one file of JSON lines: some blank, some broken."""
    k = F.col("c_custkey")
    good = F.to_json(F.struct(k.alias("k"), F.col("c_name").alias("name")))
    line = F.when(k % 7 == 0, "").when(k % 7 == 3, F.concat(F.lit("{broken "), k.cast("string"))).otherwise(good)
    path = scratch_folder(customer.sparkSession, "lines")
    customer.select("c_custkey", line.alias("value")).repartition(1).sortWithinPartitions("c_custkey").select("value").write.text(path)
    return path


def survivors(documents: DataFrame) -> DataFrame:
    """Survivors of the first pass, each merged with the one four ids further on where ``merge_edges`` says so."""
    d = F.col("doc_id")
    name = lambda c: F.concat(F.lit("d"), F.lpad(c.cast("string"), 12, "0"))
    ref = lambda k: F.struct(
        F.concat(F.lit("src"), (d % k).cast("string")).alias("source"), F.array(F.lit(1), F.lit(2)).alias("line_span"),
        F.lit(None).cast("string").alias("captured_at")
    )
    none = F.array().cast("array<string>")
    return documents.select(
        name(d).alias("candidate_id"), F.concat(
            F.lit("text "), d.cast("string")
        ).alias("text"), _pick(HINTS, d % 5).alias("type_hint"), F.array(ref(4), ref(7)).alias("source_refs"),
        F.lit("promote").alias("verdict"), F.lit("").alias("rationale"), F.when(
            d % 12 < 8, F.array(name(d + 4))
        ).otherwise(none).alias("merge_candidate_ids"), F.lit(None).cast("string").alias("compress_target"),
    )


def canonical_rows(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(second-pass claims, their clusters, ids of shown claims), with every rule broken by some row."""
    k = F.col("doc_id")
    at = lambda n, wrong, right: F.when(k % n == 0, F.lit(wrong)).otherwise(right)
    scores = {n: F.lit(0.5) for n in CLAIM_SCORES} | {"semantic_cluster_confidence": F.when(k % 13 != 0, 0.5), "canonical_clarity": at(17, 1.5, F.lit(0.5))}
    none = F.lit(None).cast("string")
    canonical = F.struct(
        at(19, "odd", _pick(TYPES, k % 14)).alias("type"), at(23, "gone", F.lit("resolved")).alias("status"),
        at(31, " ", F.lit("text")).alias("text"), at(29, "X.md", _pick(HOMES, k % 5)).alias("primary_home")
    )
    prov = F.array(F.struct(at(41, "srcZ", F.lit("srcA")).alias("source"), at(43, "guess", F.lit("direct")).alias("type")))
    contra = F.array(F.struct(none.alias("competing_claim_id"), at(10, "", F.lit("other")).alias("competing_text"), at(15, "odd", F.lit("stale")).alias("relation")))
    claims = documents.select(
        F.when(k % 7 == 0, "cl-unknown").when(k % 7 == 1, "cl-shown").otherwise("<new>").alias("claim_id"),
        F.concat(
            F.lit("clust-"), F.when(k % 11 == 0, k + 1).otherwise(k).cast("string")
        ).alias("source_cluster_id"), F.struct(*[v.alias(n) for n, v in scores.items()]).alias("scores"), canonical.alias("canonical"),
        F.when(k % 37 != 0, prov).otherwise(F.slice(prov, 1, 0)).alias("provenance"), F.when(k % 5 == 0, contra).otherwise(F.slice(contra, 1, 0)).alias("contradictions"),
        at(47, "ripe", F.lit("fresh")).alias("freshness_posture"), F.when(k % 7 == 2, "sure").alias("confidence_posture"),
    )
    member = F.struct(F.array(F.struct(F.lit("srcA").alias("source"))).alias("source_refs"))
    clusters = documents.select(F.concat(F.lit("clust-"), k.cast("string")).alias("cluster_id"), F.array(member).alias("candidates"))
    return claims, clusters, documents.sparkSession.createDataFrame([("cl-shown",)], "id string")


def broken_claims(documents: DataFrame) -> DataFrame:
    """Claims of which some break each rule of stored claims."""
    d = F.col("ord")
    rows = claims(documents)
    first = F.get(F.col("provenance"), F.lit(0))
    near = lambda k: F.concat(F.lit("other-"), (d + k).cast("string"))
    none = F.array().cast("array<string>")
    return rows.withColumns({
        "id": F.when(d % 53 == 0, F.lit(None)).when(
            d % 59 == 0, F.concat(F.lit("other-"), (d + 1).cast("string"))
        ).otherwise(F.concat(F.lit("other-"), d.cast("string"))),
        "type": F.when(d % 61 == 0, "odd").otherwise(F.col("type")), "status": F.when(d % 67 == 0, "odd").otherwise(F.col("status")), "primary_home": F.when(d % 71 == 0, "odd").otherwise(
            F.col("primary_home")
        ),
        "text": F.when(d % 73 == 0, " ").when(
            d % 7 == 3, F.repeat(F.lit("long "), 101)
        ).otherwise(F.col("text")), "profile_scope": F.when(d % 6 == 1, "alien").otherwise("shared"),
        "provenance": F.when(d % 47 == 0, F.slice("provenance", 1, 0)).when(
            d % 5 == 0, F.array(first.withField("source", F.lit("episodes/a.md")))
        ).otherwise(F.col("provenance")),
        "secondary_tags": F.when(d % 3 == 0, F.array("primary_home")).otherwise(F.col("secondary_tags")),
        "supersedes": F.when(d % 10 == 0, F.array(near(1), near(0))).when(d % 10 == 4, F.array(F.lit("nobody"))).when(d % 10 == 6, F.array(near(1))).otherwise(none),
        "superseded_by": F.when(d % 10 == 7, F.array(near(-1))).when(d % 10 == 8, F.array(near(0))).when(d % 10 == 9, F.array(F.lit("nobody"))).otherwise(none),
    })


def manifests(documents: DataFrame) -> DataFrame:
    """(doc_id, body): manifests with one key missing each, some odd, some no JSON."""
    d = F.col("doc_id")
    values = {k: F.lit("1") for k in MANIFEST_KEYS} | {
        "status": F.when(d % 5 == 0, '"odd"').otherwise('"ok"'), "profileScope": F.when(d % 7 == 0, '"alien"').otherwise("null")
    }
    parts = [F.when(d % 17 != i, F.concat(F.lit(f'"{k}": '), v)) for i, (k, v) in enumerate(values.items())]
    return documents.select("doc_id", F.when(d % 29 == 0, "no json").otherwise(F.concat(F.lit("{"), F.array_join(F.array(*parts), ", "), F.lit("}"))).alias("body"))


def listed_versions(documents: DataFrame) -> DataFrame:
    """(id, tables, views): what lies in the folder of each version, some of it missing."""
    d = F.col("doc_id")
    some = lambda names, k: F.filter(F.array(*[F.when(d % k != i, F.lit(n)) for i, n in enumerate(names)]), lambda x: x.isNotNull())
    return documents.select(d.cast("string").alias("id"), some(TABLE_NAMES, 11).alias("tables"), F.when(d % 13 != 0, some(HOMES, 8)).alias("views"))


def stored_versions(documents: DataFrame) -> DataFrame:
    """(doc_id, body): manifests by older, equal and newer versions, without some, and none."""
    d = F.col("doc_id")
    logic = F.concat(F.lit('"logic": "1.'), (d % 12).cast("string"), F.lit('.0"'))
    artifact = F.when(d % 7 != 0, F.concat(F.lit(', "artifact_schema": "1.0'), F.when(d % 5 == 0, ".1").otherwise(""), F.lit('"'))).otherwise("")
    return documents.select("doc_id", F.when(d % 19 == 0, "[]").otherwise(F.concat(F.lit("{"), logic, artifact, F.lit("}"))).alias("body"))


def reporting_states(customer: DataFrame) -> DataFrame:
    """(c_custkey, state, config): settings of reports, with values of the right and of wrong types."""
    k = F.col("c_custkey")
    one = lambda *values: _pick(list(values), k % len(values))
    state = F.concat(
        F.lit('{"claims": {"reporting": {"enabled": '), one("true", "false", '"yes"', "1", "null"), F.lit(', "delivery": {"channel": '),
        one('"c1"', '""', "7"), F.lit(', "to": '), one('"t1"', "null"), F.lit("}}}}")
    )
    config = F.concat(
        F.lit('{"cron": {"tz": '), one('"UTC"', '""', "3", '"Etc/GMT+1"'), F.lit(', "timeout_seconds": '), one("300", "0", '"9"', "true", "-4", "45", "null"),
        F.lit(', "announce_channel": "c2"'), F.when(k % 11 != 0, F.lit(', "announce_to": "t2"')).otherwise(""), F.lit("}}")
    )
    return customer.select("c_custkey", F.when(k % 17 == 0, "no json").otherwise(state).alias("state"), F.when(k % 13 == 0, "[]").otherwise(config).alias("config"))


def json_documents(customer: DataFrame) -> DataFrame:
    """(c_custkey, body): documents with two records under ``rows``, with one, without, and broken ones."""
    k = F.col("c_custkey")
    record = lambda n: F.concat(F.lit('{"k": '), n.cast("string"), F.lit(', "name": "'), F.col("c_name"), F.lit('"}'))
    body = F.when(k % 5 == 0, "{broken").when(k % 5 == 1, record(k)).when(
        k % 5 == 2, F.concat(F.lit('{"rows": '), record(k), F.lit("}"))
    ).otherwise(F.concat(F.lit('{"rows": ['), record(k), F.lit(", "), record(k + 1), F.lit("]}")))
    return customer.select("c_custkey", body.alias("body"))


def listings(customer: DataFrame) -> DataFrame:
    """(body): a scheduler's listing with the flag in all spellings."""
    k = F.col("c_custkey")
    name = F.concat(F.when(k % 9 == 0, "other-").otherwise("claims-"), k.cast("string"))
    cron = F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit('"'), _pick(["cron", "schedule"], k % 2), F.lit('": "'), (k % 60).cast("string"), F.lit(' 3 * * *", ')))
    body = F.concat(F.lit('{"name": "'), name, F.lit('", '), cron, _pick(FLAGS, k % len(FLAGS)), F.lit("}"))
    return customer.select(F.when(k % 31 == 0, "[]").otherwise(body).alias("body"))
