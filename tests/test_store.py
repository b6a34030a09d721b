"""Merging, retirement, integrity and retrieval on small tables."""

from pyspark.sql import functions as F

from claimloom.operators import clusters, delta, integrity, merge, resolve, retrieval
from claimloom.schemas import CLAIM


def claim(ord_, id_, **more):
    base = {f: None for f in CLAIM.fieldNames()} | {
        "ord": ord_, "id": id_, "type": "fact", "status": "resolved", "text": "some text", "subject": "cat", "predicate": "sleeps", "primary_home": "LTMEMORY.md", "secondary_tags": [],
        "provenance": [
            ("MEMORY.md", [1, 2], "direct", "2025-01-01T00:00:00Z")
        ], "contradictions": [], "supersedes": [], "superseded_by": [], "updated_at": "2025-01-01T00:00:00Z", "retirement_reasons": [],
    }
    return tuple((base | more)[f] for f in CLAIM.fieldNames())


def table(spark, *rows):
    return spark.createDataFrame(list(rows), CLAIM)


def test_upsert_keeps_place_and_last_wins(spark):
    prior = table(spark, claim(0, "a"), claim(1, "b"), claim(2, None))
    new = table(spark, claim(0, "b", text="first"), claim(1, "b", text="second"), claim(2, "c"))
    got = {r["id"]: (r["ord"], r["text"]) for r in merge.upsert_claims(prior, new).collect()}
    assert got["b"] == (1, "second") and got["a"][0] == 0 and set(got) == {"a", "b", "c"} and got["c"][0] > 1


def test_supersession_and_chain(spark):
    prior = table(spark, claim(0, "a", status="superseded", superseded_by=["b"]), claim(1, "b"))
    new = table(spark, claim(0, "n", supersedes=["a", "n", "zz"]))
    merged = merge.apply_supersession(merge.upsert_claims(prior, new), new, "r")
    got = {r["id"]: (r["status"], r["superseded_by"]) for r in merged.collect()}
    assert got["a"] == ("superseded", ["b", "n"]) and got["n"] == ("resolved", []) and got["b"] == ("resolved", [])
    assert [tuple(r) for r in merge.chain_warnings(new, prior).collect()] == [("n", "a", "b")]


def test_retirement_needs_all_sources_gone(spark):
    two = [("MEMORY.md", [1, 1], "direct", ""), ("OTHER.md", [1, 1], "direct", "")]
    rows = table(spark, claim(0, "a"), claim(1, "b", provenance=two), claim(2, "c", status="stale"), claim(3, "d", provenance=[]))
    gone = spark.createDataFrame([("MEMORY.md",)], "path string")
    got = {r["id"]: (r["status"], len(r["retirement_reasons"])) for r in merge.retire_unsourced(rows, gone, "r").collect()}
    assert got == {"a": ("retire_candidate", 1), "b": ("resolved", 0), "c": ("stale", 0), "d": ("resolved", 0)}


def test_reuse_across_wordings(spark):
    prior = table(
        spark, claim(0, "old", subject="cat", predicate="prefers"),
        claim(1, "newer", subject="The cats", predicate="prefer", updated_at="2025-02-01T00:00:00Z"),
        claim(2, "gone", status="superseded", updated_at="2026-01-01T00:00:00Z")
    )
    new = table(spark, claim(0, "x", subject="cats", predicate="prefers"), claim(1, "y", subject="", predicate="p"))
    assert [tuple(r) for r in resolve.exact_reuse(new, prior).collect()] == [("x", "newer")]


def test_probable_duplicate_first_of_ties(spark):
    prior = table(
        spark, claim(5, "p5", predicate="moves", object="home"), claim(3, "p3", predicate="moves", object="home"),
        claim(1, "weak", predicate="moves", text="quite different words")
    )
    new = table(spark, claim(0, "x", predicate="relocates", object="Home"))
    got = resolve.probable_duplicates(new, prior).first()
    assert (got["target_id"], got["score"]) == ("p3", 0.9)
    kinds = {r["id"]: (r["disposition"], r["duplicate_reason"]) for r in resolve.dispositions(new, prior).collect()}
    assert kinds["x"] == ("probable_duplicate", "composite_0.90_subject")


def test_clusters(spark):
    schema = "candidate_id string, text string, type_hint string, source_refs array<struct<source:string,line_span:array<int>,captured_at:string>>, verdict string, rationale string, merge_candidate_ids array<string>, compress_target string"
    rows = [
        (f"c{i}", f"Alpha Beta{i % 2}", ["fact", "lesson"][i % 2], [("M.md", [1, 1], "")], "promote", "", m, None)
        for i, m in enumerate([["c1"], [], ["gone"], ["c4"], []])
    ]
    got = clusters.build_clusters(spark.createDataFrame(rows, schema)).collect()
    sizes = {tuple(c["candidate_id"] for c in r["candidates"]): r["cluster_hints"] for r in got}
    assert set(sizes) == {("c0", "c1"), ("c2",), ("c3", "c4")}
    hint = sizes[("c0", "c1")]
    assert hint["shared_entities"] == ["Alpha"] and hint["proposed_type"] == "fact" and hint["shared_subject"] == "M.md" and hint[
        "proposed_primary_home"
    ] == "LTMEMORY.md"


def test_long_chain_of_merges(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "src long, dst long")
    labels = clusters.merge_components(edges, spark.range(n + 1))
    assert {(r["id"], r["component"]) for r in labels.collect()} == {(i, 0) for i in range(n)} | {(n, n)}


def test_integrity(spark):
    rows = table(
        spark, claim(0, "a", supersedes=["a", "b", "zz"]), claim(1, "b"), claim(2, "b", type="milestone", primary_home="LTMEMORY.md"),
        claim(3, "d", text="  ", provenance=[], secondary_tags=["LTMEMORY.md"])
    )
    got = {(r["id"], r["rule"]) for r in integrity.claim_violations(rows, "business").collect()}
    assert {
        ("a", "supersedes_self"), ("a", "warn:supersedes_dangling"), ("a", "supersedes_one_sided"), ("b", "id_duplicate"),
        ("b", "route_impossible"), ("d", "text_empty"), ("d", "provenance_empty"), ("d", "warn:self_tag")
    } <= got
    assert integrity.report_status(integrity.claim_violations(rows.where("id = 'none'"), "business")).first()["status"] == "ok"


def test_routes_and_entities_of_nothing(spark):
    empty = spark.createDataFrame([], CLAIM)
    assert merge.routes(empty).count() == 5 and merge.entities(empty).count() == 0
    assert merge.routes(empty).where(F.size("claim_ids") > 0).isEmpty()


def test_scope(spark):
    one = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "path string, content_hash string")
    two = spark.createDataFrame([("a", "1"), ("b", "3"), ("d", "4"), ("c", None)], "path string, content_hash string")
    scope, kind, gone = delta.select_scope(two, one, "incremental")
    assert kind == "delta" and {r["path"] for r in scope.collect()} == {"b", "d"} and gone.isEmpty()
    assert [r["path"] for r in delta.removed_sources(two.where("path <> 'a'"), one).collect()] == ["a"]
    assert delta.select_scope(two, None, "incremental")[1] == "first_run_full"
    assert delta.cursor_hash(one).first() == delta.cursor_hash(one.orderBy(F.desc("path"))).first()


def ask(spark, *rows):
    return spark.createDataFrame(list(rows), "cluster_id string, subject string, entities array<string>, text string, proposed_type string, proposed_home string")


def test_relevance_beats_recency(spark):
    prior = table(
        spark, claim(0, "topic", subject="python", text="python packaging rules", updated_at="2020-01-01T00:00:00Z"),
        *[
            claim(
                i, f"o{i}", subject="rust", text="unrelated words", type="lesson", primary_home="PLAYBOOKS.md",
                updated_at=f"2025-01-{i % 28 + 1:02d}T00:00:00Z"
            ) for i in range(1, 60)
        ]
    )
    got = retrieval.widened(retrieval.ranked_priors(ask(spark, ("c", "python", [], "python packaging", "fact", "LTMEMORY.md")), prior)).where("rank <= 3")
    assert "topic" in {r["claim_id"] for r in got.collect()}


def test_no_cluster_starves_and_noise_is_cut(spark):
    langs = ["python", "rust", "typescript"]
    prior = table(
        spark,
        *[claim(20 * k + i, f"{x}{i}", subject=x, text=f"{x} note {i}", type="lesson", primary_home="PLAYBOOKS.md") for k, x in enumerate(langs) for i in range(20)]
    )
    asks = ask(spark, *[(x, x, [], f"{x} note", "fact", "LTMEMORY.md") for x in langs], ("none", "zzz", [], "qqq", "episode", "EPISODES.md"))
    got = retrieval.widened(retrieval.ranked_priors(asks, prior))
    sizes = {r["cluster_id"]: r["count"] for r in got.groupBy("cluster_id").count().collect()}
    assert all(sizes[x] >= 5 for x in langs) and "none" not in sizes
    ids = retrieval.contradiction_candidates(got, spark.createDataFrame([("rust", ["given", "rust0"])], "cluster_id string, ids array<string>"))
    first = {r["cluster_id"]: r["ids"] for r in ids.collect()}["rust"]
    assert first[0] == "given" and len(first) == len(set(first)) <= 5


def test_same_subject_window(spark):
    prior = table(spark, claim(0, "old", subject="python"), claim(1, "new", subject="python", updated_at="2025-02-20T00:00:00Z"))
    asks = ask(spark, ("c", "python", [], "", None, None))
    got = {r["claim_id"]: r["score"] for r in retrieval.ranked_priors(asks, prior, F.lit("2025-03-01T00:00:00Z")).where("rank > 0").collect()}
    assert got["new"] == got["old"] + 1.0


def test_delivery_reads_only_good_values():
    from claimloom.operators.schedule import Delivery

    got = Delivery.read(
        {"claims": {"reporting": {"enabled": True, "delivery": {"channel": "", "to": 5}}}},
        {"cron": {"tz": "", "timeout_seconds": -1, "announce_channel": "c"}}
    )
    assert got == Delivery(True, "c", None, "Asia/Manila", 1200)
    assert Delivery.read({"claims": {"reporting": {"enabled": "yes"}}}, None).enabled is None


def test_delivery_actions(spark):
    from claimloom.operators import schedule

    jobs = spark.createDataFrame(
        [("p-a", "0 3 * * *", "", None), ("p-b", "0 3 * * *", "", True), ("p-c", " ", "", False), ("p-d", "0 3 * * *", "UTC", False), ("x", "", "", False)],
        "name string, cron string, tz string, deliver boolean"
    )
    act = lambda d: {r["name"]: r["action"] for r in schedule.delivery_actions(jobs, d, "p-").collect()}
    assert act(schedule.Delivery(True, "c", "t")) == {"p-a": "skipped_indeterminate", "p-b": "in_sync", "p-c": "skipped_missing_fields", "p-d": "would_update"}
    assert act(schedule.Delivery(True, "c"))["p-d"] == "skipped_missing_announce_target" and act(schedule.Delivery()) == {}
    assert schedule.sync_status(schedule.delivery_actions(jobs, schedule.Delivery(False), "p-")).first()["status"] == "synced"


def test_json_lines(spark, tmp_path):
    from claimloom.sources import jsonl

    (tmp_path / "x.jsonl").write_text('{"ord": null, "id": "a"}\n\nnot json\n{"id": "b", "text": "t"}\n[1]\n')
    got = jsonl.read_jsonl(spark, str(tmp_path / "x.jsonl"), CLAIM)
    assert [(r["id"], r["text"]) for r in got.orderBy("ord").collect()] == [("a", None), ("b", "t")]
    lines = spark.createDataFrame([(1, "{}"), (2, "bad"), (3, " ")], "line int, value string")
    assert [r["line"] for r in jsonl.jsonl_errors(lines).collect()] == [2]
    assert jsonl.read_json_object(spark, str(tmp_path / "none.json"), CLAIM).count() == 0
