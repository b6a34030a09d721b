"""Whole runs in a workspace of files."""

import io
import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from claimloom import __main__ as command_line
from claimloom.functions.dates import clock
from claimloom.plans import engine
from claimloom.plans.engine import EVENT, Engine, Settings, upgrade_needed, version_of
from claimloom.plans.scorers import AskingScorer, Command, NoRecord, Records, ReplayScorer, RuleScorer, ScorerUnavailable, payload_key
from claimloom.plans.store import TABLES, Store
from claimloom.schemas import CLAIM, MANIFEST_KEYS, VERDICT
from claimloom.sources.jsonl import read_records
from claimloom.streaming.runlog import event_stream, status_counts, write_counts

# Workers can't import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(autouse=True, scope="module")
def small_plans(spark):
    """A run is many small jobs here: they are not planned anew while they run, nor compiled, and write few files."""
    settings = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.enabled": "false", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def place(tmp_path):
    work = tmp_path / "workspace"
    (work / "episodes").mkdir(parents=True)
    (work / "MEMORY.md").write_text("# MEMORY\n\nOperator Ann lives in Lisbon.\n\nOperator Bob likes tea.\n")
    (work / "PROCEDURES.md").write_text("# PROCEDURES\n## Debug\nInspect the logs first.\n")
    (work / "RTMEMORY.md").write_text("Lesson: write it down.\n")
    (work / "episodes" / "one.md").write_text("What happened on the day.\n")
    return tmp_path


def go(spark, place, run_id, scorer=None, **more):
    s = Settings(str(place / "workspace"), str(place / "store"), run_id, f"2025-03-01T00:00:0{run_id[-1]}Z", **more)
    return Engine(spark, s, scorer).run()


def test_runs(spark, place):
    first = go(spark, place, "r1")
    assert first["status"] == "ok" and first["delta"] == "first_run_full" and first["claims_new"] == 5, first
    store = Store(spark, str(place / "store"))
    one = {r["id"]: r["status"] for r in store.load("claims", CLAIM).collect()}
    view = store.read_text("v=r1/views/LTMEMORY.md")
    assert "## Facts" in view and "Bob likes tea" in view and json.loads(store.read_text("signal.json"))["claims"] == 5

    again = go(spark, place, "r2")
    assert again["status"] == "skipped" and again["claims_total"] == 5
    assert go(spark, place, "r1")["status"] == "failed" and store.load("claims", CLAIM).count() == 5  # its id is taken

    (place / "workspace" / "MEMORY.md").write_text("# MEMORY\n\nOperator Ann lives in Lisbon.\n\nOperator Cal likes rum.\n")
    third = go(spark, place, "r3")
    assert third["status"] == "ok" and third["delta"] == "delta"
    two = {r["id"]: r["status"] for r in store.load("claims", CLAIM).collect()}
    assert set(one) <= set(two) and len(two) == 6

    (place / "workspace" / "RTMEMORY.md").unlink()
    sweep = go(spark, place, "r4")
    assert sweep["status"] == "ok" and any("RTMEMORY" in w for w in sweep["warnings"])
    three = {r["source"]: r["status"] for r in store.load("claims", CLAIM).selectExpr("provenance[0].source as source", "status").collect()}
    assert three["RTMEMORY.md"] == "retire_candidate" and three["PROCEDURES.md"] == "resolved"
    assert store.held_by() is None

    stream = write_counts(status_counts(event_stream(spark, str(place / "store" / "events"))), str(place / "days"), str(place / "marks"))
    stream.awaitTermination()
    assert stream.exception() is None


def test_pending_candidates_come_back(spark, place):
    first = go(spark, place, "r1", batch_size=2, batch_cap=1)
    assert first["status"] == "ok" and first["pending"] == 3 and first["claims_total"] == 2
    second = go(spark, place, "r2", batch_size=2, batch_cap=1)
    assert second["status"] == "ok" and second["pending"] == 1 and second["claims_total"] == 4


def test_bad_verdicts_stop_the_run(spark, place):
    class Wrong(RuleScorer):
        def verdicts(self, candidates):
            return super().verdicts(candidates).limit(1)

    bad = go(spark, place, "r1", Wrong())
    assert bad["status"] == "partial_failure" and bad["failed"] == "verdicts"
    assert go(spark, place, "r2")["claims_new"] == 5  # the same changes are seen again


def test_profiles_and_denied(spark, place):
    (place / "workspace" / "DREAMS.md").write_text("I want to sail around the world.\n")
    denied = go(spark, place, "r1", checked_paths=["runtime/x.json"])
    assert denied["status"] == "failed"
    personal = go(spark, place, "r2", profile="personal")
    assert "WISHES.md" in personal["views"] and personal["claims_total"] == 6


def test_rejecting_scorer(spark, place):
    recorded = RuleScorer({"noise_risk": 0.9}).verdicts(spark.createDataFrame([("none",)], "candidate_id string"))
    # What has no record is not judged by rule unless that is asked for.
    assert go(spark, place, "r0", ReplayScorer(recorded))["status"] == "partial_failure"
    got = go(spark, place, "r1", ReplayScorer(recorded, rest_by_rule=True))
    assert got["status"] == "ok"
    assert go(spark, place, "r2", RuleScorer({"noise_risk": 0.9}))["status"] == "skipped"


def test_lock(spark, place):
    store = Store(spark, str(place / "store"))
    store.lock("other")
    assert go(spark, place, "r1")["status"] == "skipped"
    store.unlock(store.lock("next", now=9e12))  # the first has gone stale by then
    assert go(spark, place, "r2")["status"] == "ok"


def test_versions_and_settings():
    assert version_of("1.10.2-x") == (1, 10, 2) and upgrade_needed({"logic": "0.9", "manifest_schema": "1.0.0", "artifact_schema": "1.0.0"}) and not upgrade_needed({})
    s = Settings.resolve({}, {"PROFILE": "personal-assistant", "WORKSPACE": "e"}, {"profile": "business", "workspace": "c"}, run_id="r", now="n")
    assert (s.profile, s.workspace) == ("personal", "c")


def verdict_json(candidate_id):
    scores = {"durability": 0.6, "future_judgment_value": 0.6, "action_value": 0.6, "identity_relationship_weight": 0.6, "cross_time_persistence": 0.6, "noise_risk": 0.1}
    return {"candidate_id": candidate_id, "scores": scores, "strength": 2.9, "verdict": "promote", "rationale": "r", "merge_candidate_ids": [], "compress_target": None}


class Answering:
    """Answers each batch as asked; the first answers to a batch with ``slow`` in it are broken."""

    def __init__(self, folder, broken=0, foreign=False):
        self.folder, self.broken, self.foreign = folder, broken, foreign

    def preflight(self):
        pass

    def __call__(self, step, payload):
        given = json.loads(payload)
        if step == "promotion":
            ids = [c["candidate_id"] for c in given["candidates"]]
            seen = self.folder / f"{payload_key(payload)}.asked"
            tries = int(seen.read_text()) if seen.exists() else 0
            seen.write_text(str(tries + 1))
            if tries < self.broken and any("Lisbon" in c["text"] for c in given["candidates"]):
                return "I am not sure."
            rows = [verdict_json(i) for i in ids + ["someone-else"] * self.foreign]
            return json.dumps({"response": "Here it is:\n" + json.dumps({"run_id": given["run_id"], "verdicts": rows})})
        rows = []
        for c in given["clusters"]:
            refs = [
                {"source": r["source"], "line_span": r["line_span"], "type": "direct", "captured_at": r["captured_at"]} for m in c["candidates"] for r in m["source_refs"]
            ]
            canonical = {
                "type": "fact", "status": "resolved", "text": c["candidates"][0]["text"], "subject": "s", "predicate": "p", "object": None,
                "primary_home": "LTMEMORY.md", "secondary_tags": []
            }
            scores = dict.fromkeys(
                [
                    "semantic_cluster_confidence", "canonical_clarity", "provenance_strength", "contradiction_pressure", "freshness",
                    "confidence", "route_fitness", "supersession_confidence"
                ],
                0.5
            )
            rows.append(
                {
                    "claim_id": "<new>", "source_cluster_id": c["cluster_id"], "scores": scores, "canonical": canonical, "provenance": refs,
                    "contradictions": [], "supersedes": [], "superseded_by": []
                }
            )
        return json.dumps({"run_id": given["run_id"], "canonical_claims": rows})


def test_only_broken_batches_are_asked_again(spark, place):
    asked = place / "asked"
    asked.mkdir()
    got = go(spark, place, "r1", AskingScorer(Answering(asked, broken=1, foreign=True), "r1"), batch_size=2)
    assert got["status"] == "ok" and got["claims_new"] == 5 and got["validation"] == "ok"
    # Three batches of five candidates: one of them was asked for twice.
    assert sorted(int(p.read_text()) for p in asked.iterdir()) == [1, 1, 2]
    assert not (place / "store" / "failures").exists() or not list((place / "store" / "failures").rglob("*.json"))


def test_failure_records(spark, place):
    asked = place / "asked"
    asked.mkdir()
    got = go(spark, place, "r1", AskingScorer(Answering(asked, broken=9), "r1"), batch_size=2)
    assert got["status"] == "partial_failure" and got["failed"] == "verdicts" and got["attempts"] == 2
    assert got["partial_failures"][0]["pass"] == "verdicts" and {r for _, r in got["errors"]} == {"candidate_missing"}
    kept = spark.read.json(str(place / "store" / got["record"]))
    kinds = {r["kind"]: r["n"] for r in kept.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds["error"] == 2 and kinds["payload"] == 2
    assert [r["body"] for r in kept.where("kind = 'raw'").collect()] == ["I am not sure."]
    assert (place / "store" / "v=r1" / "candidates").exists()  # a failed run keeps what it wrote


def test_a_replay_by_payload(spark, place, tmp_path):
    folder = tmp_path / "answers"
    folder.mkdir()
    candidates = spark.createDataFrame([("c1",), ("c2",)], "candidate_id string")
    payload = AskingScorer(Records(str(folder)), "r1").answers(
        "promotion", candidates.withColumn("batch", F.lit(0).cast("long")), "candidates", "candidate_id"
    ).first()["payload"]
    scorer = lambda **how: AskingScorer(Records(**how), "r1")
    ids = lambda s: sorted(r["candidate_id"] for r in s.verdicts(candidates).collect())
    assert ids(scorer(folder=str(folder))) == []  # an error, kept with the batch
    assert "NoRecord" in scorer(folder=str(folder)).answers(
        "promotion", candidates.withColumn("batch", F.lit(0).cast("long")), "candidates", "candidate_id"
    ).first()["error"]
    with pytest.raises(NoRecord, match=payload_key(payload)):
        Records(str(folder))("promotion", payload)
    say = lambda *ids: json.dumps({"run_id": "r1", "verdicts": [verdict_json(i) for i in ids]})
    (folder / "promotion-default.json").write_text(say("c1"))
    assert ids(scorer(folder=str(folder))) == ["c1"]
    (folder / f"promotion-{payload_key(payload)}.json").write_text(say("c1", "c2"))
    assert ids(scorer(folder=str(folder))) == ["c1", "c2"]
    (tmp_path / "one.json").write_text(say("c2"))
    assert ids(scorer(folder=str(folder), file=str(tmp_path / "one.json"))) == ["c2"]
    (tmp_path / "one.json").write_text(json.dumps({"run_id": "another", "verdicts": [verdict_json("c2")]}))
    assert ids(scorer(file=str(tmp_path / "one.json"))) == []
    assert payload_key('{"a": 1, "b": 2}') == payload_key('{"b": 2, "a": 1}')


def test_a_scorer_that_is_not_there(spark, place):
    for ask in (Records(str(place / "nowhere")), Records(), Records(file=str(place / "no.json")), Command(["no-such-program"])):
        with pytest.raises(ScorerUnavailable):
            ask.preflight()
    got = go(spark, place, "r1", AskingScorer(Records(str(place / "nowhere"))))
    assert got["status"] == "failed" and "not available" in got["reason"] and Store(spark, str(place / "store")).held_by() is None


def test_a_program_answers(spark, place):
    program = place / "judge.py"
    program.write_text(
        "import json, sys\ngiven = json.load(sys.stdin)\nprint(json.dumps({'run_id': given['run_id'], 'verdicts': [{'candidate_id': c['candidate_id'], 'verdict': sys.argv[1]} for c in given['candidates']]}))\n"
    )
    candidates = spark.createDataFrame([("c1",)], "candidate_id string")
    got = AskingScorer(Command([sys.executable, str(program)])).verdicts(candidates)
    assert got.schema.fieldNames() == VERDICT.fieldNames() and got.first()["verdict"] == "promotion"
    with pytest.raises(RuntimeError, match="exit 3"):
        Command([sys.executable, "-c", "raise SystemExit(3)"])("promotion", "{}")


def test_what_a_run_leaves(spark, place):
    told = []
    got = go(spark, place, "r1", timezone="Pacific/Auckland", agent="ann", json_lines=True, downstream=told.append)
    store = Store(spark, str(place / "store"))
    assert got["status"] == "ok" and told == [{"run_id": "r1", "claims": 5}]
    assert set(store.names("v=r1")) == {*TABLES, "views", "warnings", "violations", "claims.jsonl", "contradictions.jsonl"}
    manifest = store.manifest()
    assert set(MANIFEST_KEYS) <= set(manifest) and manifest["finishedAt"] == "2025-03-01T13:00:01+13:00" and manifest["timezone"] == "Pacific/Auckland"
    assert "2025-03-01 13:00 Pacific/Auckland" in store.read_text("v=r1/views/LTMEMORY.md")
    events = spark.read.schema(EVENT).json(str(place / "store" / "events")).collect()
    assert {(r["event"], r["agent"], r["timezone"]) for r in events} == {("run_started", "ann", "Pacific/Auckland"), ("run_completed", "ann", "Pacific/Auckland")}
    assert json.loads(store.read_text("last-runs.json"))["incremental"] == manifest["finishedAt"]
    assert spark.read.json(str(place / "store" / "v=r1" / "claims.jsonl")).count() == 5
    # The local day, not that of UTC, names the log's folder.
    late = Settings(str(place / "workspace"), str(place / "store"), "r2", "2025-03-01T23:30:00Z", timezone="Nowhere/None")
    assert Engine(spark, late).run()["status"] == "skipped" and "log_date=2025-03-02" in store.names("events")
    assert "v=r2" not in store.names("")
    assert clock("2025-03-01T23:30:00Z", "Nowhere/None") == {"timestamp": "2025-03-02T07:30:00+08:00", "timestamp_utc": "2025-03-01T23:30:00Z", "timezone": "Asia/Manila"}


def test_a_broken_version_is_not_published(spark, place, monkeypatch):
    monkeypatch.setattr(engine.merge, "route_rows", lambda claims: claims.select(F.lit("EPISODES.md").alias("home"), F.col("id").alias("claim_id")))
    got = go(spark, place, "r1")
    assert got["status"] == "partial_failure" and got["failed"] == "validate" and ("route_home" in {r for _, r in got["errors"]})
    assert Store(spark, str(place / "store")).manifest() == {}
    monkeypatch.undo()
    assert go(spark, place, "r2")["claims_new"] == 5


def test_upgrades_leave_a_marker(spark, place, monkeypatch):
    def broken(signal):
        raise OSError("no line")

    first = go(spark, place, "r1", downstream=broken)  # what comes downstream can't fail a run
    assert first["status"] == "ok" and "downstream: OSError: no line" in first["warnings"]
    monkeypatch.setattr(engine, "LOGIC", "2.0.0")
    store = Store(spark, str(place / "store"))
    got = go(spark, place, "r2")
    assert got["status"] == "upgrade_required" and store.names("_upgrades") == ["upgrade-pending-1.0.0-2.0.0.json"] and got["upgrade"]["reason"] == "logic_mismatch"
    assert go(spark, place, "r3", acknowledge_upgrade=True)["status"] == "ok" and store.names("_upgrades") == []


def test_records_from_a_file_or_standard_input(spark, tmp_path):
    body = {"verdicts": [{"candidate_id": "a", "strength": 1.5}, {"candidate_id": "b"}]}
    (tmp_path / "x.json").write_text(json.dumps(body, indent=1))
    for got in (read_records(spark, str(tmp_path / "x.json"), VERDICT, "verdicts"), read_records(spark, "-", VERDICT, "verdicts", io.StringIO(json.dumps(body)))):
        assert [(r["candidate_id"], r["strength"]) for r in got.orderBy("candidate_id").collect()] == [("a", 1.5), ("b", None)]
    assert read_records(spark, "-", VERDICT, None, io.StringIO("no json")).count() == 0
    assert read_records(spark, "-", VERDICT, None, io.StringIO('{"candidate_id": "c"}')).first()["candidate_id"] == "c"


def test_command_line(spark, place, monkeypatch, capsys):
    given = {"workspace": str(place / "workspace"), "store": str(place / "store"), "run_id": "r1", "now": "2025-03-01T00:00:00Z"}
    monkeypatch.setattr(sys, "stdin", io.StringIO(json.dumps(given)))
    assert command_line.main("-") == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["claims_new"] == 5
