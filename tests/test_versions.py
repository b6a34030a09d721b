"""What a crash or a race leaves of the store, and what a version writes."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from claimloom.plans import store as stores
from claimloom.plans.engine import Engine, Settings
from claimloom.plans.files import HadoopFiles, LocalFiles
from claimloom.plans.scorers import RuleScorer
from claimloom.plans.store import LockHeld, LockLost, Store, bucket_of
from claimloom.schemas import CLAIM


@pytest.fixture(autouse=True, scope="module")
def small_plans(spark):
    """Many small jobs: they are not planned anew while they run, nor compiled."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def place(tmp_path):
    (tmp_path / "workspace" / "episodes").mkdir(parents=True)
    return tmp_path


def write(place, *notes):
    (place / "workspace" / "MEMORY.md").write_text("# MEMORY\n\n" + "\n\n".join(notes) + "\n")


def engine(spark, place, run_id, scorer=None, **more):
    return Engine(spark, Settings(str(place / "workspace"), str(place / "store"), run_id, f"2025-03-01T00:00:0{run_id[-1]}Z", buckets=16, **more), scorer)


def versions(place):
    return {p.name: {t: sorted(b.name for b in (p / t).glob("bucket=*")) for t in ("claims", "entities", "routes", "contradictions", "inventory")} for p in (place / "store").glob("v=*")}


@pytest.mark.parametrize("kind", [LocalFiles, HadoopFiles])
def test_files(spark, tmp_path, kind):
    files = kind(str(tmp_path)) if kind is LocalFiles else kind(spark, str(tmp_path))
    assert files.read("a/x.json") is None
    assert files.create("a/x.json", "é") and not files.create("a/x.json", "two")
    assert files.read("a/x.json") == "é"
    files.replace("a/x.json", "three")
    files.replace("b.txt", "new")
    assert files.read("a/x.json") == "three" and files.read("b.txt") == "new"
    assert not [p for p in tmp_path.rglob("*") if "tmp" in p.name]


@pytest.mark.parametrize("step", ["link", "replace"])
def test_a_publish_that_crashes(spark, place, monkeypatch, step):
    """Stopped before the manifest is there, the version before stays; after it, the new one counts."""
    write(place, "Operator Ann lives in Lisbon.")
    assert engine(spark, place, "r1").run()["status"] == "ok"
    store = Store(spark, str(place / "store"))
    write(place, "Operator Ann lives in Lisbon.", "Operator Bob likes tea.")

    def stop(source, target, real=getattr(os, step)):
        if "manifest" in str(target):
            raise OSError("power cut")
        return real(source, target)

    monkeypatch.setattr(os, step, stop)
    with pytest.raises(OSError, match="power cut"):
        engine(spark, place, "r2").run()
    monkeypatch.undo()
    done = step == "replace"  # the copy for people is made after the manifest
    assert store.manifest()["runId"] == ("r2" if done else "r1") and store.load("claims", CLAIM).count() == (2 if done else 1)
    assert store.held_by() is None
    if not done:
        last = engine(spark, place, "r3").run()
        assert last["status"] == "ok" and last["claims_total"] == 2


def test_a_torn_manifest_is_passed_over(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    lock = store.lock("r1")
    store.publish("r1", {"runId": "r1"}, after=0, lock=lock)
    (tmp_path / "manifests" / f"{2:012d}.json").write_text('{"runId": "r')
    assert store.current()[0] == 2 and store.manifest()["runId"] == "r1"
    store.publish("r3", {"runId": "r3"}, after=2, lock=lock)
    assert store.current()[0] == 3 and store.manifest()["version_dir"] == "v=r3"


def test_racing_takers(spark, tmp_path):
    """Of many that take a free lock, a stale one, or one whose file is empty, one gets it."""
    store = Store(spark, str(tmp_path))

    def race(now):
        got, held, gate = [], [], threading.Barrier(8)

        def take(k):
            gate.wait()
            try:
                got.append(store.lock(f"run{k}", now=now))
            except LockHeld as by:
                held.append(str(by))

        threads = [threading.Thread(target=take, args=(k,)) for k in range(8)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(got) == 1 and len(held) == 7
        return got[0]

    first = race(1000.0)
    with pytest.raises(LockHeld):
        store.lock("late", now=1000.0 + stores.STALE_LOCK_SECONDS - 1)
    second = race(1000.0 + stores.STALE_LOCK_SECONDS)
    with pytest.raises(LockLost):
        store.fence(first)
    store.fence(second)
    store.unlock(first)  # of who was taken over: frees nothing
    assert store.held_by() is not None
    store.unlock(second)
    assert store.held_by() is None
    (tmp_path / "locks" / f"{second + 1:012d}.json").write_text("")
    with pytest.raises(LockHeld):  # just created by someone else, not stale
        store.lock("eager")


def test_a_run_that_was_taken_over_publishes_nothing(spark, place):
    write(place, "Operator Ann lives in Lisbon.")
    store = Store(spark, str(place / "store"))

    class Slow(RuleScorer):
        """While the first run judges, its lock goes stale and another run takes over and publishes."""

        def verdicts(self, candidates):
            if not hasattr(self, "slept"):
                self.slept = True
                store.unlock(store.lock("other", now=9e12))
                assert engine(spark, place, "r2").run()["status"] == "ok"
            return super().verdicts(candidates)

    got = engine(spark, place, "r1", Slow()).run()
    assert got["status"] == "skipped_superseded" and store.manifest()["runId"] == "r2" and "v=r1" not in versions(place)
    # The fence looks at locks; what was published meanwhile is seen even by a run whose lock is the last.
    lock = store.lock("r3")
    with pytest.raises(LockLost, match="published"):
        store.publish("r3", {}, after=0, lock=lock)


def test_a_version_writes_the_buckets_that_change(spark, place):
    notes = [f"Operator Person{i} keeps note number {i} about topic{i}." for i in range(60)]
    write(place, *notes)
    assert engine(spark, place, "r1", batch_size=100).run()["claims_total"] == 60
    store = Store(spark, str(place / "store"))
    before = store.load("claims", CLAIM)
    assert len(versions(place)["v=r1"]["claims"]) > 12
    (place / "workspace" / "episodes" / "one.md").write_text("What happened on the day.\n")
    got = engine(spark, place, "r2").run()
    assert got["status"] == "ok" and got["claims_new"] == 1 and got["claims_total"] == 61
    made = versions(place)["v=r2"]
    new = store.load("claims", CLAIM).where("updated_in_run_id = 'r2'")
    assert made["claims"] == [f"bucket={r['b']}" for r in new.select(bucket_of("id", 16).alias("b")).collect()] == made["entities"]
    assert set(made["routes"]) <= {"bucket=0", *made["claims"]} and made["contradictions"] == [] and len(made["inventory"]) == 1
    assert store.load("claims", CLAIM).join(before, "id", "left_anti").count() == 1 and before.join(store.load("claims", CLAIM), "id", "left_anti").count() == 0
    assert store.load("claims", CLAIM).agg(F.countDistinct("ord")).first()[0] == 61
    manifest = store.manifest()
    routed = store.load("routes", "home string, claim_id string")
    assert routed.where("claim_id is not null").count() == 61 and routed.where("claim_id is null").count() == 5 - routed.where("claim_id is not null").select("home").distinct().count()
    assert store.load("entities", "subject string, claim_id string").count() == store.load("claims", CLAIM).where("subject <> ''").count()
    assert manifest["sourceInventory"]["sources"] == 2 and json.loads((place / "store" / "manifest.json").read_text()) == manifest

    # A lost source retires its claim, in its bucket alone.
    (place / "workspace" / "episodes" / "one.md").unlink()
    assert engine(spark, place, "r3").run()["status"] == "ok"
    assert versions(place)["v=r3"]["claims"] == made["claims"]
    assert store.load("claims", CLAIM).where("status = 'retire_candidate'").count() == 1
    rows = sorted(map(str, store.load("claims", CLAIM).collect()))
    gone = store.vacuum()
    assert gone and sorted(map(str, store.load("claims", CLAIM).collect())) == rows and f"v=r2/claims/{made['claims'][0]}" in gone or "v=r2" in gone
    assert store.vacuum() == []
