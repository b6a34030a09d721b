"""The two judging steps. An engine run takes any object with these two methods."""

from __future__ import annotations

import hashlib
import json
import shutil
import subprocess
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.recovery import recovered_json, unwrapped
from claimloom.operators.retrieval import prior_context
from claimloom.operators.verdicts import rule_verdict, strength
from claimloom.schemas import CANONICAL, CLAIM_SCORES, PERSONAL_HOMES, VERDICT, VERDICT_SCORES


class Scorer(Protocol):
    """A scorer may also have ``preflight()``, which raises ScorerUnavailable. Rows come with their ``batch``."""

    def verdicts(self, candidates: DataFrame) -> DataFrame:
        """A verdict (schemas.VERDICT) for each candidate."""

    def claims(self, clusters: DataFrame, priors: DataFrame, profile: str) -> DataFrame:
        """A canonical claim for each cluster (see ``RuleScorer.claims`` for the columns)."""


class RuleScorer:
    """Fixed rules in place of a model: constant scores, every candidate passes, a cluster's first text is its claim."""

    def __init__(self, scores: dict[str, float] | None = None):
        self.scores = dict.fromkeys(VERDICT_SCORES, 0.6) | {"noise_risk": 0.1} | (scores or {})

    def verdicts(self, candidates: DataFrame) -> DataFrame:
        scores = F.struct(*[F.lit(self.scores[n]).alias(n) for n in VERDICT_SCORES])
        total = strength(lambda n: F.lit(self.scores[n]))
        return candidates.select(
            "candidate_id", scores.alias("scores"), total.alias("strength"), rule_verdict(total, F.lit(self.scores["noise_risk"])).alias("verdict"),
            F.lit("by rule").alias("rationale"), F.array().cast("array<string>").alias("merge_candidate_ids"), F.lit(None).cast("string").alias("compress_target"),
        )

    def claims(self, clusters: DataFrame, priors: DataFrame, profile: str) -> DataFrame:
        hints, first = F.col("cluster_hints"), F.get(F.col("candidates"), F.lit(0))
        kind = F.when(hints["proposed_primary_home"].isNull(), "fact").otherwise(hints["proposed_type"])
        home = F.coalesce(hints["proposed_primary_home"], F.lit("LTMEMORY.md"))
        home = home if profile == "personal" else F.when(home.isin(PERSONAL_HOMES), "LTMEMORY.md").otherwise(home)
        kind = kind if profile == "personal" else F.when(hints["proposed_primary_home"].isin(PERSONAL_HOMES), "fact").otherwise(kind)
        subject = F.coalesce(F.get(hints["shared_entities"], F.lit(0)), hints["shared_subject"])
        none = F.lit(None).cast("string")
        canonical = F.struct(
            kind.alias("type"), F.lit("resolved").alias("status"), first["text"].alias("text"), subject.alias("subject"),
            F.lit("states").alias("predicate"), none.alias("object"), home.alias("primary_home"),
            F.array().cast("array<string>").alias("secondary_tags")
        )
        refs = F.flatten(F.transform("candidates", lambda c: c["source_refs"]))
        prov = F.transform(
            refs,
            lambda r: F.struct(r["source"].alias("source"), r["line_span"].alias("line_span"), F.lit("direct").alias("type"), r["captured_at"].alias("captured_at"))
        )
        empty = F.array().cast("array<string>")
        return clusters.select(
            F.lit("<new>").alias("claim_id"), F.col("cluster_id").alias("source_cluster_id"), F.struct(*[F.lit(0.5).alias(n) for n in CLAIM_SCORES]).alias("scores"),
            canonical.alias("canonical"), prov.alias("provenance"), F.array().cast(
                "array<struct<competing_claim_id:string,competing_text:string,relation:string,flagged_in_run_id:string>>"
            ).alias("contradictions"),
            empty.alias("supersedes"), empty.alias("superseded_by"), F.lit("fresh").alias("freshness_posture"), F.lit("medium").alias(
                "confidence_posture"
            ), F.lit("by rule").alias("rationale"), F.lit("default home").alias("route_rationale"),
        )


class ScorerUnavailable(RuntimeError):
    """What a scorer needs is not there; a run stops before anything is written."""


class NoRecord(ScorerUnavailable):
    """No recorded answer fits."""


class ReplayScorer(RuleScorer):
    """Recorded answers: verdicts by candidate id and claims by cluster id. What has no record is an error (the checks
    name it as missing), or is judged by rule where ``rest_by_rule`` says so."""

    def __init__(self, verdicts: DataFrame | None = None, claims: DataFrame | None = None, rest_by_rule: bool = False):
        super().__init__()
        self._verdicts, self._claims, self.rest_by_rule = verdicts, claims, rest_by_rule

    @classmethod
    def from_files(cls, spark: SparkSession, verdict_path: str | None = None, claims: DataFrame | None = None, rest_by_rule: bool = False) -> ReplayScorer:
        return cls(spark.read.schema(VERDICT).json(verdict_path) if verdict_path else None, claims, rest_by_rule)

    def preflight(self) -> None:
        if self._verdicts is None and self._claims is None and not self.rest_by_rule:
            raise ScorerUnavailable("a replay needs recorded answers")

    def verdicts(self, candidates: DataFrame) -> DataFrame:
        if self._verdicts is None:
            return super().verdicts(candidates)
        if not self.rest_by_rule:
            return self._verdicts
        known = self._verdicts.join(candidates.select("candidate_id"), "candidate_id", "left_semi")
        rest = candidates.join(self._verdicts.select("candidate_id"), "candidate_id", "left_anti")
        return known.unionByName(super().verdicts(rest))

    def claims(self, clusters: DataFrame, priors: DataFrame, profile: str) -> DataFrame:
        by_rule = super().claims(clusters, priors, profile)
        if self._claims is None:
            return by_rule
        known = self._claims.join(clusters.select(F.col("cluster_id").alias("source_cluster_id")), "source_cluster_id", "left_semi").select(*by_rule.columns)
        if not self.rest_by_rule:
            return known
        rest = clusters.join(self._claims.select(F.col("source_cluster_id").alias("cluster_id")), "cluster_id", "left_anti")
        return known.unionByName(super().claims(rest, priors, profile))


#: Answers to a batch: what the first pass asks for, and the second.
FIRST_PASS, SECOND_PASS = "promotion", "canonicalization"


class Ask(Protocol):
    def __call__(self, step: str, payload: str) -> str:
        """The answer to a batch's payload, both JSON texts. It is called on executors."""

    def preflight(self) -> None:
        """Raise ScorerUnavailable if it can't work."""


def payload_key(payload: str) -> str:
    """The name of a payload's record: a hash of the payload with sorted keys."""
    return hashlib.sha256(json.dumps(json.loads(payload), sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


class Records:
    """Answers from files, looked for in this order: ``file``; in ``folder`` ``<step>-<key of the payload>.json``, then
    ``<step>-default.json``; else it is an error. The folder is read by the driver and goes along with the tasks, so it
    need not be there on executors."""

    def __init__(self, folder: str | None = None, file: str | None = None):
        self.folder, self.file = folder, file
        self.texts: dict[str, str] = {}
        if folder and Path(folder).is_dir():
            self.texts = {p.name: p.read_text() for p in sorted(Path(folder).glob("*.json"))}
        self.one = Path(file).read_text() if file and Path(file).is_file() else None

    def preflight(self) -> None:
        if not self.folder and not self.file:
            raise ScorerUnavailable("a replay needs a folder or a file of answers")
        if self.file and self.one is None:
            raise ScorerUnavailable(f"there is no file {self.file}")
        if self.folder and not Path(self.folder).is_dir():
            raise ScorerUnavailable(f"there is no folder {self.folder}")

    def __call__(self, step: str, payload: str) -> str:
        if self.one is not None:
            return self.one
        key = payload_key(payload)
        for name in (f"{step}-{key}.json", f"{step}-default.json"):
            if name in self.texts:
                return self.texts[name]
        raise NoRecord(f"no {step}-{key}.json and no {step}-default.json in {self.folder}")


class Command:
    """Answers from a program that reads the payload and writes the answer (its envelope is taken off)."""

    def __init__(self, command: list[str], timeout: float = 300):
        self.command, self.timeout = command, timeout

    def preflight(self) -> None:
        if not self.command or shutil.which(self.command[0]) is None:
            raise ScorerUnavailable(f"there is no program {self.command[:1]}")

    def __call__(self, step: str, payload: str) -> str:
        done = subprocess.run([*self.command, step], input=payload, capture_output=True, text=True, timeout=self.timeout, check=False)
        if done.returncode:
            raise RuntimeError(f"exit {done.returncode}: {done.stderr.strip()[:200]}")
        return done.stdout


class AskingScorer:
    """Judges by asking for a JSON answer to each batch, on executors. An answer that can't be had or read, or that is for
    another run, gives no rows, so that its batch is found broken.

    ``keep`` is set by whoever wants the raw answers written before they are read; ``last`` are those asked for last.
    """

    def __init__(self, ask: Ask, run_id: str = "", mode: str = "incremental", profile: str = "business"):
        self.ask, self.about = ask, {"run_id": run_id, "mode": mode, "profile_scope": profile}
        self.keep: Callable[[DataFrame], DataFrame] = lambda answers: answers
        self.last: DataFrame | None = None

    def preflight(self) -> None:
        self.ask.preflight()

    def answers(self, step: str, rows: DataFrame, name: str, order: str) -> DataFrame:
        """(batch, payload, answer, error) of ``rows`` with a ``batch``; a batch has a bounded number of rows."""
        ask = self.ask
        fields = [c for c in rows.columns if c != "batch"]
        items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_by"), F.struct(*fields).alias("row"))))
        body = F.struct(*[F.lit(v).alias(k) for k, v in self.about.items()], F.transform(items, lambda x: x["row"]).alias(name))
        payloads = rows.groupBy("batch").agg(F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                said, wrong = [], []
                for payload in part["payload"]:
                    try:
                        said.append(ask(step, payload))
                        wrong.append(None)
                    except Exception as e:  # whatever the model's client raises is the batch's error
                        said.append(None)
                        wrong.append(f"{type(e).__name__}: {e}")
                yield part.assign(answer=pd.Series(said, dtype=object, index=part.index), error=pd.Series(wrong, dtype=object, index=part.index))

        self.last = self.keep(payloads.mapInPandas(run, "batch long, payload string, answer string, error string"))
        return self.last

    def rows_of(self, answers: DataFrame, name: str, schema: T.StructType) -> DataFrame:
        # Columns step by step: as one expression, each part would be written out for every use of it.
        read = answers.select(unwrapped(F.col("answer")).alias("said")).select(recovered_json(F.col("said")).alias("value"))
        whole = F.coalesce(F.schema_of_variant("value").startswith("OBJECT"), F.lit(False))
        mine = read.where(whole & (F.try_variant_get("value", "$.run_id", "string") == self.about["run_id"]))
        listed = mine.select(F.try_variant_get("value", f"$.{name}", "variant").cast("string").alias("rows"))
        return listed.select(F.explode(F.from_json("rows", T.ArrayType(schema))).alias("r")).select("r.*")

    def verdicts(self, candidates: DataFrame) -> DataFrame:
        return self.rows_of(self.answers(FIRST_PASS, _batched(candidates), "candidates", "candidate_id"), "verdicts", VERDICT)

    def claims(self, clusters: DataFrame, priors: DataFrame, profile: str) -> DataFrame:
        """Each batch is shown all ``priors``, which the global cap bounds."""
        shown = [r["j"] for r in prior_context(priors).select(F.to_json(F.struct("*")).alias("j")).collect()]
        asked = _batched(clusters).withColumn("prior_context", F.array(*[F.lit(j) for j in shown]).cast("array<string>"))
        return self.rows_of(self.answers(SECOND_PASS, asked, "clusters", "cluster_id"), "canonical_claims", CANONICAL)


def _batched(rows: DataFrame) -> DataFrame:
    return rows if "batch" in rows.columns else rows.withColumn("batch", F.lit(0).cast("long"))
