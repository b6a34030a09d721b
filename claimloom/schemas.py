"""Record types, enumerations and dimension tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Enumerations of the record formats.
VERDICTS = ["reject", "defer", "compress", "merge", "promote"]
SURVIVING = ["compress", "merge", "promote"]
TYPES = [
    "fact", "lesson", "decision", "commitment", "constraint", "preference", "identity", "relationship", "method", "procedure", "episode",
    "aspiration", "milestone", "open_question"
]
STATUSES = ["resolved", "contested", "unresolved", "superseded", "stale", "retire_candidate", "probable_duplicate"]
INACTIVE = ["superseded", "stale", "retire_candidate"]
HOMES = ["LTMEMORY.md", "PLAYBOOKS.md", "EPISODES.md", "HISTORY.md", "WISHES.md"]
PERSONAL_HOMES = ["HISTORY.md", "WISHES.md"]
FRESHNESS = ["fresh", "recent", "aging", "stale"]
CONFIDENCE = ["high", "medium", "low", "tentative"]
PROVENANCE_TYPES = ["direct", "inferred", "merged"]
RELATIONS = ["contested", "stale", "superseded"]
RUN_STATUSES = ["ok", "skipped", "skipped_superseded", "partial_failure", "failed", "upgrade_required"]
VERDICT_SCORES = ["durability", "future_judgment_value", "action_value", "identity_relationship_weight", "cross_time_persistence", "noise_risk"]
CLAIM_SCORES = [
    "semantic_cluster_confidence", "canonical_clarity", "provenance_strength", "contradiction_pressure", "freshness", "confidence",
    "route_fitness", "supersession_confidence"
]

PROFILES = ["business", "personal", "shared"]
# Keys that a manifest must have.
MANIFEST_KEYS = [
    "version", "runId", "mode", "status", "profileScope", "startedAt", "finishedAt", "timezone", "sourceInventory", "processedSegments", "promotionStats", "claimStats", "warnings",
    "partialFailures", "lastSuccessfulCursor", "downstreamWikiIngestSuggested",
]

# Source files, in the order they are looked for, and what is never read.
SHARED_SOURCES = ["MEMORY.md", "RTMEMORY.md", "PROCEDURES.md"]
PERSONAL_SOURCES = ["CHRONICLES.md", "DREAMS.md"]
DENIED_FILES = [
    "CONSTITUTION.md", "KNOWLEDGE.md", "AGENTS.md", "SOUL.md", "HARNESS.md", "LTMEMORY.md", "PLAYBOOKS.md", "EPISODES.md", "HISTORY.md",
    "WISHES.md", "TRENDS.md"
]
DENIED_DIRS = ["memory/", "runtime/"]
EPISODE_DIR = "episodes/"
SECTIONED_SOURCE = "PROCEDURES.md"
SOURCE_TYPES = {"MEMORY.md": "fact", "RTMEMORY.md": "lesson", "PROCEDURES.md": "method", "CHRONICLES.md": "milestone", "DREAMS.md": "aspiration"}
EPISODE_TYPE, UNKNOWN_TYPE = "episode", "unknown"

# Home of a type by default; then the type's strong, acceptable and impossible homes.
LT, PB, EP, HI, WI = HOMES
DEFAULT_HOME = {
    "fact": LT, "lesson": LT, "preference": LT, "constraint": LT, "commitment": LT, "identity": LT, "relationship": LT, "decision": LT,
    "method": PB, "procedure": PB, "episode": EP, "milestone": HI, "aspiration": WI, "open_question": LT,
}
AFFINITY = {
    "fact": (LT, [LT], [PB, EP, HI, WI]),
    "preference": (LT, [LT], [PB, EP, HI, WI]),
    "constraint": (LT, [LT], [PB, EP, HI, WI]),
    "commitment": (LT, [LT], [PB, EP, HI]),
    "identity": (LT, [LT], [PB, EP, WI]),
    "relationship": (LT, [LT], [PB, EP, WI]),
    "lesson": (LT, [LT, PB], [EP, HI, WI]),
    "decision": (LT, [LT, PB], [EP, WI]),
    "open_question": (LT, [LT], [PB, EP, HI]),
    "method": (PB, [PB, LT], [EP, HI, WI]),
    "procedure": (PB, [PB], [LT, EP, HI, WI]),
    "episode": (EP, [EP], [LT, PB, WI]),
    "milestone": (HI, [HI, EP], [LT, PB, WI]),
    "aspiration": (WI, [WI], [LT, PB, EP, HI]),
}
ROUTE_SCORES = {"strong": 1.0, "acceptable": 0.5, "suspicious": 0.1, "impossible": 0.0}

# Sections of the memory view, their type and order within.
SECTIONS = [
    ("Facts", "fact", "subject_asc"), ("Preferences", "preference", "subject_asc"), ("Constraints", "constraint", "subject_asc"),
    ("Commitments", "commitment", "updated_desc"), ("Lessons", "lesson", "updated_desc"), ("Decisions", "decision", "updated_desc"),
    ("Identity", "identity", "subject_asc"), ("Relationships", "relationship", "subject_asc"), ("Open Questions", "open_question", "updated_desc"),
]
DIGEST_CAP = 500

# Words left out of token sets.
RETRIEVAL_STOPWORDS = "the a an is are was were be been being to of and or in on at for with by this that these those it as from".split()
DUPLICATE_STOPWORDS = "the a an is are was were be been to of and or in on at for with by this that it as from".split()
ENTITY_STOPWORDS = "The When This That These Those What How Why Where Who Operator User".split()

SOURCE_REF = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("line_span", T.ArrayType(T.IntegerType())), T.StructField("captured_at", T.StringType())]
)
PROVENANCE = T.StructType([*SOURCE_REF.fields[:2], T.StructField("type", T.StringType()), T.StructField("captured_at", T.StringType())])
CONTRADICTION = T.StructType([T.StructField(c, T.StringType()) for c in ("competing_claim_id", "competing_text", "relation", "flagged_in_run_id")])


def _doubles(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


VERDICT = T.StructType([
    T.StructField("candidate_id", T.StringType()), T.StructField("scores", _doubles(VERDICT_SCORES)), T.StructField("strength", T.DoubleType()),
    T.StructField("verdict", T.StringType()), T.StructField("rationale", T.StringType()), T.StructField("merge_candidate_ids", T.ArrayType(T.StringType())),
    T.StructField("compress_target", T.StringType()),
])
CANONICAL = T.StructType([
    T.StructField("claim_id", T.StringType()), T.StructField("source_cluster_id", T.StringType()), T.StructField("scores", _doubles(CLAIM_SCORES)),
    T.StructField(
        "canonical",
        T.StructType(
            [
                *[T.StructField(c, T.StringType()) for c in ("type", "status", "text", "subject", "predicate", "object", "primary_home")],
                T.StructField("secondary_tags", T.ArrayType(T.StringType()))
            ]
        )
    ),
    T.StructField("provenance", T.ArrayType(PROVENANCE)), T.StructField("contradictions", T.ArrayType(CONTRADICTION)),
    T.StructField("supersedes", T.ArrayType(T.StringType())), T.StructField("superseded_by", T.ArrayType(T.StringType())),
    *[T.StructField(c, T.StringType()) for c in ("freshness_posture", "confidence_posture", "rationale", "route_rationale")],
])
CLAIM = T.StructType([
    T.StructField("ord", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("id", "source_cluster_id", "type", "status", "text", "subject", "predicate", "object", "primary_home")],
    T.StructField("secondary_tags", T.ArrayType(T.StringType())), T.StructField("profile_scope", T.StringType()),
    T.StructField("scores", _doubles(CLAIM_SCORES)), T.StructField("provenance", T.ArrayType(PROVENANCE)),
    T.StructField("contradictions", T.ArrayType(CONTRADICTION)),
    T.StructField("supersedes", T.ArrayType(T.StringType())), T.StructField("superseded_by", T.ArrayType(T.StringType())),
    T.StructField("freshness_posture", T.StringType()), T.StructField("confidence_posture", T.StringType()),
    T.StructField("rationale", T.StringType()), T.StructField("route_rationale", T.StringType()),
    T.StructField("recurrence", T.DoubleType()), T.StructField("updated_in_run_id", T.StringType()), T.StructField("updated_at", T.StringType()),
    T.StructField(
        "retirement_reasons",
        T.ArrayType(
            T.StructType(
                [T.StructField("run_id", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("removed_sources", T.ArrayType(T.StringType()))]
            )
        )
    ),
])
