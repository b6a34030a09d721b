"""JSON out of model answers, and the answers' envelopes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions.text import blank, lines_of, strip

# Names under which envelopes carry the answer, in order.
ENVELOPE_FIELDS = ["response", "message", "content", "text", "output", "result"]
STEPS = ["direct", "fence_strip", "brace_scan"]


def _attempts(raw: Column) -> list[tuple[str, Column]]:
    body = strip(blank(raw))
    lines = lines_of(body)
    inner = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    closed = F.coalesce(strip(F.try_element_at(inner, F.lit(-1))) == "```", F.lit(False))
    inner = F.when(closed, F.slice(inner, 1, F.greatest(F.size(inner) - 1, F.lit(0)))).otherwise(inner)
    fenced = F.when(body.startswith("```"), strip(F.array_join(inner, "\n")))
    scan = F.regexp_extract(body, r"(?s)(\{.*\})", 1)
    return list(zip(STEPS, [body, fenced, F.when(scan != "", scan)], strict=True))


def recovered_json(raw: Column) -> Column:
    """The first reading of ``raw`` that is JSON (and not null): as it stands, without a code fence, or from the first
    brace to the last; as a variant."""
    tries = []
    for _, text in _attempts(raw):
        value = F.try_parse_json(text)
        tries.append(F.when(F.schema_of_variant(value) != "VOID", value))
    return F.coalesce(*tries)


def recovery_step(raw: Column) -> Column:
    """Which reading it was, null for none."""
    out = F.lit(None).cast("string")
    for name, text in reversed(_attempts(raw)):
        good = F.coalesce(F.schema_of_variant(F.try_parse_json(text)) != "VOID", F.lit(False))
        out = F.when(good, name).otherwise(out)
    return out


def recovery_error(raw: Column, required: list[str]) -> Column:
    """Why an answer can't be used: ``parse_failed``, ``not_object``, ``missing_keys``; null if it can."""
    value = recovered_json(raw)
    shape = F.schema_of_variant(value)
    lacks = F.lit(False)
    for key in required:
        lacks = lacks | F.try_variant_get(value, f"$.{key}", "variant").isNull()
    return F.when(value.isNull(), "parse_failed").when(~shape.startswith("OBJECT"), "not_object").when(lacks, "missing_keys")


def unwrapped(envelope: Column) -> Column:
    """The answer inside an envelope: the first of ENVELOPE_FIELDS that is a text and not blank; else the envelope."""
    whole = F.try_parse_json(envelope)
    found = []
    for field in ENVELOPE_FIELDS:
        value = F.try_variant_get(whole, f"$.{field}", "variant")
        text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(whole, f"$.{field}", "string"))
        found.append(F.when(strip(text) != "", text))
    return F.coalesce(*found, envelope)
