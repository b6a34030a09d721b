"""The human-facing views as ordered rows of blocks, and as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.text import blank, digest, lines_of, shortened, strip, trimmed_end
from claimloom.operators.ranking import global_rank, grouped_rank
from claimloom.operators.resolve import active
from claimloom.schemas import DIGEST_CAP, EP, EPISODE_DIR, HI, LT, PB, SECTIONS, WI

# Titles and notes of the views.
TITLES = {
    LT: "LTMEMORY — Purified Durable Memory", PB: "PLAYBOOKS — Purified Reusable Methods", EP: "EPISODES — Purified Event Digest",
    HI: "HISTORY — Personal Milestones & Turning Points", WI: "WISHES — Stable Aspirations"
}
KEEP_OUT = "_Do not edit this file by hand — changes will be overwritten on the next run._"
NOTES = {
    EP: "_Full narratives live in `episodes/<slug>.md`. This file is an index._",
    WI: "_Aspirations included here are evidenced across multiple entries or reinforced by chronicles. One-off dream residue is excluded._",
}
OTHER = "Uncategorized"


def _updated() -> Column:
    return strip(blank(F.col("updated_at")))


def _captured() -> Column:
    return strip(blank(F.get(F.col("provenance"), F.lit(0))["captured_at"]))


def _latest(c: Column) -> list[tuple[Column, bool]]:
    """Descending as the views have it: blank first."""
    return [(c == "", True), (c, True)]


#: Sort keys and whether they descend.
ORDERS = {
    "subject_asc": lambda: [(F.lower(blank(F.col("subject"))), False), (_updated(), False)],
    "updated_desc": lambda: _latest(_updated()),
    "captured_desc": lambda: _latest(_captured()),
    "captured_asc": lambda: [(_captured(), False)],
    "recurrence_desc": lambda: [(F.coalesce("recurrence", F.lit(0.0)), True), *_latest(_updated())],
}


def _sources(mark: str = "?") -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform("provenance", lambda p: F.coalesce(F.when(p["source"] != "", p["source"]), F.lit(mark))))), ", ")


def _span(p: Column) -> Column:
    span = F.when(F.size(p["line_span"]) > 0, p["line_span"])
    return F.concat(F.lit("L"), F.coalesce(F.get(span, F.lit(0)), F.lit(1)).cast("string"), F.lit("-"), F.coalesce(F.get(span, F.lit(1)), F.lit(1)).cast("string"))


def _tags() -> Column:
    return F.filter(F.coalesce("secondary_tags", F.array().cast("array<string>")), lambda t: (t != "") & ~t.endswith(".md"))


def _contested() -> Column:
    some = lambda c: F.when(c != "", c)
    each = F.transform(
        "contradictions",
        lambda c: F.concat(
            F.lit("> - ["), F.coalesce(some(c["relation"]), F.lit("contested")), F.lit("] "),
            F.coalesce(some(c["competing_claim_id"]), some(c["competing_text"]), F.lit("(unknown)"))
        )
    )
    return F.when(F.size("contradictions") > 0, F.concat(F.lit("\n> Contested by:\n"), F.array_join(each, "\n")))


def _block(*parts: Column) -> Column:
    """Lines of a claim: null parts are left out."""
    return F.array_join(F.array(*parts), "\n")


def _filled(c: Column) -> Column:
    return F.when(c != "", c)


def claim_heading() -> Column:
    subject, predicate, obj, body = (strip(blank(F.col(c))) for c in ("subject", "predicate", "object", "text"))
    named = F.concat(subject, F.lit(" — "), predicate, F.when(obj != "", F.concat(F.lit(" "), obj)).otherwise(""))
    first = shortened(strip(F.get(lines_of(body), F.lit(0))), 80, 77, "…")
    return F.concat(F.lit("### "), F.when((subject != "") & (predicate != ""), named).when(body == "", F.coalesce("id", F.lit("claim"))).otherwise(first))


def _metadata() -> Column:
    first = F.get(F.col("provenance"), F.lit(0))
    one = F.concat(F.lit("_Source: "), F.coalesce(_filled(first["source"]), F.lit("?")), F.lit(" "), _span(first), F.lit("_"))
    many = F.concat(F.lit("_Sources: "), _sources(), F.lit("_"))
    parts = F.array(
        F.when(F.size("provenance") == 1, one).when(F.size("provenance") > 1, many),
        F.when((F.col("status") != "") & (F.col("status") != "resolved"), F.concat(F.lit("_Status: "), F.col("status"), F.lit("_"))),
        F.when(F.col("confidence_posture") != "", F.concat(F.lit("_Confidence: "), F.col("confidence_posture"), F.lit("_"))),
        F.when(_updated() != "", F.concat(F.lit("_Updated: "), F.substring(_updated(), 1, 10), F.lit("_"))),
    )
    return F.array_join(parts, "  ")


def claim_block() -> Column:
    meta = _metadata()
    return _block(claim_heading(), _filled(strip(blank(F.col("text")))), F.when(meta != "", F.concat(F.lit("\n"), meta)), _contested())


def episode_block() -> Column:
    day, subject = F.substring(_captured(), 1, 10), F.coalesce(_filled(strip(blank(F.col("subject")))), F.lit("episode"))
    head = F.concat(F.lit("### "), F.when(day != "", F.concat(day, F.lit(" — "), subject)).otherwise(subject))
    first = F.get(F.col("provenance"), F.lit(0))
    source = blank(first["source"])
    link = F.when(source.startswith(EPISODE_DIR), F.concat(F.lit("["), source, F.lit("]("), source, F.lit(") "))).otherwise(F.concat(source, F.lit(" ")))
    parts = F.array(
        F.concat(F.lit("_Source: "), link, F.coalesce(_span(first), F.lit("L1-1")), F.lit("_")),
        F.when(F.size(_tags()) > 0, F.concat(F.lit("_Tags: "), F.array_join(_tags(), ", "), F.lit("_")))
    )
    return _block(head, _filled(digest(F.col("text"), DIGEST_CAP)), F.lit(""), F.array_join(parts, "  "), _contested())


def _short_subject() -> Column:
    return F.coalesce(_filled(strip(blank(F.col("subject")))), F.substring(blank(F.col("text")), 1, 60))


def history_block() -> Column:
    day = F.substring(_captured(), 1, 10)
    head = F.concat(F.lit("### "), F.when(day != "", F.concat(day, F.lit(" — "), _short_subject())).otherwise(_short_subject()))
    parts = F.array_join(
        F.array(
            F.when(F.size("provenance") > 0, F.concat(F.lit("_Source: "), _sources(), F.lit("_"))),
            F.when(F.size(_tags()) > 0, F.concat(F.lit("_Tags: "), F.array_join(_tags(), ", "), F.lit("_")))
        ),
        "  "
    )
    return _block(head, _filled(strip(blank(F.col("text")))), F.when(parts != "", F.concat(F.lit("\n"), parts)), _contested())


def wish_block() -> Column:
    day = F.substring(_updated(), 1, 10)
    again = F.when(F.col("recurrence").isNotNull(), F.concat(F.lit("_Recurrence: "), F.col("recurrence").cast("long").cast("string"), F.lit(" occurrences_")))
    parts = F.array_join(F.array(again, F.when(day != "", F.concat(F.lit("_Last reinforced: "), day, F.lit("_")))), "  ")
    return _block(F.concat(F.lit("### "), _short_subject()), _filled(strip(blank(F.col("text")))), F.when(parts != "", F.concat(F.lit("\n"), parts)), _contested())


def _rows(claims: DataFrame, section: Column, section_ord: Column, order: list[tuple[Column, bool]], block: Column) -> DataFrame:
    """Blocks numbered inside their sections; no task sees all of a section."""
    made = claims.withColumn("section", section).withColumn("section_ord", section_ord)
    keys = [k for k, _ in order]
    slim = made.select("section_ord", "section", "id", block.alias("block"), "ord", *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    by = [F.col(f"_k{i}").desc() if down else F.col(f"_k{i}").asc() for i, (_, down) in enumerate(order)]
    ranked = grouped_rank(slim, ["section_ord", "section"], [*by, F.col("ord").asc()], "_place")
    return ranked.select("section_ord", "section", (F.col("_place") + 1).cast("int").alias("row_ord"), "id", "block")


def memory_view(claims: DataFrame) -> DataFrame:
    """Sections by type, each in its own order."""
    here = active(claims).where(F.col("primary_home") == LT)
    out = None
    for order in dict.fromkeys(s[2] for s in SECTIONS):
        own = [(i, t, k) for i, (t, k, o) in enumerate(SECTIONS) if o == order]
        title = F.create_map(*[F.lit(x) for _, t, k in own for x in (k, t)])
        place = F.create_map(*[F.lit(x) for i, _, k in own for x in (k, i)])
        part = _rows(here.where(F.col("type").isin([k for _, _, k in own])), title[F.col("type")], place[F.col("type")], ORDERS[order](), claim_block())
        out = part if out is None else out.unionByName(part)
    return out


def playbook_view(claims: DataFrame) -> DataFrame:
    """Methods and procedures by their first tag, in alphabetical order without case; untagged ones last."""
    here = active(claims).where((F.col("primary_home") == PB) & F.col("type").isin("method", "procedure"))
    tag = F.coalesce(F.get(_tags(), F.lit(0)), F.lit(OTHER))
    rows = _rows(here, tag, F.lit(0), ORDERS["subject_asc"](), claim_block())
    names = rows.select("section").distinct().withColumns({"_last": F.col("section") == OTHER, "_low": F.lower("section")})
    numbered = global_rank(names, "_last", "_low", "section", out="_o").select("section", F.col("_o").cast("int").alias("section_ord"))
    return rows.drop("section_ord").join(numbered, "section").select("section_ord", "section", "row_ord", "id", "block")


def episode_view(claims: DataFrame) -> DataFrame:
    here = active(claims).where((F.col("primary_home") == EP) & (F.col("type") == "episode"))
    return _rows(here, F.lit(""), F.lit(0), ORDERS["captured_desc"](), episode_block())


def history_view(claims: DataFrame) -> DataFrame:
    here = active(claims).where((F.col("primary_home") == HI) & (F.col("type") == "milestone"))
    return _rows(here, F.lit(""), F.lit(0), ORDERS["captured_asc"](), history_block())


def wish_view(claims: DataFrame) -> DataFrame:
    here = active(claims).where((F.col("primary_home") == WI) & (F.col("type") == "aspiration"))
    sure = _rows(here.where("status = 'resolved'"), F.lit("Active Aspirations"), F.lit(0), ORDERS["recurrence_desc"](), wish_block())
    return sure.unionByName(_rows(here.where("status = 'unresolved'"), F.lit("Emerging Patterns"), F.lit(1), ORDERS["updated_desc"](), wish_block()))


VIEWS = {LT: memory_view, PB: playbook_view, EP: episode_view, HI: history_view, WI: wish_view}


def view_head(home: str, stamp: str, zone: str) -> str:
    """The lines above a view's blocks, with a local time and its zone."""
    head = [f"# {TITLES[home]}", "", f"_Regenerated {stamp[:10]} {stamp.split('T')[1][:5] if 'T' in stamp else ''} {zone} from the claim store._"]
    if home == LT:
        head.append(KEEP_OUT)
    if home in NOTES:
        head.append(NOTES[home])
    return "\n".join([*head, "", "---"]) + "\n"


def view_lines(rows: DataFrame) -> DataFrame:
    """(value): the text of each block with what stands around it, in order over the partitions. Written as lines, one
    part after the other, these follow ``view_head``."""
    last = rows.agg(F.max(F.struct("section_ord", "row_ord")).alias("m")).first()["m"]
    ends = F.lit(False) if last is None else (F.col("section_ord") == last["section_ord"]) & (F.col("row_ord") == last["row_ord"])
    first = (F.col("row_ord") == 1) & (F.col("section") != "")
    title = F.when(first, F.concat(F.lit("## "), F.col("section"), F.lit("\n\n"))).otherwise("")
    body = F.when(ends, trimmed_end(F.col("block"))).otherwise(F.concat("block", F.lit("\n")))
    placed = rows.select("section_ord", "row_ord", F.concat(title, body).alias("value"))
    return placed.repartitionByRange("section_ord", "row_ord").sortWithinPartitions("section_ord", "row_ord").select("value")


def view_text(rows: DataFrame, home: str, stamp: str, zone: str) -> str:
    """A small view as one text; ``Store.write_view`` puts large ones together without passing them through here."""
    lines = "".join(f"{r['value']}\n" for r in view_lines(rows).toLocalIterator())
    return view_head(home, stamp, zone) + (f"\n{lines}" if lines else "")
