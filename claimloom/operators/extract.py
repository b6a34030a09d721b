"""Text sources cut into candidate units.

A source is one row, and its units are found inside the row with array functions: no line is exploded and nothing is
shuffled. Arrays that others are made from become columns of their own first (``_let``): inside a lambda an expression
would be evaluated again for each element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.text import blank, collapsed, heading_only, lines_of, short_hash, strip
from claimloom.schemas import EPISODE_DIR, EPISODE_TYPE, SECTIONED_SOURCE, SOURCE_TYPES, UNKNOWN_TYPE

MIN_CHARS = 10
RULES = ["---", "___", "***"]
UNIT = "array<struct<start:int,end:int,body:string>>"


def _let(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is evaluated once: the optimiser folds projections into each other, but not into a generator."""
    return df.withColumn(name, F.explode(F.array(value)))


def _shifted(c: str, back: bool) -> Column:
    """The array moved by one element, true at the open end."""
    size = F.greatest(F.size(c) - 1, F.lit(0))
    return F.concat(F.array(F.lit(True)), F.slice(c, 1, size)) if back else F.concat(F.slice(c, 2, size), F.array(F.lit(True)))


def _cut(df: DataFrame, out: str) -> DataFrame:
    """``out``: units of ``_lines`` between ``_starts`` and ``_stops`` (places from 0, stops excluded) that are long enough
    and not headings alone, as (start, end, body) with lines from 1."""
    spans = F.arrays_zip(F.col("_starts").alias("s"), F.col("_stops").alias("e"))
    made = F.transform(spans, lambda x: F.struct((x["s"] + 1).alias("start"), x["e"].alias("end"), F.slice("_lines", x["s"] + 1, x["e"] - x["s"]).alias("part")))
    bodies = F.transform(
        made,
        lambda u: F.struct(u["start"].alias("start"), u["end"].alias("end"), strip(F.array_join(u["part"], "\n")).alias("body"), heading_only(u["part"]).alias("bare"))
    )
    kept = F.filter(bodies, lambda u: (F.length(u["body"]) >= MIN_CHARS) & ~u["bare"])
    units = F.transform(kept, lambda u: F.struct(u["start"].cast("int").alias("start"), u["end"].cast("int").alias("end"), u["body"].alias("body")))
    return _let(df, out, units).drop("_starts", "_stops")


def _with_lines(df: DataFrame, text_col: str) -> DataFrame:
    return df if "_lines" in df.columns else _let(df, "_lines", lines_of(F.col(text_col)))


def with_paragraphs(df: DataFrame, text_col: str = "text", out: str = "units") -> DataFrame:
    """Units between blank lines and horizontal rules."""
    lined = _let(_with_lines(df, text_col), "_gaps", F.transform("_lines", lambda x: strip(x).isin("", *RULES)))
    marks = F.transform(
        F.arrays_zip(F.col("_gaps").alias("gap"), _shifted("_gaps", True).alias("before"), _shifted("_gaps", False).alias("after")),
        lambda x, i: F.struct(i.alias("i"), x["gap"].alias("gap"), x["before"].alias("before"), x["after"].alias("after"))
    )
    marked = _let(lined, "_marks", F.filter(marks, lambda x: ~x["gap"] & (x["before"] | x["after"])))
    starts = F.transform(F.filter("_marks", lambda x: x["before"]), lambda x: x["i"])
    stops = F.transform(F.filter("_marks", lambda x: x["after"]), lambda x: x["i"] + 1)
    return _cut(marked.withColumns({"_starts": starts, "_stops": stops}), out).drop("_gaps", "_marks", "_lines")


def with_sections(df: DataFrame, text_col: str = "text", out: str = "units") -> DataFrame:
    """Units from each ``## `` heading to the line before the next; text before the first one is left out. Where no
    section is left, the paragraphs."""
    lined = _with_lines(df, text_col)
    heads = F.transform("_lines", lambda x, i: F.struct(i.alias("i"), x.startswith("## ").alias("h")))
    headed = _let(lined, "_starts", F.transform(F.filter(heads, lambda x: x["h"]), lambda x: x["i"]))
    stops = F.when(
        F.size("_starts") > 0, F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts") - 1, F.lit(0))), F.array(F.size("_lines")))
    ).otherwise(F.array().cast("array<int>"))
    both = with_paragraphs(_cut(headed.withColumn("_stops", stops), "_sections"), text_col, "_paragraphs")
    return both.withColumn(out, F.when(F.size("_sections") > 0, F.col("_sections")).otherwise(F.col("_paragraphs"))).drop("_sections", "_paragraphs")


def with_whole(df: DataFrame, text_col: str = "text", out: str = "units") -> DataFrame:
    """The whole text as one unit, if long enough."""
    lined = _with_lines(df, text_col)
    one = F.array(F.struct(F.lit(1).alias("start"), F.greatest(F.lit(1), F.size("_lines")).alias("end"), strip(F.col(text_col)).alias("body")))
    return lined.withColumn(out, F.filter(one, lambda u: F.length(u["body"]) >= MIN_CHARS).cast(UNIT)).drop("_lines")


def type_hint(path: Column) -> Column:
    named = F.create_map(*[F.lit(x) for kv in SOURCE_TYPES.items() for x in kv])
    return F.when(path.startswith(EPISODE_DIR), EPISODE_TYPE).otherwise(F.coalesce(F.try_element_at(named, path), F.lit(UNKNOWN_TYPE)))


def candidate_id(path: Column, start: Column, body: Column) -> Column:
    return short_hash(F.concat_ws(":", path, start.cast("string"), collapsed(body)), "cand-")


def extract_candidates(sources: DataFrame) -> DataFrame:
    """Candidates of (path, text[, captured_at]): candidate_id, text, type_hint, source_refs, and flat start and end.

    Episodes are one unit, the sectioned source is cut at its headings, others into paragraphs. Null texts give none.
    """
    if "captured_at" not in sources.columns:
        sources = sources.withColumn("captured_at", F.lit(None).cast("string"))
    read = sources.where("path is not null").select("path", "captured_at", blank(F.col("text")).alias("text"))
    episode, sectioned = F.col("path").startswith(EPISODE_DIR), F.col("path") == SECTIONED_SOURCE
    cut = with_paragraphs(read.where(~episode & ~sectioned)).unionByName(with_sections(read.where(sectioned))).unionByName(with_whole(read.where(episode)))
    rows = cut.select("path", "captured_at", F.explode("units").alias("u"))
    ref = F.struct(F.col("path").alias("source"), F.array("u.start", "u.end").alias("line_span"), "captured_at")
    return rows.select(
        candidate_id(F.col("path"), F.col("u.start"), F.col("u.body")).alias("candidate_id"), F.col("u.body").alias("text"),
        type_hint(F.col("path")).alias("type_hint"), F.array(ref).alias("source_refs"), "path", F.col("u.start").alias("line_start"),
        F.col("u.end").alias("line_end")
    )
