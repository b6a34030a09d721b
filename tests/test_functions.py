"""Text, date and recovery functions on chosen values."""

import re

import pytest
from pyspark.sql import functions as F

from claimloom.functions import dates, text
from claimloom.operators import extract, recovery, verdicts


def values(spark, inputs, make):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(("given", "key"), [
    ("cats", "cat"), ("address", "address"), ("gas", "gas"), ("The cat", "cat"), ("a notes", "notes"), (
        "  An Apple ", "apple"
    ), (None, ""), ("the", "the"), ("Items\t", "item"), ("cities", "cities"),
])
def test_subject_key(spark, given, key):
    assert values(spark, [given], text.subject_key) == [key]


@pytest.mark.parametrize(("given", "key"), [
    ("running", "runn"), ("preferred", "preferr"), ("notes", "note"), ("noted", "not"), ("uses", "uses"), ("prefers", "prefer"), ("using", "using"), (
        "prefers!s", "prefers!s"
    ), ("", ""), (None, ""),
])
def test_predicate_key(spark, given, key):
    assert values(spark, [given], text.predicate_key) == [key]


def test_lines_like_python(spark):
    samples = ["", "a", "a\n", "a\r\nb", "a\n\nb", "\x0bx\x0c\x1cy\x1d\x1e\x85z  w", "\n", "\r\n\r"]
    assert values(spark, samples, text.lines_of) == [s.splitlines() for s in samples]


def test_strip_and_collapse_like_python(spark):
    samples = [" a ", "\x1c a  b \x1f", "\n\t", "", "A  B\r\nC"]
    assert values(spark, samples, text.strip) == [s.strip() for s in samples]
    assert values(spark, samples, text.collapsed) == [re.sub(r"\s+", " ", s.strip()).lower() for s in samples]


def test_tokens_and_mentions(spark):
    assert values(spark, ["The quick a.b x of Zz-1"], text.retrieval_tokens) == [["quick", "a.b", "zz-1"]]
    assert values(spark, ["The quick a.b of x"], text.duplicate_tokens) == [["quick", "b", "x"]]
    assert values(spark, ["When Zür-x met The Bob/Co and Al"], text.entity_mentions) == [["Zür-x", "Bob/Co"]]


def test_digest_and_tokens(spark):
    long = "x" * 498 + "  y" + "z" * 10
    assert values(spark, ["short ", long], lambda c: text.digest(c, 500)) == ["short", "x" * 498 + "…"]
    assert values(spark, ["", "abc", "a" * 9, None], text.approximate_tokens) == [0, 1, 2, 0]


def test_version_tuples_compare(spark):
    df = spark.createDataFrame([("1.10.0", "1.9.9"), ("2.0rc1", "2.0")], "a string, b string")
    got = df.select(text.version_tuple(F.col("a")).alias("a"), text.version_tuple(F.col("b")).alias("b")).collect()
    assert got[0]["a"] > got[0]["b"] and list(got[1]["a"]) == [2, 0]


def test_dates(spark):
    now = F.lit("2025-03-01T00:00:00Z")
    samples = ["2025-02-28T00:00:00Z", "2025-02-28T08:00:00+08:00", "2025-02-28T12:00:00", "bad", None, "2026-01-01T00:00:00Z"]
    assert values(spark, samples, lambda c: dates.days_since(c, now)) == [1.0, 1.0, 0.5, float("inf"), float("inf"), 0.0]
    assert values(spark, samples, lambda c: dates.age_days(c, now)) == [1, 1, 0, 0, 0, 0]
    assert values(spark, ["bad", "1970-01-01T00:00:10Z"], dates.epoch) == [0.0, 10.0]


def test_time_triple(spark):
    row = spark.range(1).select(*dates.time_triple(F.lit("2025-03-01T20:30:00Z"), "Asia/Manila")).first()
    assert tuple(row) == ("2025-03-02T04:30:00+08:00", "2025-03-01T20:30:00Z", "Asia/Manila")


def test_window(spark):
    df = spark.createDataFrame([(0, 3), (0, 5), (1, 3), (6, 2)], "d int, h int")
    got = [r[0] for r in df.select(dates.in_window(F.col("d"), F.col("h"), ["0 3 * * 0,6", "bad", "0 x * * 1"])).collect()]
    assert got == [True, False, False, True]


def test_units(spark):
    body = "intro line one\nmore\n\n# Heading\n\n---\nshort\n  second unit here \n## Sub\nbody of it\n"
    df = spark.createDataFrame([("a.md", body), ("e.md", ""), ("n.md", None)], "path string, text string")
    got = [(u["start"], u["end"], u["body"]) for r in extract.with_paragraphs(df.na.fill("")).where("path = 'a.md'").collect() for u in r["units"]]
    assert got == [(1, 2, "intro line one\nmore"), (7, 10, "short\n  second unit here \n## Sub\nbody of it")]
    sections = [(u["start"], u["end"], u["body"]) for r in extract.with_sections(df.where("path = 'a.md'")).collect() for u in r["units"]]
    assert sections == [(9, 10, "## Sub\nbody of it")]


def test_candidates_by_source(spark):
    rows = [
        ("MEMORY.md", "A long enough fact.\n\nAnother fact here."), ("PROCEDURES.md", "no sections but text"),
        ("episodes/x.md", "what happened\n\nthat day"), ("MEMORY2.md", None), ("episodes/y.md", "tiny")
    ]
    got = {
        (r["path"], r["line_start"], r["line_end"], r["type_hint"]) for r in extract.extract_candidates(spark.createDataFrame(rows, "path string, text string")).collect()
    }
    assert got == {("MEMORY.md", 1, 1, "fact"), ("MEMORY.md", 3, 3, "fact"), ("PROCEDURES.md", 1, 1, "method"), ("episodes/x.md", 1, 3, "episode")}


def test_recovery(spark):
    samples = ['{"a": 1}', '```json\n{"a": 2}\n```', 'Sure: {"a": 3} done', "null", "[1]", "nothing", '```\n{"b": 1}\n```', None]
    assert values(spark, samples, recovery.recovery_step) == ["direct", "fence_strip", "brace_scan", None, "direct", None, "fence_strip", None]
    assert values(spark, samples, lambda c: recovery.recovery_error(c, ["a"])) == [
        None, None, None, "parse_failed", "not_object", "parse_failed", "missing_keys", "parse_failed"
    ]


def test_envelopes(spark):
    samples = ['{"text": "x", "message": "m"}', '{"response": "", "content": "c"}', '{"output": {"k": 1}, "result": "r"}', "plain"]
    assert values(spark, samples, recovery.unwrapped) == ["m", "c", "r", "plain"]


def test_batches(spark):
    rows = spark.createDataFrame([(f"c{i:03d}",) for i in range(95)], "id string")
    got = verdicts.batch_chunks(rows, "id", 10, 9)
    assert {(r["batch"], r["count"]) for r in got.groupBy("batch").count().collect()} == {(i, 10) for i in range(9)} | {(9, 5)}
    assert got.where("pending").count() == 5
    assert verdicts.batch_chunks(rows, "id", 0, 9).where("batch = 0 and not pending").count() == 95
