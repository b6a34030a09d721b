"""URL filters: exact membership by a cascade of Bloom filters over the corpus's whole key universe."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import drop_tables, write_table

MAX_LEVELS = 64
MAX_BYTES = 256 << 20
#: Words of a filter that travel together.
CHUNK = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bit_places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> list[np.ndarray]:
    """Places of keys in a level's filter, from two hashes of the key (double hashing; each level mixes anew)."""
    with np.errstate(over="ignore"):
        a = _mix(h1.astype(np.uint64, copy=False) + np.uint64(level + 1) * _GOLDEN)
        b = _mix(h2.astype(np.uint64, copy=False) ^ (np.uint64(level + 1) * _GOLDEN)) | np.uint64(1)
        return [((a + np.uint64(i) * b) >> np.uint64(11)) % np.uint64(bits) for i in range(hashes)]


class FilterTooLarge(ValueError):
    """The filters of a cascade would be above the limit."""


@dataclass
class Level:
    bits: int
    hashes: int
    words: np.ndarray

    def has(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for at in bit_places(h1, h2, level, self.bits, self.hashes):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """A key is listed if the first level that lacks it is an even one (counted from 1), or if none lacks it
        and their number is odd. Exact for every key of the universe the cascade was built over."""
        listed, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
        for i, level in enumerate(self.levels):
            if not len(open_):
                break
            hit = level.has(h1[open_], h2[open_], i)
            listed[open_[~hit]] = i % 2 == 1
            open_ = open_[hit]
        listed[open_] = len(self.levels) % 2 == 1
        return listed

    @property
    def size(self) -> int:
        return sum(8 * len(x.words) for x in self.levels)


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(F.lit("a"), key).alias("_h1"), F.xxhash64(F.lit("b"), key).alias("_h2")]


def _encode(keys: DataFrame, n: int, rate: float, level: int, max_bytes: int) -> Level:
    """The filter of a level. Its words are OR-ed by an aggregation with partial results in each task, and reach the
    driver in packed parts of CHUNK words."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, 64 * math.ceil(n * hashes / math.log(2) / 64))
    if bits > 8 * max_bytes:
        raise FilterTooLarge(f"a filter of {bits // 8} bytes is above the {max_bytes} that are left; use member_by_join")

    def places(batches):
        for b in batches:
            h1, h2 = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            at = np.concatenate(bit_places(h1, h2, level, bits, hashes)) if len(h1) else np.zeros(0, np.uint64)
            word, inverse = np.unique(at >> np.uint64(6), return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], ["w", "v"])

    def pack(t: pa.Table) -> pa.Table:
        at = t.column("w").to_numpy()
        part = np.zeros(CHUNK, np.int64)
        part[at % CHUNK] = t.column("v").to_numpy()
        return pa.table({"c": pa.array(at[:1] // CHUNK), "data": pa.array([part.tobytes()], pa.binary())})

    rows = keys.select("_h1", "_h2").mapInArrow(places, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v"))
    chunks = rows.withColumn("c", F.floor(F.col("w") / CHUNK)).groupBy("c").applyInArrow(pack, "c long, data binary")
    words = np.zeros(CHUNK * math.ceil(bits / 64 / CHUNK), np.uint64)
    for r in chunks.collect():  # all together the filter, whose size was checked above
        words[r["c"] * CHUNK : (r["c"] + 1) * CHUNK] = np.frombuffer(r["data"], np.uint64)
    return Level(bits, hashes, words[: bits // 64])


def member_flag(spark: SparkSession, cascade: Cascade):
    """A function of two columns of arrays of hashes: an array of booleans, true where the key is listed."""
    shared = spark.sparkContext.broadcast(cascade)

    @F.arrow_udf("array<boolean>")
    def listed(h1: pa.Array, h2: pa.Array) -> pa.Array:
        a, b = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (h1, h2))
        flat = shared.value.has(*(x.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for x in (a, b)))
        offsets = np.concatenate([[0], np.cumsum(pd.Series(a.value_lengths()).fillna(0).to_numpy())]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return listed


def _where_has(keys: DataFrame, level: Level, i: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def test(batches):
        for b in batches:
            h1, h2 = (b.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in ("_h1", "_h2"))
            yield b.filter(pa.array(shared.value.has(h1, h2, i)))

    return keys.mapInArrow(test, keys.schema)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """The cascade for the keys ``listed.key`` over ``universe.key`` (null keys are left out, repeats count once).

    Level 1 encodes the listed keys, level 2 the universe's keys that level 1 wrongly has, level 3 the listed keys
    that level 2 wrongly has, and so on until a level has no false positive. Sets halve from level to level; all
    of them stay distributed, and only filters (under ``max_bytes`` all together, else FilterTooLarge) reach the
    driver. Which keys are listed is found while the universe is made distinct, by one aggregation.
    """
    both = listed.select("key", F.lit(True).alias("_ours")).unionByName(universe.select("key", F.lit(False).alias("_ours")))
    keys = both.where("key is not null").groupBy("key").agg(F.max("_ours").alias("_ours"))
    every = write_table(keys.select("_ours", *key_hashes(F.col("key"))), "universe")
    sizes = {r["_ours"]: r["count"] for r in every.groupBy("_ours").count().collect()}
    n, cascade, written = sizes.get(True, 0), Cascade(), [every]
    inside, outside = (every.where(x).select("_h1", "_h2") for x in (F.col("_ours"), ~F.col("_ours")))
    rate = min(0.5, max(1e-6, math.sqrt(0.5) * n / max(1, sum(sizes.values()))))
    try:
        while n:
            i = len(cascade.levels)
            if i == MAX_LEVELS:
                raise ValueError("two keys share all 128 bits of their hashes")
            cascade.levels.append(_encode(inside, n, rate if i == 0 else 0.5, i, max_bytes - cascade.size))
            written.append(write_table(_where_has(outside, cascade.levels[-1], i), f"level{i}"))
            inside, outside = written[-1], inside
            n = inside.count()
    finally:
        drop_tables(*written)
    return cascade


def member_by_join(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """The way for lists whose filters would be above ``max_bytes``: rows of ``keys`` whose ``key`` is listed."""
    return keys.join(listed.where("key is not null").select("key").distinct(), "key", "left_semi")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``,
    ``#`` or the end. Both empty for null and where there is no ``://``."""
    full = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(full, "://") > 0, F.substring(full, F.instr(full, "://") + 3, F.length(full))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys that could be a rule for the url: the host and each of its parent domains, with each prefix of the
    path that is as long as some rule's path."""
    labels = F.split(host, r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.flatten(F.transform(parents, lambda h: F.transform(sizes, lambda n: F.concat(h, F.substring(path, F.lit(1), n)))))


def _judged_by_join(out: DataFrame, keys: Column, listed: DataFrame, id_col: str, default: str) -> DataFrame:
    """``judge_urls`` without filters, for ``out`` (id, host, path) and the candidate ``keys`` of each."""
    urls = out.select("host", "path").distinct().select("host", "path", F.posexplode(keys).alias("_i", "key"))
    rules = listed.groupBy("key").agg(F.max("blocked").alias("_blocked"))
    best = F.max_by(F.struct("key", "_blocked"), F.struct(F.length("key"), -F.col("_i")))
    ruled = urls.join(rules, "key").groupBy("host", "path").agg(best.alias("_best"))
    verdict = F.when(F.col("_best").isNull(), F.lit(default)).when(F.col("_best._blocked"), "block").otherwise("allow")
    return out.join(ruled, ["host", "path"], "left").select(id_col, "host", "path", F.col("_best.key").alias("rule"), verdict.alias("verdict"))


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, bool]], id_col: str = "page_id", url_col: str = "url", default: str = "allow",
    max_bytes: int = MAX_BYTES
) -> DataFrame:
    """A row per page: id, host, path, rule, verdict.

    ``rules`` are (host, path, blocked). A rule fits its host and all subdomains if the url's path starts with the
    rule's; the longest host and path wins, and at equal length the longer host. One cascade tells the rules from
    all other keys of the corpus, a second the blocking rules from the others; both are exact, and no page is
    joined with the rules or shuffled. Where no rule fits, the url is in no list: ``rule`` is null and the verdict
    ``default``. Null, empty and odd urls have an empty host and path, fit no rule (unless a rule's host and path
    are empty) and get ``default``. Repeated pages get a row each; of repeated rules, one that blocks wins. Where the
    cascade's filters would be above ``max_bytes``, the distinct urls' keys are joined with the rules instead; the
    result is the same.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    lengths = sorted({len(p) for _, p, _ in rules})
    out = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    if not rules:
        return out.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = candidate_keys(F.col("host"), F.col("path"), lengths)
    universe = out.select("host", "path").distinct().select(F.explode(keys).alias("key"))
    listed = spark.createDataFrame([(h + p, b) for h, p, b in rules], "key string, blocked boolean")
    try:
        known = member_flag(spark, build_cascade(listed, universe, max_bytes))
        blocking = member_flag(spark, build_cascade(listed.where("blocked"), listed, max_bytes))
    except FilterTooLarge:
        return _judged_by_join(out, keys, listed, id_col, default)

    hashed = out.withColumn("_keys", keys)
    hashed = hashed.withColumn("_h1", F.transform("_keys", lambda k: key_hashes(k)[0])).withColumn("_h2", F.transform("_keys", lambda k: key_hashes(k)[1]))
    hit = hashed.withColumn("_in", known("_h1", "_h2"))
    # Candidates go from the longest host to the shortest and from the shortest path to the longest.
    fits = F.filter(F.arrays_zip("_keys", "_in"), lambda x: x["_in"])
    best = F.array_max(F.transform(fits, lambda x, i: F.struct(F.length(x["_keys"]).alias("n"), (-i).alias("i"), x["_keys"].alias("key"))))
    ruled = hit.select(id_col, "host", "path", best["key"].alias("rule"))
    one = F.array("rule")
    blocked = blocking(F.transform(one, lambda k: key_hashes(k)[0]), F.transform(one, lambda k: key_hashes(k)[1]))
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(F.get(blocked, F.lit(0)), "block").otherwise("allow")
    return ruled.withColumn("verdict", verdict)
