"""N-gram Jaccard join with adaptive multi-match prefixes, for whole corpora.

Two documents link when ``den * |A & B| >= num * |A | B|`` for their sets of word shingles. The steps:

1. One pass makes each document's set digest and a counting sketch of how many documents hold a shingle (a fixed
   number of counters, so its size is bounded). Documents of equal sets are one node from here on.
2. A second pass orders each set by the sketch, rarest first, and keeps a prefix. A prefix one longer than the least
   one (which any linked pair must share one token of) asks for two shared tokens, and so on: each document takes the
   length whose estimated cost, tokens to scan and candidates to verify, is least.
3. Prefix tokens held by two documents or more become lists. In each list the document with the most frequent
   shingles is the centre, and the others are paired with it: pairs grow with the lists, not with their squares. Pairs
   that share as many prefix tokens as both prefixes ask for are verified on their whole texts.
4. What verified links connect needs no further look. Lists that still hold documents of several components give all
   pairs across components, but for those a bound rules out (``_rest``); these are verified too. So no link between
   components is lost, although copies are never expanded into all pairs.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import drop_tables, small_batches, text_of, thrifty, write_table
from claimloom.llm.components import connected_components
from claimloom.llm.shingles import _mix, shingle_sets

SKETCH_PARTS = 16
MAX_MATCHES = 4
#: Pairs of one centre that are verified in one task; more are dealt over lanes.
LANE_PAIRS = 128
#: Postings of a token that go to one task; tokens the sketch holds for more frequent are dealt over lanes.
HOT_LIST = 50_000
#: Counters of the sketch: one for each so many bytes of text, within these bounds.
BYTES_A_COUNTER, LEAST_BITS, MOST_BITS = 128, 16, 24
#: The broadcast sketch holds counts as the nearest power of exp(1 / STEPS), a byte each.
STEPS = 11
#: A centre with so many pairs is a hub: its tokens are known to all lists.
HUB_PAIRS = 32
#: Members of a list that are compared in one task; larger lists are compared block by block.
LIST_BLOCK = 20_000
VERIFY_COST = 8.0
#: Up to so many pairs (some ten MB) go to where the texts are; beyond that texts and pairs are shuffled.
BROADCAST_PAIRS = 100_000
#: Stands for null in arrays.
NONE = -(1 << 63)


def _text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each text begins."""
    a = column.cast(pa.large_string())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _packed(counts: np.ndarray) -> bytes:
    """Counters, compressed, in the fewest bytes that hold the largest."""
    kind = next(t for t in (np.uint8, np.uint16, np.uint32) if counts.max(initial=0) <= np.iinfo(t).max)
    return zlib.compress(counts.astype(kind).tobytes(), 1)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(data)
    return np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(raw) // n])


def sketch_bits_for(text_bytes: int) -> int:
    """The sketch's size grows with the corpus, up to 2**MOST_BITS counters."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, text_bytes / BYTES_A_COUNTER)))))


def _summaries(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """Rows of kind 0: id, n, d1, d2 of a document. Rows of kind 1: a part of a task's counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        names = ["kind", "id", "n", "d1", "d2", "part", "data"]
        for b in batches:
            data, offsets = _text_arrays(b.column(1))
            n, d1, d2 = (np.zeros(len(b), np.int64) for _ in range(3))
            if counts is None:
                counts = np.zeros(1 << bits, np.uint32)
            with np.errstate(over="ignore"):
                for i, s in enumerate(shingle_sets(data, offsets, k)):
                    n[i] = len(s)
                    d1[i] = _mix(s).sum(dtype=np.uint64).view(np.int64)
                    d2[i] = _mix(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64).view(np.int64)
                    np.add.at(counts, (s >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
            none = pa.nulls(len(b))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(b), np.int32)), b.column(0), pa.array(n), pa.array(d1), pa.array(d2), none.cast(pa.int32()), none.cast(pa.binary())],
                names
            )
        if counts is not None:
            parts = [_packed(x) for x in counts.reshape(SKETCH_PARTS, -1)]
            none = pa.nulls(len(parts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * len(parts), pa.int32()), none, none, none, none, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                names
            )

    return docs.mapInArrow(thrifty(run), "kind int, id long, n long, d1 long, d2 long, part int, data binary")


def _sketch(summaries: DataFrame, bits: int) -> np.ndarray:
    """The counters of all tasks, added up in two steps; 4 * 2**bits bytes at most reach the driver."""
    n = (1 << bits) // SKETCH_PARTS

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(n, np.uint64)
        for x in t.column("data"):
            total += _unpacked(x.as_py(), n)
        packed = _packed(np.minimum(total, 0xFFFFFFFF))
        return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int32()), "data": pa.array([packed], pa.binary())})

    parts = summaries.where("kind = 1").select("part", "data", F.pmod(F.xxhash64("data"), F.lit(64)).alias("lane"))
    once = parts.groupBy("part", "lane").applyInArrow(add, "part int, data binary")
    rows = once.groupBy("part").applyInArrow(add, "part int, data binary").collect()
    out = np.zeros((SKETCH_PARTS, n), np.uint32)
    for r in rows:
        out[r["part"]] = _unpacked(r["data"], n)
    return out.reshape(-1)


class Prefixes:
    """Order, prefix length and hub score of sets, by the sketch."""

    def __init__(self, sketch: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        self.sketch = np.round(np.log1p(sketch) * STEPS).astype(np.uint8)
        self.count_of = np.expm1(np.arange(256) / STEPS)
        self.shift = np.uint64(64 - (len(sketch) - 1).bit_length())
        self.noise = float(sketch.sum(dtype=np.float64)) / len(sketch)
        self.margin = 1 + self.noise + 3 * self.noise**0.5
        self.hot_list = HOT_LIST

    def least(self, n: int) -> int:
        """The prefix any linked pair shares a token of: n - ceil(num * n / den) + 1."""
        return n + (-self.num * n // self.den) + 1

    def length(self, n: int, matches: int) -> int:
        return min(n, self.least(n) + matches - 1)

    def steps(self, s: np.ndarray) -> np.ndarray:
        return self.sketch[(s >> self.shift).astype(np.int64)]

    def lanes(self, tokens: np.ndarray) -> np.ndarray:
        """0, or over how many lanes a token's postings are dealt: those that stand out by more than HOT_LIST."""
        extra = self.count_of[self.steps(tokens)] - 1.25 * self.margin
        return np.where(extra > self.hot_list, np.ceil(extra / self.hot_list), 0).astype(np.int64)

    def of(self, s: np.ndarray) -> tuple[np.ndarray, int, float]:
        """The set, rarest first; how many shared tokens its prefix asks for; its hub score."""
        c = self.steps(s)
        order = np.argsort(c, kind="stable")  # s is sorted: ties go by token
        extra = np.maximum(self.count_of[c[order[: self.length(len(s), MAX_MATCHES)]]] - self.margin, 0)
        cost = np.cumsum(extra)
        best, matches = None, 1
        for m in range(1, MAX_MATCHES + 1):
            p = self.length(len(s), m)
            if p - self.least(len(s)) + 1 < m:
                break
            found = p + cost[p - 1] + VERIFY_COST * cost[p - 1] / m
            if best is None or found < best:
                best, matches = found, m
        return s[order], matches, float((np.bincount(c, minlength=256) @ np.log1p(np.maximum(self.count_of - self.noise, 0))) / len(s))


def _prefixes(docs: DataFrame, k: int, shared: Broadcast) -> DataFrame:
    """id, info, prefix: the tokens as bytes. info packs the hub score, the set's size and the matches asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order: Prefixes = shared.value
        for b in batches:
            data, offsets = _text_arrays(b.column(1))
            info, prefix = [], []
            for s in shingle_sets(data, offsets, k):
                if not len(s):
                    info.append(0)
                    prefix.append(None)
                    continue
                tokens, matches, hub = order.of(s)
                info.append((int(min(hub, 15.9) * (1 << 26)) << 32) | (len(s) << 3) | matches)
                prefix.append(tokens[: order.length(len(s), matches)].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(info, pa.int64()), pa.array(prefix, pa.binary())], ["id", "info", "prefix"])

    return docs.mapInArrow(thrifty(run), "id long, info long, prefix binary").where("prefix is not null")


def _postings(prefixes: DataFrame, shared: Broadcast) -> DataFrame:
    """A row for each token of each prefix, with its place in it. Tokens held for very frequent have a lane above 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order: Prefixes = shared.value
        for b in batches:
            parts = b.column(2).to_pylist()
            n = np.array([len(x) // 8 for x in parts], np.int64)
            row = np.repeat(np.arange(len(b)), n)
            place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
            at = pa.array(row)
            tokens = np.frombuffer(b"".join(parts), np.uint64)
            lanes = order.lanes(tokens)
            ids = b.column(0).take(at)
            with np.errstate(over="ignore"):
                lane = np.where(lanes > 0, 1 + _mix(ids.to_numpy().astype(np.uint64)).astype(np.int64) % np.maximum(lanes, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens.view(np.int64)), ids, b.column(1).take(at), pa.array(place.astype(np.int32)), pa.array(lane.astype(np.int32))],
                ["token", "id", "info", "place", "lane"]
            )

    return prefixes.mapInArrow(thrifty(run), "token long, id long, info long, place int, lane int")


def _shared_tokens(postings: DataFrame) -> DataFrame:
    """The postings whose token another row has too. Rows come sorted by token; one row is held back. Those in lanes all
    go on: their tokens are frequent, and one that is not makes a list of one row, which no step pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, same = None, False  # the last row so far, and whether the row before it has its token
        for b in batches:
            dealt = b.column(4).to_numpy() > 0
            if dealt.any():
                yield b.filter(pa.array(dealt)).select(names)
                b = b.filter(pa.array(~dealt))
            b = b.select(names)
            if not len(b):
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            t = b.column(0).to_numpy(zero_copy_only=False)
            after = t[:-1] == t[1:]
            before = np.concatenate([[same], after])
            yield b.slice(0, len(b) - 1).filter(pa.array(before[:-1] | after))
            held, same = b.slice(len(b) - 1), bool(before[-1])
        if held is not None and same:
            yield held

    names = ["token", "id", "info", "place"]
    return postings.repartition("token", "lane").sortWithinPartitions("token").mapInArrow(thrifty(run), "token long, id long, info long, place int")


def _size(info: str) -> Column:
    return F.shiftright(F.col(info).bitwiseAND(0xFFFFFFFF), 3)


def _alike(a: Column, b: Column, num: int, den: int) -> Column:
    return F.greatest(a, b) * num <= F.least(a, b) * den


def _needed(n: Column, m: Column, asked_n: Column, asked_m: Column, num: int, den: int) -> Column:
    """How many prefix tokens two documents of sizes n and m must share to be linked.

    The prefixes ask for the lesser of their two numbers. Beyond that, of the needed overlap at most what lies past the
    prefix that ends first can be missing from the prefixes; which one that is isn't known, so the longer rest counts.
    """
    rest = lambda x, asked: x - F.least(x, x - F.ceil(x * num / den) + asked)
    overlap = F.ceil((n + m) * num / (num + den))
    return F.greatest(F.least(asked_n, asked_m), overlap - F.greatest(rest(n, asked_n), rest(m, asked_m)))


def _star_pairs(lists: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): a is the centre of lists that hold b, and they share as many of them as a linked pair must, or as both
    prefixes ask for if a is the centre of HUB_PAIRS others: ``_rest`` wants to know how near these are to their hub."""
    best = F.struct(F.shiftright("info", 32).alias("h"), (-F.col("id")).alias("i"), F.col("info").alias("f"))
    centres = lists.groupBy("token").agg(F.max(best).alias("c")).select("token", (-F.col("c.i")).alias("a"), F.col("c.f").alias("a_info"))
    pairs = lists.join(centres, "token").where((F.col("id") != F.col("a")) & _alike(_size("info"), _size("a_info"), num, den))
    need = _needed(_size("info"), _size("a_info"), F.col("info").bitwiseAND(7), F.col("a_info").bitwiseAND(7), num, den)
    asked = F.least(F.col("info").bitwiseAND(7), F.col("a_info").bitwiseAND(7))
    met = pairs.groupBy("a", F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(need).alias("need"), F.min(asked).alias("asked")).where("n >= asked")
    hubs = met.groupBy("a").count().where(F.col("count") >= HUB_PAIRS).select("a", F.lit(True).alias("hub"))
    return met.join(hubs, "a", "left").where("n >= need or hub").select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, k: int, shared: Broadcast, hubs: bool) -> DataFrame:
    """Each pair's whole texts compared: a, b, common, rest (tokens of b past its prefix that a lacks), linked.

    With ``hubs``, further rows (b null) carry the tokens of each a with HUB_PAIRS pairs or more. Texts of b stream by
    the set of a; the pairs of one a are dealt over lanes of about LANE_PAIRS, each with its own copy of a.
    """
    sums = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs")).withColumn("lanes", F.ceil(F.col("pairs") / LANE_PAIRS).cast("int"))
    mine = pairs.join(sums, "a").select("a", F.pmod(F.xxhash64("b"), "lanes").cast("int").alias("lane"), "b", F.lit(0).alias("many"), F.lit(1).alias("turn"))
    own = sums.withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)))
    own = own.select("a", "lane", F.col("a").alias("b"), ((F.col("pairs") >= HUB_PAIRS) & (F.col("lane") == 0)).cast("int").alias("many"), F.lit(0).alias("turn"))
    texts = docs.select(F.col("id").alias("b"), "text")
    wanted = mine.unionByName(own)
    if pairs.count() <= BROADCAST_PAIRS:
        wanted = F.broadcast(wanted)
    rows = texts.join(wanted, "b").select("a", "lane", "turn", "many", "b", "text")
    rows = rows.repartition("a", "lane").sortWithinPartitions("a", "lane", "turn", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order: Prefixes = shared.value
        now, base = None, None
        for batch in batches:
            a, lane, turn, many, b = (batch.column(i).to_pylist() for i in range(5))
            data, offsets = _text_arrays(batch.column(5))
            out: list[list] = [[] for _ in range(6)]
            for i, s in enumerate(shingle_sets(data, offsets, k)):
                if turn[i] == 0:
                    now, base = (a[i], lane[i]), s
                    if hubs and many[i]:
                        for col, v in zip(out, (a[i], None, len(s), None, None, s.tobytes()), strict=True):
                            col.append(v)
                    continue
                if now != (a[i], lane[i]) or not len(s):
                    continue
                tokens, matches, _ = order.of(s)
                at = np.minimum(np.searchsorted(base, tokens), len(base) - 1)
                has = base[at] == tokens
                common, p = int(has.sum()), order.length(len(s), matches)
                linked = order.den * common >= order.num * (len(s) + len(base) - common)
                for col, v in zip(out, (a[i], b[i], common, int((~has[p:]).sum()), linked, None), strict=True):
                    col.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["a", "b", "common", "rest", "linked", "tokens"])

    return rows.mapInArrow(thrifty(run), "a long, b long, common long, rest long, linked boolean, tokens binary")


def _rest(lists: DataFrame, found: DataFrame, components: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(a, b), and a written table it reads: pairs across components that share a list, without those that cannot link.

    A document's home is the hub it shares most tokens with. Let o and m have the same home h and meet in a list whose
    token h holds. If they share no prefix token that h lacks, then |o & m| <= min(|o & h|, |m & h|) + rest(o) +
    rest(m), where rest counts the tokens past the prefix that h lacks. If they do share one, they also meet in its
    list, which h is not in and where nothing is ruled out. So pairs below the needed overlap by this bound are left
    out of h's lists. Among documents of one home, sizes that could still link are a range, found by bisection.

    Other pairs must share k prefix tokens (``_needed``), so the first they share has k - 1 places after it in both
    prefixes: in lists of tokens that stand too late in either prefix they are left out. The most frequent tokens, whose
    lists are the longest, stand last.
    """
    named = lists.join(components.withColumnRenamed("component", "_c"), "id", "left").withColumn("comp", F.coalesce("_c", "id")).drop("_c")
    mixed = named.groupBy("token").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("members")
    ).where("lo <> hi").select("token", "members")
    mixed = write_table(mixed, "mixed")

    hubs = found.where("tokens is not null").select(F.col("a").alias("hub"), F.col("common").alias("n"), "tokens")
    best = F.struct("common", (-F.col("a")).alias("i"), "rest")
    home = found.where("b is not null").join(hubs.select(F.col("hub").alias("a")), "a", "left_semi").groupBy("b").agg(F.max(best).alias("x"))
    home = home.select(F.col("b").alias("id"), (-F.col("x.i")).alias("home"), F.col("x.common").alias("common"), F.col("x.rest").alias("rest"))
    own = hubs.select(F.col("hub").alias("id"), F.col("hub").alias("home"), F.col("n").alias("common"), F.lit(0).cast("long").alias("rest"))
    home = own.unionByName(home.join(own.select("id"), "id", "left_anti"))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, t in zip(b.column(0), b.column(1), strict=True):
                tokens = np.frombuffer(t.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(np.full(len(tokens), h.as_py()))], ["token", "hub"])

    held = hubs.select("hub", "tokens").mapInArrow(explode, "token long, hub long").join(mixed, "token")
    members = named.join(mixed, "token").join(home, "id", "left")
    groups = F.ceil(F.col("members") / LIST_BLOCK).cast("int")
    common = ["token", "u", "v", "turn", "group", "id", "size", "asked", "place", "comp", "home", "common", "rest"]
    mine = members.withColumn("groups", groups).withColumn("group", F.pmod(F.xxhash64("id"), "groups").cast("int")).withColumn(
        "x", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    )
    mine = mine.select(
        "token", F.least("group", "x").alias("u"), F.greatest("group", "x").alias("v"), F.lit(1).alias("turn"), "group", "id",
        _size("info").alias("size"), F.col("info").bitwiseAND(7).alias("asked"), "place", "comp", "home", "common", "rest"
    )
    marks = held.withColumn("groups", groups).withColumn("u", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).withColumn(
        "v", F.explode(F.sequence(F.col("u"), F.col("groups") - 1))
    )
    none = F.lit(None).cast("long")
    marks = marks.select(
        "token", "u", "v", F.lit(0).alias("turn"), F.lit(0).alias("group"), F.col("hub").alias("id"), none.alias("size"),
        none.alias("asked"), F.lit(None).cast("int").alias("place"), none.alias("comp"), none.alias("home"), none.alias("common"),
        none.alias("rest")
    )
    # A number of its own: few bytes are much work here, so small partitions must not be put together.
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = mine.unionByName(marks).select(*common).repartition(parts, "token", "u", "v")
    rows = rows.sortWithinPartitions("token", "u", "v", "turn", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            key = np.stack([t.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(cuts):
                yield from _cross_pairs(t.slice(0, cuts[-1]), np.concatenate([[0], cuts]), num, den)
                t = t.slice(cuts[-1])
            held = t.combine_chunks()
        if held is not None and len(held):
            yield from _cross_pairs(held, np.array([0, len(held)]), num, den)

    return rows.mapInArrow(thrifty(run), "a long, b long").distinct(), mixed


def _cross_pairs(t: pa.Table, cuts: np.ndarray, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """The pairs of each list, whose members come by ascending size after its marks."""
    cols = {c: pc.fill_null(t.column(c).cast(pa.int64()), NONE).to_numpy() for c in ("turn", "group", "id", "size", "asked", "place", "comp", "home", "common", "rest")}
    two = t.column("u").to_numpy() != t.column("v").to_numpy()
    out: list[tuple] = []
    made = 0
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        marks = int((cols["turn"][lo:hi] == 0).sum())
        m = slice(lo + marks, hi)
        comp, size, ids, group, asked, place, real = (cols[c][m] for c in ("comp", "size", "id", "group", "asked", "place", "home"))
        if len(ids) < 2 or (comp == comp[0]).all():
            continue
        home = np.where(np.isin(cols["home"][m], cols["id"][lo : lo + marks]), cols["home"][m], NONE)
        shared, rest = cols["common"][m], cols["rest"][m]
        values, counts = np.unique(comp, return_counts=True)
        outside = comp != values[np.argmax(counts)]
        most_rest = {h: rest[home == h].max() for h in np.unique(home) if h != NONE}
        by_home = {h: np.flatnonzero(home == h) for h in most_rest}

        def length_of(at: np.ndarray, size=size, asked=asked) -> np.ndarray:
            return np.minimum(size[at], size[at] - -(-size[at] * num // den) + asked[at])

        plain = np.flatnonzero(home == NONE)
        for i in np.flatnonzero(outside):
            top = size[i] * den // num
            low = -(-size[i] * num // den)
            js = [plain]
            for h, at in by_home.items():
                if h != home[i]:
                    js.append(at)
                    continue
                # Needed overlap is ceil(num * (n + n') / (num + den)); the bound gives the largest n'.
                reach = (shared[i] + rest[i] + most_rest[h]) * (num + den) // num - size[i]
                some = at[np.searchsorted(size[at], low) : np.searchsorted(size[at], min(top, reach), side="right")]
                bound = np.minimum(shared[some], shared[i]) + rest[some] + rest[i]
                js.append(some[bound * (num + den) >= num * (size[some] + size[i])])
            j = np.concatenate(js)
            j = j[(comp[j] != comp[i]) & (size[j] >= low) & (size[j] <= top) & (~outside[j] | (j > i))]
            if two[lo]:
                j = j[group[j] != group[i]]
            if not len(j):
                continue
            length, past = length_of(j), size[j] - length_of(j)
            mine = length_of(np.array([i]))[0]
            need = np.maximum(np.minimum(asked[i], asked[j]), -(-(size[i] + size[j]) * num // (num + den)) - np.maximum(past, size[i] - mine))
            early = (place[i] <= mine - need) & (place[j] <= length - need)
            j = j[early | ((real[j] == real[i]) & (real[i] != NONE))]
            out.append((np.full(len(j), ids[i]), ids[j]))
            made += len(j)
        if made > 50_000:
            yield _pair_batch(out)
            out, made = [], 0
    if out:
        yield _pair_batch(out)


def _pair_batch(parts: list[tuple]) -> pa.RecordBatch:
    x, y = (np.concatenate(p) for p in zip(*parts, strict=True))
    both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100,
    sketch_bits: int | None = None
) -> DataFrame:
    """A row per input row: the id, ``n_shingles`` and ``component_id``, the least id reachable by links.

    Documents link at a Jaccard similarity of num / den or more of their sets of ``shingle``-word shingles. Null and
    empty texts, and texts of white space, have no shingles, link with nothing and are their own component. Texts
    with fewer words than a shingle have one. Rows of equal sets are linked (also those with a null id, which take the
    component of such rows, or null). Ids are integers; rows repeated with one id and text get one result. An empty
    table gives no rows. The sketch has 2**sketch_bits counters; without a number, as many as ``sketch_bits_for`` says.
    """
    spark = docs.sparkSession
    small_batches(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    if sketch_bits is None:
        sketch_bits = sketch_bits_for(slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    summaries = write_table(_summaries(slim, shingle, sketch_bits), "summaries")
    shared = spark.sparkContext.broadcast(Prefixes(_sketch(summaries, sketch_bits), num, den))
    nodes = summaries.where("kind = 0").select("id", "n", "d1", "d2")
    digest = ["n", "d1", "d2"]
    classes = write_table(nodes.where("n > 0").groupBy(*digest).agg(F.min("id").alias("rep")), "classes")

    prefixes = _prefixes(slim, shingle, shared).join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    lists = write_table(_shared_tokens(_postings(prefixes, shared)), "lists")
    stars = write_table(_star_pairs(lists, num, den), "stars")
    first = write_table(_verified(stars, slim, shingle, shared, hubs=True), "first")
    links = first.where("linked").select("a", "b")
    components = write_table(connected_components(links), "components")
    done = first.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest, mixed = _rest(lists, first, components, num, den)
    more = write_table(rest.join(done, ["a", "b"], "left_anti"), "rest")
    second = write_table(_verified(more, slim, shingle, shared, hubs=False).where("linked").select("a", "b"), "second")
    if not second.isEmpty():
        before, components = components, write_table(connected_components(links.unionByName(second)), "components")
        drop_tables(before)
    drop_tables(lists, stars, first, mixed, more, second)

    reps = nodes.join(classes, digest, "left").withColumn("key", F.coalesce("rep", "id"))
    out = reps.join(components.select(F.col("id").alias("key"), "component"), "key", "left")
    return out.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "key").cast(docs.schema[id_col].dataType).alias("component_id")
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component; other columns pass through."""
    groups = jaccard_components(docs, id_col, text_col, **how)
    gone = groups.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
